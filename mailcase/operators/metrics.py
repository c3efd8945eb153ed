"""Distributed evaluation metrics.

Each metric takes a predictions DataFrame and returns a small DataFrame.
Counting metrics are one aggregate with map-side partial aggregation; the
class grid comes from the label set (a parameter, C*C rows at most).

Curves (ROC, PR, AUC, AP) need, for every distinct score, the number of
positives and negatives at or above it. That is a prefix sum; a plain
window ``partitionBy(class).orderBy(score)`` would put a whole class into
one task. Instead the distinct scores are cut into quantile buckets, the
bucket totals (classes x buckets rows) get their offsets from a window over
that tiny table, and the running sum inside each (class, bucket) window
adds the offset. Exact, and no task holds more than ~1/B of the scores; B
follows from the number of distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailcase.functions.labels import LabelSet
from mailcase.functions.scores import log_softmax
from mailcase.operators.profile import class_table

#: Distinct scores aimed at per bucket, and the fewest buckets.
BUCKET_SCORES = 500_000
MIN_BUCKETS = 256


def _z(c: Column) -> Column:
    """Zero on a zero denominator (sklearn's ``zero_division=0``)."""
    return F.coalesce(c, F.lit(0.0))


# --------------------------------------------------------------------- E1-E7

CM_SCHEMA = "true_id int, true_name string, pred_id int, pred_name string, n bigint"


def _cm_frame(spark, counts: dict, label_set: LabelSet) -> DataFrame:
    """The zero-filled C x C table from ``{(true_id, pred_id): n}`` (a local relation)."""
    rows = [(i, a, j, b, int(counts.get((i, j), 0)))
            for i, a in enumerate(label_set.classes) for j, b in enumerate(label_set.classes)]
    return spark.createDataFrame(rows, CM_SCHEMA)


def _in_set(c: Column, k: int) -> Column:
    """Class ids of the label set kept, other values -1, null stays null."""
    return F.when(c.isNull(), F.lit(None).cast("int")).when(c.between(0, k - 1), c).otherwise(-1)


def confusion_matrix(df: DataFrame, label: str, pred: str, label_set: LabelSet) -> DataFrame:
    """(true_id, true_name, pred_id, pred_name, n), zero-filled C x C grid.

    Rows are the true class, columns the predicted one. Pairs outside the
    label set are dropped, as with an explicit ``labels=`` list.

    The input is scanned once: a partially aggregated count per (true,
    predicted) pair inside the label set, at most C*C rows, is collected and
    every derived table (P/R/F1, averages, report) is computed from that
    small local table, so a report never re-runs the predictions' plan.
    """
    k = len(label_set)
    t, p = F.col(label).cast("int"), F.col(pred).cast("int")
    rows = (df.where(t.between(0, k - 1) & p.between(0, k - 1))
            .groupBy(t.alias("t"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
            .collect())  # at most C*C rows
    return _cm_frame(df.sparkSession, {(r["t"], r["p"]): r["n"] for r in rows}, label_set)


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Share of rows with ``label == pred`` (NULL on empty input)."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def per_class_prf(df: DataFrame, label: str, pred: str, label_set: LabelSet) -> DataFrame:
    """(class_id, class_name, precision, recall, f1, support); 0 on zero denominators."""
    return prf_from_confusion(confusion_matrix(df, label, pred, label_set))


def prf_from_confusion(cm: DataFrame) -> DataFrame:
    """E3 from an E1 table: one aggregate over the C*C grid, grouped by class.

    Each grid cell contributes to the row total of its true class and to
    the column total of its predicted class, so the cells are emitted once
    per side (2*C*C rows) and summed per class.
    """
    sides = cm.select(F.explode(F.array(
        F.struct(F.col("true_id").alias("class_id"), F.col("true_name").alias("class_name"),
                 F.when(F.col("true_id") == F.col("pred_id"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("n_pred")),
        F.struct(F.col("pred_id").alias("class_id"), F.col("pred_name").alias("class_name"),
                 F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("n_pred")))).alias("s")).select("s.*")
    j = sides.groupBy("class_id", "class_name").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("n_pred").alias("n_pred"))
    p = _z(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")))
    r = _z(F.try_divide(F.col("tp").cast("double"), F.col("support")))
    j = j.withColumns({"precision": p, "recall": r})
    f1 = _z(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                         F.col("precision") + F.col("recall")))
    return j.select("class_id", "class_name", "precision", "recall", f1.alias("f1"),
                    F.col("support").cast("bigint").alias("support"))


def averages(prf: DataFrame) -> DataFrame:
    """Macro (unweighted) and weighted (by support) averages of E3."""
    w = F.col("support").cast("double")
    tot = F.sum(w)
    return prf.agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        _z(F.try_divide(F.sum(F.col("precision") * w), tot)).alias("weighted_precision"),
        _z(F.try_divide(F.sum(F.col("recall") * w), tot)).alias("weighted_recall"),
        _z(F.try_divide(F.sum(F.col("f1") * w), tot)).alias("weighted_f1"),
        F.sum("support").cast("bigint").alias("support"))


def f1_scores(df: DataFrame, label: str, pred: str, label_set: LabelSet,
              positive: int = 1) -> DataFrame:
    """E5: (metric, value) rows ``f1_binary`` (F1 of class ``positive``) and ``f1_weighted``."""
    prf = per_class_prf(df, label, pred, label_set)
    pos = prf.where(F.col("class_id") == positive).select(
        F.lit("f1_binary").alias("metric"), F.col("f1").alias("value"))
    wf = averages(prf).select(F.lit("f1_weighted").alias("metric"),
                              F.col("weighted_f1").alias("value"))
    return pos.unionByName(wf)


def joint_metrics(df: DataFrame, *, bin_label: str, bin_logit: str, mc_label: str,
                  mc_pred: str, label_set: LabelSet) -> DataFrame:
    """(metric, value) for both heads: accuracy and F1 of the binary head
    (sigmoid >= 0.5), accuracy and weighted F1 of the multiclass head.

    One scan: counts per (binary truth, binary prediction, match flag,
    multiclass truth, multiclass prediction, match flag), with ids outside
    the label sets folded to -1 (at most (2+2)^2 (C+2)^2 rows), collected;
    accuracies and both confusion tables come from those counts.
    """
    from mailcase.functions.labels import BINARY
    from mailcase.functions.scores import sigmoid_positive

    yb, pb = F.col(bin_label).cast("int"), sigmoid_positive(F.col(bin_logit)).cast("int")
    ym, pm = F.col(mc_label).cast("int"), F.col(mc_pred).cast("int")
    k = len(label_set)
    rows = df.groupBy(_in_set(yb, 2).alias("yb"), _in_set(pb, 2).alias("pb"),
                      (yb == pb).alias("eb"), _in_set(ym, k).alias("ym"),
                      _in_set(pm, k).alias("pm"), (ym == pm).alias("em")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    spark = df.sparkSession

    def acc(flag):
        den = sum(r["n"] for r in rows if r[flag] is not None)
        return sum(r["n"] for r in rows if r[flag]) / den if den else None

    def cm(t, p, ls):
        c: dict = {}
        for r in rows:
            if r[t] is not None and r[p] is not None and r[t] >= 0 and r[p] >= 0:
                c[(r[t], r[p])] = c.get((r[t], r[p]), 0) + r["n"]
        return _cm_frame(spark, c, ls)

    head = spark.createDataFrame([("accuracy_binary", acc("eb")),
                                  ("accuracy_multiclass", acc("em"))], "metric string, value double")
    b = prf_from_confusion(cm("yb", "pb", BINARY)).where("class_id = 1").select(
        F.lit("f1_binary").alias("metric"), F.col("f1").alias("value"))
    m = averages(prf_from_confusion(cm("ym", "pm", label_set))).select(
        F.lit("f1_multiclass").alias("metric"), F.col("weighted_f1").alias("value"))
    return head.unionByName(b).unionByName(m)


def classification_report(df: DataFrame, label: str, pred: str, label_set: LabelSet,
                          digits: int | None = None) -> DataFrame:
    """Per-class rows, then accuracy, macro avg, weighted avg.

    Columns: row, precision, recall, f1_score, support. The accuracy row has
    NULL precision/recall and the accuracy in ``f1_score``. Everything is
    derived from the C*C confusion table, so the input is scanned once.
    """
    cm = confusion_matrix(df, label, pred, label_set)
    prf = prf_from_confusion(cm)
    avg = averages(prf)
    k = len(label_set)
    nul = F.lit(None).cast("double")
    cls = prf.select(F.col("class_name").alias("row"), "precision", "recall",
                     F.col("f1").alias("f1_score"), "support", F.col("class_id").alias("ord"))
    acc = cm.agg(F.try_divide(F.sum(F.when(F.col("true_id") == F.col("pred_id"), F.col("n"))
                                    .otherwise(0)).cast("double"), F.sum("n")).alias("f1_score"),
                 F.sum("n").cast("bigint").alias("support")).select(
        F.lit("accuracy").alias("row"), nul.alias("precision"), nul.alias("recall"),
        "f1_score", "support", F.lit(k).alias("ord"))
    macro = avg.select(F.lit("macro avg").alias("row"), F.col("macro_precision").alias("precision"),
                       F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1_score"),
                       "support", F.lit(k + 1).alias("ord"))
    weighted = avg.select(F.lit("weighted avg").alias("row"),
                          F.col("weighted_precision").alias("precision"),
                          F.col("weighted_recall").alias("recall"),
                          F.col("weighted_f1").alias("f1_score"), "support",
                          F.lit(k + 2).alias("ord"))
    out = cls.unionByName(acc).unionByName(macro).unionByName(weighted)
    if digits is not None:
        out = out.select("row", *[F.round(c, digits).alias(c)
                                  for c in ("precision", "recall", "f1_score")], "support", "ord")
    return out.orderBy("ord").drop("ord")


# ---------------------------------------------------------------- E8-E13

def label_binarize(df: DataFrame, label: str, probs: str, keep: Sequence[str] = ()
                   ) -> DataFrame:
    """One row per (row, class): class_id, is_pos (0/1), score."""
    return df.select(*keep, F.col(label).cast("int").alias("_y"),
                     F.posexplode(probs).alias("class_id", "score")).select(
        *keep, F.col("class_id").cast("int").alias("class_id"),
        (F.col("_y") == F.col("class_id")).cast("int").alias("is_pos"), "score")


def score_counts(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg): positives and negatives per distinct score.

    A row without a score (null) or without a truth can't be ranked and counts
    nowhere, so a perfect ranking stays perfect. NaN ranks above all numbers.
    """
    y = F.col(is_pos).cast("long")
    return df.where(F.col(score).isNotNull() & F.col(is_pos).isNotNull()).groupBy(*by, score).agg(F.sum(y).alias("pos"),
                                      F.sum(F.lit(1) - y).alias("neg"))


def _score_buckets(counts: DataFrame, score: str, n_buckets: int) -> list[float]:
    qs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = counts.approxQuantile(score, qs, 1.0 / (4 * n_buckets)) if n_buckets > 1 else []
    inner = sorted({b for b in bounds if b is not None})
    return [float("-inf")] + inner + [float("inf")]


def cumulative_counts(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = (),
                      n_buckets: int | None = None) -> DataFrame:
    """For each distinct score (per group): pos, neg, tp, fp (counts at or above
    the score) and the group totals P, N."""
    from mailcase.session import materialize

    by = list(by)
    # Read by the quantile job and by two branches below: computed once.
    counts = materialize(score_counts(df, is_pos, score, by))
    if n_buckets is None:
        n_buckets = max(MIN_BUCKETS, counts.count() // BUCKET_SCORES)
    splits = _score_buckets(counts, score, n_buckets)
    if len(splits) > 2:
        b = Bucketizer(splits=splits, inputCol=score, outputCol="_b", handleInvalid="keep")
        cb = b.transform(counts)
    else:
        cb = counts.withColumn("_b", F.lit(0.0))
    # Bucket totals: at most groups x buckets rows.
    tot = cb.groupBy(*by, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    above = Window.partitionBy(*by).orderBy(F.col("_b").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    offsets = tot.select(
        *by, "_b",
        F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_on"),
        F.sum("_bp").over(everything).alias("P"),
        F.sum("_bn").over(everything).alias("N"))
    inside = Window.partitionBy(*by, "_b").orderBy(F.col(score).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = cb.select(*by, "_b", score, "pos", "neg",
                    F.sum("pos").over(inside).alias("_cp"),
                    F.sum("neg").over(inside).alias("_cn"))
    # Null-safe: rows of a null group are a group of their own.
    right = offsets.select(*[F.col(c).alias(f"_j{i}") for i, c in enumerate([*by, "_b"])],
                           "_op", "_on", "P", "N")
    cond = F.lit(True)
    for i, c in enumerate([*by, "_b"]):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_j{i}"))
    j = run.join(right, cond)
    return j.select(*by, score, "pos", "neg",
                    (F.col("_op") + F.col("_cp")).alias("tp"),
                    (F.col("_on") + F.col("_cn")).alias("fp"), "P", "N")


def roc_curve(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = (),
              n_buckets: int | None = None) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score plus the
    start point (threshold +inf, 0, 0)."""
    by = list(by)
    c = cumulative_counts(df, is_pos, score, by, n_buckets)
    pts = c.select(*by, F.col(score).cast("double").alias("threshold"),
                   F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                   F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"))
    start = c.select(*by, "P", "N").distinct().select(
        *by, F.lit(float("inf")).alias("threshold"),
        F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
        F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"))
    return pts.unionByName(start)


def roc_auc(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = (),
            n_buckets: int | None = None) -> DataFrame:
    """Trapezoid area under E9 (= Mann-Whitney); NULL without positives or negatives.

    Each distinct score adds the trapezoid ``neg/N * (tp + tp_prev) / (2P)``
    with ``tp_prev = tp - pos``, so no lag window is needed.
    """
    by = list(by)
    c = cumulative_counts(df, is_pos, score, by, n_buckets)
    term = F.col("neg").cast("double") * (F.lit(2.0) * F.col("tp") - F.col("pos"))
    agg = c.groupBy(*by).agg(F.sum(term).alias("_s"), F.first("P").alias("P"),
                             F.first("N").alias("N"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(*by, F.when(ok, F.col("_s") / (F.lit(2.0) * F.col("P") * F.col("N")))
                      .alias("roc_auc"))


def pr_curve(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = (),
             n_buckets: int | None = None) -> DataFrame:
    """(by..., threshold, precision, recall) per distinct score, plus the
    end point (threshold NULL, precision 1, recall 0)."""
    by = list(by)
    c = cumulative_counts(df, is_pos, score, by, n_buckets)
    pts = c.select(*by, F.col(score).cast("double").alias("threshold"),
                   _z(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")))
                   .alias("precision"),
                   F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("recall"))
    end = c.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, is_pos: str, score: str, by: Sequence[str] = (),
                      n_buckets: int | None = None) -> DataFrame:
    """``sum (R_n - R_{n-1}) P_n`` without interpolation; NULL without positives."""
    by = list(by)
    c = cumulative_counts(df, is_pos, score, by, n_buckets)
    term = F.col("pos").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp"))
    agg = c.groupBy(*by).agg(F.sum(term).alias("_s"), F.first("P").alias("P"))
    return agg.select(*by, F.when(F.col("P") > 0, F.col("_s") / F.col("P"))
                      .alias("average_precision"))


def ovr_metric(df: DataFrame, label: str, probs: str, label_set: LabelSet, metric: str,
               n_buckets: int | None = None) -> DataFrame:
    """E11 / E13 one-vs-rest: per-class value plus a ``macro`` row (mean of non-NULL)."""
    fn = {"roc_auc": roc_auc, "average_precision": average_precision}[metric]
    long = label_binarize(df, label, probs)
    per = fn(long, "is_pos", "score", ["class_id"], n_buckets)
    grid = class_table(df, label_set)
    per = grid.join(F.broadcast(per), "class_id", "left").select(
        "class_id", "class_name", F.col(metric).alias("value"))
    macro = per.agg(F.avg("value").alias("value")).select(
        F.lit(None).cast("int").alias("class_id"), F.lit("macro").alias("class_name"), "value")
    return per.unionByName(macro)


# ---------------------------------------------------------------- E14-E17

def cross_entropy_terms(df: DataFrame, label: str, logits: str,
                        weights: Sequence[float] | None = None) -> DataFrame:
    """Per-row weighted cross-entropy ``-w_y * log softmax(x)_y`` (column ``ce``)."""
    y = F.col(label).cast("int")
    lp = F.element_at(log_softmax(F.col(logits)), y + F.lit(1))
    w = F.element_at(F.array(*[F.lit(float(v)) for v in weights]), y + F.lit(1)) \
        if weights is not None else F.lit(1.0)
    return df.withColumn("ce", -w * lp)


def focal_loss(df: DataFrame, label: str, logits: str, gamma: float = 2.0,
               alpha: Sequence[float] | None = None, reduction: str = "mean") -> DataFrame:
    """``(1 - exp(-ce))^gamma * ce``; mean over rows, sum, or per row (``none``)."""
    t = cross_entropy_terms(df, label, logits, alpha)
    fl = F.pow(F.lit(1.0) - F.exp(-F.col("ce")), F.lit(gamma)) * F.col("ce")
    t = t.withColumn("focal_loss", fl)
    if reduction == "none":
        return t
    agg = F.avg("focal_loss") if reduction == "mean" else F.sum("focal_loss")
    return t.agg(agg.alias("focal_loss"))


def bce_with_logits(x: Column, y: Column) -> Column:
    """Stable binary cross-entropy on a logit."""
    return (F.greatest(x, F.lit(0.0)) - x * y.cast("double")
            + F.log1p(F.exp(-F.abs(x))))


def log_loss(df: DataFrame, *, bin_label: str, bin_logit: str, mc_label: str,
             mc_logits: str) -> DataFrame:
    """Mean BCE-with-logits, mean cross-entropy, and their sum."""
    t = cross_entropy_terms(df, mc_label, mc_logits)
    t = t.withColumn("bce", bce_with_logits(F.col(bin_logit).cast("double"), F.col(bin_label)))
    return t.agg(F.avg("bce").alias("loss_binary"), F.avg("ce").alias("loss_multiclass")
                 ).withColumn("loss", F.col("loss_binary") + F.col("loss_multiclass"))


def loss_curves(log: DataFrame, run: str = "run", step: str = "step",
                loss: str = "loss", eval_metric: str = "eval_loss") -> DataFrame:
    """(run, step, curve, value) for the training-loss and eval curves."""
    tr = log.where(F.col(loss).isNotNull()).select(
        run, step, F.lit("train_" + loss).alias("curve"), F.col(loss).cast("double").alias("value"))
    ev = log.where(F.col(eval_metric).isNotNull()).select(
        run, step, F.lit(eval_metric).alias("curve"),
        F.col(eval_metric).cast("double").alias("value"))
    return tr.unionByName(ev)


def best_checkpoint(log: DataFrame, metric: str, run: str = "run", step: str = "step",
                    greater_is_better: bool = True) -> DataFrame:
    """Per run the step with the best metric, earliest step on ties.

    ``min(struct(-metric, step))`` is an ordinary aggregate (partial
    aggregation, no window), and its struct order gives the tie rule.
    """
    m = F.col(metric).cast("double")
    key = -m if greater_is_better else m
    best = log.where(m.isNotNull()).groupBy(run).agg(
        F.min(F.struct(key.alias("k"), F.col(step).alias("s"))).alias("_b"))
    sign = -1.0 if greater_is_better else 1.0
    return best.select(run, F.col("_b.s").alias("best_step"),
                       (F.col("_b.k") * F.lit(sign)).alias("best_" + metric))
