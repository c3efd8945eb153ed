"""Registered queries for scores and evaluation metrics.

Inputs are the ``class_logits`` / ``binary_scores`` / ``tied_scores`` /
``training_log`` fixture views over ``embeddings`` and ``events``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions.labels import BINARY, PRIORITY5
from mailcase.functions.scores import argmax, confidence, softmax
from mailcase.operators import metrics as M
from mailcase.operators.profile import class_weights
from mailcase.plans.oracle_views import with_views
from mailcase.plans.registry import query
from mailcase.sources.tables import binary_scores, class_logits, tied_scores, training_log

R = 6  # rounding digits for floats on both sides


def _r(c, name=None):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, R).alias(name or (c if isinstance(c, str) else None))


def predictions(spark, sf_dir):
    """class_logits + probs + argmax prediction."""
    cl = class_logits(spark, sf_dir)
    return cl.select("id", "label", "logits", softmax("logits").alias("probs")).withColumn(
        "pred", argmax("probs"))


PRED_VIEW = {"preds": """
SELECT id, label, logits, probs, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS pred
FROM class_probs"""}


@query("softmax_argmax", with_views(["class_probs"], """
SELECT id, pred, round(list_max(probs), 6) AS confidence, round(list_sum(probs), 6) AS prob_sum,
       round(probs[label + 1], 6) AS p_true
FROM preds""", PRED_VIEW))
def q_softmax_argmax(spark, sf_dir):
    """F21 + F22 + F24."""
    p = predictions(spark, sf_dir)
    return p.select("id", "pred", _r(confidence("probs"), "confidence"),
                    _r(F.aggregate("probs", F.lit(0.0), lambda a, v: a + v), "prob_sum"),
                    _r(F.element_at("probs", F.col("label") + 1), "p_true"))


CLASSES5 = "('Low', 0), ('Normal', 1), ('Urgent', 2), ('Immediate', 3), ('nan', 4)"
CM_SQL = f"""
SELECT t.class_id AS true_id, t.class_name AS true_name, p.class_id AS pred_id,
       p.class_name AS pred_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES {CLASSES5}) t(class_name, class_id)
CROSS JOIN (VALUES {CLASSES5}) p(class_name, class_id)
LEFT JOIN (SELECT label, pred, count(*) AS n FROM preds GROUP BY 1, 2) c
  ON c.label = t.class_id AND c.pred = p.class_id"""

PRF_SQL = """
SELECT class_id, class_name,
  coalesce(CAST(tp AS DOUBLE) / nullif(n_pred, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall, support
FROM (SELECT t.true_id AS class_id, t.true_name AS class_name,
        sum(CASE WHEN t.true_id = t.pred_id THEN t.n ELSE 0 END) AS tp,
        sum(t.n) AS support,
        (SELECT sum(n) FROM cm x WHERE x.pred_id = t.true_id) AS n_pred
      FROM cm t GROUP BY 1, 2)"""

PRF_F1_SQL = """
SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM prf0"""


def _metric_views():
    return dict(PRED_VIEW, cm=CM_SQL, prf0=PRF_SQL, prf=PRF_F1_SQL)


@query("confusion_matrix", with_views(["class_probs"], "SELECT * FROM cm", _metric_views()))
def q_confusion_matrix(spark, sf_dir):
    """E1 (with the J4 zero-filled grid)."""
    return M.confusion_matrix(predictions(spark, sf_dir), "label", "pred", PRIORITY5)


@query("accuracy", with_views(["class_probs"], """
SELECT round(avg(CAST(label = pred AS DOUBLE)), 6) AS accuracy FROM preds""", PRED_VIEW))
def q_accuracy(spark, sf_dir):
    """E2."""
    return M.accuracy(predictions(spark, sf_dir), "label", "pred").select(_r("accuracy"))


@query("per_class_prf", with_views(["class_probs"], """
SELECT class_id, class_name, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM prf""", _metric_views()))
def q_per_class_prf(spark, sf_dir):
    """E3."""
    prf = M.per_class_prf(predictions(spark, sf_dir), "label", "pred", PRIORITY5)
    return prf.select("class_id", "class_name", _r("precision"), _r("recall"), _r("f1"),
                      "support")


REPORT_SQL = """
SELECT class_name AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM prf
UNION ALL
SELECT 'accuracy', NULL, NULL,
       round(CAST(sum(CASE WHEN true_id = pred_id THEN n ELSE 0 END) AS DOUBLE) / sum(n), 6),
       CAST(sum(n) AS BIGINT) FROM cm
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM prf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM prf"""


@query("classification_report", with_views(["class_probs"], REPORT_SQL, _metric_views()))
def q_classification_report(spark, sf_dir):
    """E4 + E7."""
    return M.classification_report(predictions(spark, sf_dir), "label", "pred", PRIORITY5,
                                   digits=R)


BIN_PRED_VIEW = {"bpreds": """
SELECT id, CAST(label = 1 AS INTEGER) AS label, CAST(pred = 1 AS INTEGER) AS pred FROM preds"""}


@query("f1_scores", with_views(["class_probs"], """
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'f1_binary' AS metric,
         coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS value
  FROM (SELECT sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM bpreds)
  UNION ALL
  SELECT 'f1_weighted', sum(f1 * support) / sum(support) FROM bprf)""",
    dict(PRED_VIEW, **BIN_PRED_VIEW,
         bprf0="""
SELECT class_id, coalesce(CAST(tp AS DOUBLE) / nullif(n_pred, 0), 0) AS precision,
       coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall, support
FROM (SELECT c.class_id,
        sum(CASE WHEN b.label = c.class_id AND b.pred = c.class_id THEN 1 ELSE 0 END) AS tp,
        sum(CASE WHEN b.label = c.class_id THEN 1 ELSE 0 END) AS support,
        sum(CASE WHEN b.pred = c.class_id THEN 1 ELSE 0 END) AS n_pred
      FROM (VALUES (0), (1)) c(class_id) CROSS JOIN bpreds b GROUP BY 1)""",
         bprf="""
SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1
FROM bprf0""")))
def q_f1_scores(spark, sf_dir):
    """E5: binary F1 (class 1 vs rest) and weighted F1."""
    p = predictions(spark, sf_dir).select(
        (F.col("label") == 1).cast("int").alias("label"),
        (F.col("pred") == 1).cast("int").alias("pred"))
    return M.f1_scores(p, "label", "pred", BINARY).select("metric", _r("value"))


@query("joint_metrics", with_views(["class_probs"], """
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'accuracy_binary' AS metric, avg(CAST(yb = pb AS DOUBLE)) AS value FROM x
  UNION ALL SELECT 'accuracy_multiclass', avg(CAST(ym = pm AS DOUBLE)) FROM x
  UNION ALL
  SELECT 'f1_binary', coalesce(2.0 * sum(CASE WHEN yb = 1 AND pb = 1 THEN 1 ELSE 0 END) /
      nullif(2 * sum(CASE WHEN yb = 1 AND pb = 1 THEN 1 ELSE 0 END)
             + sum(CASE WHEN yb <> pb THEN 1 ELSE 0 END), 0), 0) FROM x
  UNION ALL SELECT 'f1_multiclass', sum(f1 * support) / sum(support) FROM prf)""",
    dict(_metric_views(), x="""
SELECT CAST(label = 1 AS INTEGER) AS yb,
       CAST(1 / (1 + exp(-logits[2])) >= 0.5 AS INTEGER) AS pb,
       label AS ym, pred AS pm FROM preds""")))
def q_joint_metrics(spark, sf_dir):
    """Binary head = logit 2 through sigmoid; multiclass head = argmax."""
    p = predictions(spark, sf_dir).select(
        (F.col("label") == 1).cast("int").alias("yb"),
        F.element_at("logits", 2).alias("xb"), "label", "pred")
    return M.joint_metrics(p, bin_label="yb", bin_logit="xb", mc_label="label", mc_pred="pred",
                           label_set=PRIORITY5).select("metric", _r("value"))


@query("label_binarize", with_views(["class_probs"], """
SELECT id, CAST(i - 1 AS INTEGER) AS class_id, CAST(label = i - 1 AS INTEGER) AS is_pos,
       round(probs[i], 6) AS score
FROM preds, range(1, 6) r(i)""", PRED_VIEW))
def q_label_binarize(spark, sf_dir):
    """One (row, class) pair per class."""
    long = M.label_binarize(predictions(spark, sf_dir), "label", "probs", keep=["id"])
    return long.select("id", "class_id", "is_pos", _r("score"))


def _cum_sql(src: str, by: str = "") -> dict[str, str]:
    part = f"PARTITION BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    return {
        "sc": f"SELECT {sel}score, sum(is_pos) AS pos, count(*) - sum(is_pos) AS neg "
              f"FROM {src} GROUP BY {sel}score",
        "tot": f"SELECT {sel}sum(pos) AS P, sum(neg) AS N FROM sc {grp}",
        "cum": f"""SELECT {sel}score, pos, neg,
  sum(pos) OVER ({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  sum(neg) OVER ({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
FROM sc""",
        "cumt": f"SELECT * FROM cum JOIN tot {join}",
    }


BIN_SRC = {"bs": "SELECT id, label AS is_pos, score FROM binary_scores"}
TIED_SRC = {"bs": "SELECT id, label AS is_pos, score FROM tied_scores"}
OVR_SRC = {"bs": """
SELECT id, CAST(i - 1 AS INTEGER) AS class_id, CAST(label = i - 1 AS INTEGER) AS is_pos,
       probs[i] AS score
FROM class_probs, range(1, 6) r(i)"""}

ROC_SQL = """
SELECT round(CAST(score AS DOUBLE), 6) AS threshold, round(fp / N, 6) AS fpr,
       round(tp / P, 6) AS tpr FROM cumt
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0"""
AUC_SQL = """
SELECT round(sum(neg * (2.0 * tp - pos)) / (2.0 * any_value(P) * any_value(N)), 6) AS roc_auc
FROM cumt"""
PR_SQL = """
SELECT round(CAST(score AS DOUBLE), 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
       round(tp / P, 6) AS recall FROM cumt
UNION ALL SELECT NULL, 1.0, 0.0"""
AP_SQL = """
SELECT round(sum(pos * tp / (tp + fp)) / any_value(P), 6) AS average_precision FROM cumt"""


def _bin(spark, sf_dir):
    return binary_scores(spark, sf_dir).withColumnRenamed("label", "is_pos")


@query("roc_curve", with_views(["binary_scores"], ROC_SQL, dict(BIN_SRC, **_cum_sql("bs"))))
def q_roc_curve(spark, sf_dir):
    """E9 (binary)."""
    c = M.roc_curve(_bin(spark, sf_dir), "is_pos", "score")
    return c.select(_r("threshold"), _r("fpr"), _r("tpr"))


@query("roc_auc", with_views(["binary_scores"], AUC_SQL, dict(BIN_SRC, **_cum_sql("bs"))))
def q_roc_auc(spark, sf_dir):
    """E10 (binary)."""
    return M.roc_auc(_bin(spark, sf_dir), "is_pos", "score").select(_r("roc_auc"))


@query("roc_auc_tied", with_views(["tied_scores"], AUC_SQL, dict(TIED_SRC, **_cum_sql("bs"))))
def q_roc_auc_tied(spark, sf_dir):
    """E10 with many tied scores."""
    t = tied_scores(spark, sf_dir).withColumnRenamed("label", "is_pos")
    return M.roc_auc(t, "is_pos", "score").select(_r("roc_auc"))


@query("pr_curve", with_views(["binary_scores"], PR_SQL, dict(BIN_SRC, **_cum_sql("bs"))))
def q_pr_curve(spark, sf_dir):
    """E12 (binary)."""
    c = M.pr_curve(_bin(spark, sf_dir), "is_pos", "score")
    return c.select(_r("threshold"), _r("precision"), _r("recall"))


@query("average_precision", with_views(["binary_scores"], AP_SQL,
                                       dict(BIN_SRC, **_cum_sql("bs"))))
def q_average_precision(spark, sf_dir):
    """E13 (binary)."""
    return M.average_precision(_bin(spark, sf_dir), "is_pos", "score").select(
        _r("average_precision"))


def _ovr_sql(term: str) -> str:
    return f"""
SELECT class_id, class_name, round(value, 6) AS value FROM (
  SELECT c.class_id, c.class_name, v.value
  FROM (VALUES {CLASSES5}) c(class_name, class_id)
  LEFT JOIN (SELECT class_id, {term} AS value FROM cumt GROUP BY class_id) v USING (class_id)
  UNION ALL
  SELECT NULL, 'macro', avg(value) FROM (SELECT {term} AS value FROM cumt GROUP BY class_id))"""


AUC_TERM = "CASE WHEN any_value(P) > 0 AND any_value(N) > 0 THEN sum(neg * (2.0 * tp - pos)) / " \
           "(2.0 * any_value(P) * any_value(N)) END"
AP_TERM = "CASE WHEN any_value(P) > 0 THEN sum(pos * tp / (tp + fp)) / any_value(P) END"


@query("roc_auc_ovr", with_views(["class_probs"], _ovr_sql(AUC_TERM),
                                 dict(OVR_SRC, **_cum_sql("bs", "class_id"))))
def q_roc_auc_ovr(spark, sf_dir):
    """One-vs-rest ROC AUC per class + macro."""
    o = M.ovr_metric(predictions(spark, sf_dir), "label", "probs", PRIORITY5, "roc_auc")
    return o.select("class_id", "class_name", _r("value"))


@query("average_precision_ovr", with_views(["class_probs"], _ovr_sql(AP_TERM),
                                           dict(OVR_SRC, **_cum_sql("bs", "class_id"))))
def q_average_precision_ovr(spark, sf_dir):
    """E13 one-vs-rest + macro."""
    o = M.ovr_metric(predictions(spark, sf_dir), "label", "probs", PRIORITY5,
                     "average_precision")
    return o.select("class_id", "class_name", _r("value"))


LOGSOFTMAX_VIEW = {"lsm": """
SELECT id, label, logits,
  logits[label + 1] - list_max(logits)
    - ln(list_sum(list_transform(logits, lambda v: exp(v - list_max(logits))))) AS lp
FROM class_logits"""}

WEIGHTS_SQL = """
SELECT c.class_id, c.class_name, CAST(coalesce(h.n, 0) AS BIGINT) AS n,
  (1.0 / nullif(h.n, 0)) / sum(1.0 / nullif(h.n, 0)) OVER () AS weight
FROM (VALUES {classes}) c(class_name, class_id)
LEFT JOIN (SELECT label, count(*) AS n FROM {src} GROUP BY label) h ON h.label = c.class_id"""


@query("class_weights", with_views(["class_logits"], """
SELECT class_id, class_name, n, round(weight, 6) AS weight FROM w""",
    {"w": WEIGHTS_SQL.format(classes=CLASSES5, src="class_logits")}))
def q_class_weights(spark, sf_dir):
    """Inverse-frequency class weights, normalised."""
    w = class_weights(class_logits(spark, sf_dir), "label", PRIORITY5)
    return w.select("class_id", "class_name", "n", _r("weight"))


@query("focal_loss", with_views(["class_logits"], """
SELECT round(avg(power(1 - exp(-ce), 2) * ce), 6) AS focal_loss,
       round(avg(power(1 - exp(-wce), 2) * wce), 6) AS focal_loss_weighted,
       round(sum(power(1 - exp(-ce), 2) * ce), 3) AS focal_loss_sum,
       round(max(power(1 - exp(-ce), 2) * ce), 6) AS focal_loss_max, count(*) AS n
FROM (SELECT -lp AS ce, -w.weight * lp AS wce FROM lsm JOIN w ON w.class_id = lsm.label)""",
    dict(LOGSOFTMAX_VIEW, w=WEIGHTS_SQL.format(classes=CLASSES5, src="class_logits"))))
def q_focal_loss(spark, sf_dir):
    """E14, gamma 2: unweighted, and with A8 class weights as alpha."""
    cl = class_logits(spark, sf_dir)
    # One weight per class of the label set.
    w = class_weights(cl, "label", PRIORITY5).orderBy("class_id").collect()
    alpha = [float(r["weight"] or 0.0) for r in w]
    plain = M.focal_loss(cl, "label", "logits")
    weighted = M.focal_loss(cl, "label", "logits", alpha=alpha)
    total = M.focal_loss(cl, "label", "logits", reduction="sum")
    each = M.focal_loss(cl, "label", "logits", reduction="none").agg(
        F.max("focal_loss").alias("m"), F.count("focal_loss").alias("n"))
    # Four one-row tables side by side.
    return each.select(
        F.round(plain.select("focal_loss").scalar(), R).alias("focal_loss"),
        F.round(weighted.select("focal_loss").scalar(), R).alias("focal_loss_weighted"),
        F.round(total.select("focal_loss").scalar(), 3).alias("focal_loss_sum"),
        F.round("m", R).alias("focal_loss_max"), "n")


@query("log_loss", with_views(["class_logits"], """
SELECT round(lb, 6) AS loss_binary, round(lm, 6) AS loss_multiclass, round(lb + lm, 6) AS loss
FROM (SELECT avg(greatest(logits[2], 0) - logits[2] * CAST(label = 1 AS DOUBLE)
                 + ln(1 + exp(-abs(logits[2])))) AS lb,
             avg(-lp) AS lm FROM lsm)""", LOGSOFTMAX_VIEW))
def q_log_loss(spark, sf_dir):
    """BCE-with-logits (logit 2, label == 1) + cross-entropy (5 classes)."""
    cl = class_logits(spark, sf_dir).select(
        "label", "logits", (F.col("label") == 1).cast("int").alias("yb"),
        F.element_at("logits", 2).alias("xb"))
    ll = M.log_loss(cl, bin_label="yb", bin_logit="xb", mc_label="label", mc_logits="logits")
    return ll.select(_r("loss_binary"), _r("loss_multiclass"), _r("loss"))


@query("loss_curves", with_views(["training_log"], """
SELECT run, step, 'train_loss' AS curve, round(loss, 6) AS value FROM training_log
WHERE loss IS NOT NULL
UNION ALL
SELECT run, step, 'eval_accuracy', round(eval_accuracy, 6) FROM training_log
WHERE eval_accuracy IS NOT NULL"""))
def q_loss_curves(spark, sf_dir):
    """E16 over the training log."""
    c = M.loss_curves(training_log(spark, sf_dir), eval_metric="eval_accuracy")
    return c.select("run", "step", "curve", _r("value"))


@query("best_checkpoint", with_views(["training_log"], """
SELECT run, step AS best_step, round(eval_accuracy, 6) AS best_eval_accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_accuracy DESC, step) AS rn
  FROM training_log WHERE eval_accuracy IS NOT NULL) WHERE rn = 1"""))
def q_best_checkpoint(spark, sf_dir):
    """Best step per run by eval accuracy, earliest on ties."""
    b = M.best_checkpoint(training_log(spark, sf_dir), "eval_accuracy")
    return b.select("run", "best_step", _r("best_eval_accuracy"))
