"""Registered model queries.

Model fits are iterative optimisations that SQL can't repeat. A query with
an oracle compares rows, labels and invariants of the outputs; beside it stands
one that returns the figures, which the tests compute again from the scored
rows. Both report on one fit: the models and scored rows of a session are kept
under its shared folder.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mailcase.functions.labels import (BINARY, PRIORITY5, TYPE4, binary_label, compose_text,
                                       priority5_label, type4_label)
from mailcase.operators import metrics as M
from mailcase.operators import models as ML
from mailcase.operators.joins import align_positions, file_positions
from mailcase.operators.sampling import in_sample
from mailcase.plans.oracle_views import with_views
from mailcase.plans.prepare import prepare_cases
from mailcase.plans.q_prepare import SPLIT_SQL
from mailcase.plans.q_labels import PRIO5_SQL, TYPE4_SQL
from mailcase.plans.q_sources import scratch
from mailcase.plans.registry import query
from mailcase.session import materialize, written
from mailcase.sources import cases as S
from mailcase.sources.tables import email_cases


def model_cases(spark, sf_dir):
    """Prepared cases with text, the three label columns and split flags."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return p.select(
        "case_id", "Subject", "TextBody", "Complaint",
        compose_text("Subject", "TextBody").alias("text"),
        binary_label("Complaint").alias("label_b"),
        type4_label("Complaint_type").alias("label_t"),
        priority5_label("Priority").alias("label_p"),
        in_sample("case_id", 0.8, 42).alias("is_train"),
        in_sample("case_id", 0.1, 42, salt="holdout").alias("is_eval"))


#: Where a session keeps the fitted models and scored rows that several queries report on.
_KEPT: dict[tuple, tuple] = {}


def _once(spark, sf_dir, name: str, make):
    """``make()`` the first time a session asks for ``name`` over ``sf_dir``, then what it returned."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _KEPT:
        _KEPT[at] = make()
    return _KEPT[at]


def _gbt(spark, sf_dir):
    """(root of the saved boosted-tree model, its evaluation losses), fitted once a session."""
    def make():
        train = model_cases(spark, sf_dir).where("is_train")
        model, losses = ML.train_gbt_logged(train, "case_id", "text", "label_b", validation="is_eval")
        root = scratch(spark, "models")
        ML.save_model(model, root, "complaint_gbt", label_set=BINARY, spark=spark)
        return root, losses

    return _once(spark, sf_dir, "gbt", make)


def _gbt_model(spark, sf_dir):
    return ML.load_model(_gbt(spark, sf_dir)[0], "complaint_gbt", spark=spark)[0]


def gbt_scored(spark, sf_dir):
    """Scored test split of the boosted trees (written once a session)."""
    def make():
        test = model_cases(spark, sf_dir).where(~F.col("is_train"))
        # The table's own columns go through the scoring; no join back, one cleaning of the text.
        return written(ML.score(_gbt_model(spark, sf_dir), test, BINARY,
                                keep=["case_id", "Subject", "TextBody", "label_b"]), "scored")

    return _once(spark, sf_dir, "gbt_scored", make)


def priority_scored(spark, sf_dir):
    """M7: class-weighted multinomial LR on 5 priorities, scored test split."""
    def make():
        c = model_cases(spark, sf_dir)
        model = ML.train_logistic(c.where("is_train"), "case_id", "text", "label_p", PRIORITY5, weighted=True)
        return written(ML.score(model, c.where(~F.col("is_train")), PRIORITY5, keep=["case_id", "label_p"]), "scored")

    return _once(spark, sf_dir, "priority", make)


def type_scored(spark, sf_dir):
    """M7 on complaints only: 4 complaint types, scored test split."""
    def make():
        c = model_cases(spark, sf_dir).where("Complaint")
        model = ML.train_logistic(c.where("is_train"), "case_id", "text", "label_t", TYPE4)
        return written(ML.score(model, c.where(~F.col("is_train")), TYPE4, keep=["case_id", "label_t"]), "scored")

    return _once(spark, sf_dir, "type", make)


def binary_scored(spark, sf_dir):
    """M6: binary LR, scored test split as (is_pos, score)."""
    def make():
        c = model_cases(spark, sf_dir)
        model = ML.train_logistic(c.where("is_train"), "case_id", "text", "label_b", BINARY)
        return written(ML.score(model, c.where(~F.col("is_train")), BINARY, keep=["label_b"]).select(
            F.col("label_b").alias("is_pos"), F.element_at("probs", 2).alias("score")), "scored")

    return _once(spark, sf_dir, "binary", make)


def two_heads_scored(spark, sf_dir):
    """M8: shared features, binary and type heads, scored test split."""
    def make():
        c = model_cases(spark, sf_dir)
        hb, hm = ML.train_two_heads(c.where("is_train"), "case_id", "text", "label_b", "label_t", TYPE4)
        # Binomial LR: rawPrediction = (-margin, margin); the margin is the logit.
        # The second head adds its columns to the first one's output: one pass, no join.
        both = hm.stages[-1].transform(hb.transform(c.where(~F.col("is_train"))))
        return written(both.select("case_id", "label_b", "label_t",
                                   F.element_at(vector_to_array("raw_b"), 2).alias("logit_b"),
                                   F.col("pred_m").cast("int").alias("pred")), "scored")

    return _once(spark, sf_dir, "two_heads", make)


@query("gbt_scores", with_views(["prepared_cases"], f"""
SELECT case_id, Subject, TextBody, CAST(Complaint AS INTEGER) AS True_Label,
       true AS probability_ok, true AS prediction_ok
FROM prepared_cases WHERE NOT ({SPLIT_SQL})"""))
def q_gbt_scores(spark, sf_dir):
    """M4/M5 + M9 + E19: boosted trees with early stopping, test-split prediction table.

    SQL can't fit the trees, so the table carries what it can check: the rows,
    texts and true labels of the test split, and whether each row's
    probabilities are a distribution and its prediction the likelier class.
    """
    s = gbt_scored(spark, sf_dir)
    p = F.element_at("probs", 2)
    return s.select("case_id", "Subject", "TextBody", F.col("label_b").alias("True_Label"),
                    ((F.size("probs") == 2) & p.between(0.0, 1.0)
                     & (F.abs(p + F.element_at("probs", 1) - 1.0) < 1e-9)).alias("probability_ok"),
                    ((F.col("pred") == 1) == (p > 0.5)).alias("prediction_ok"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Top 20 terms of the saved boosted-tree model."""
    return ML.feature_importance(_gbt_model(spark, sf_dir), 20, spark=spark)


@query("gbt_predictions")
def q_gbt_predictions(spark, sf_dir):
    """M4/M5/M9 + E19: the prediction table itself, with labels and probabilities."""
    return ML.prediction_table(gbt_scored(spark, sf_dir), label="label_b", keep=["case_id"])


@query("gbt_rounds")
def q_gbt_rounds(spark, sf_dir):
    """M5: evaluation loss of every round fitted, and whether the model keeps it."""
    losses = _gbt(spark, sf_dir)[1]
    return ML.loss_table(spark, losses, ML.rounds(_gbt_model(spark, sf_dir)))


def _report_sql(classes) -> str:
    """Rows and supports of a report on the test split, the part that SQL can derive."""
    names = ", ".join(f"('{c}', {i})" for i, c in enumerate(classes))
    return f"""
SELECT row, support, true AS in_range FROM (
  SELECT c.row, (SELECT count(*) FROM t WHERE t.label = c.id) AS support
  FROM (VALUES {names}) c(row, id)
  UNION ALL SELECT r, (SELECT count(*) FROM t)
  FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(r))"""


def _test_labels(label: str, where: str = "true") -> dict[str, str]:
    return {"t": f"SELECT {label} AS label FROM prepared_cases WHERE NOT ({SPLIT_SQL}) AND {where}"}


def _checked(report):
    """A report's rows and supports, and whether its figures are shares (the
    accuracy row has one, in ``f1_score``)."""
    ok = F.col("f1_score").between(0.0, 1.0)
    for c in ("precision", "recall"):
        ok = ok & ((F.col("row") == "accuracy") | F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False)))
    return report.select("row", "support", ok.alias("in_range"))


@query("lr_priority_report", with_views(["prepared_cases"], _report_sql(PRIORITY5.classes),
                                        _test_labels(PRIO5_SQL)))
def q_lr_priority_report(spark, sf_dir):
    """M7 + E7: class-weighted multinomial LR on 5 priorities, report on the test split."""
    return _checked(q_priority_figures(spark, sf_dir))


@query("lr_priority_figures")
def q_priority_figures(spark, sf_dir):
    """M7 + E7: the figures of that report."""
    return M.classification_report(priority_scored(spark, sf_dir), "label_p", "pred", PRIORITY5, digits=5)


@query("lr_complaint_type_report", with_views(["prepared_cases"], _report_sql(TYPE4.classes),
                                              _test_labels(TYPE4_SQL, "Complaint")))
def q_lr_type_report(spark, sf_dir):
    """M7 on complaints only: 4 complaint types, report on the test split."""
    return _checked(q_type_figures(spark, sf_dir))


@query("lr_complaint_type_figures")
def q_type_figures(spark, sf_dir):
    """M7 + E7 on complaints only: the figures of that report."""
    return M.classification_report(type_scored(spark, sf_dir), "label_t", "pred", TYPE4, digits=5)


@query("model_reload", with_views(["prepared_cases"], f"""
SELECT case_id, true AS same_probs, true AS same_pred, 'type4' AS label_set
FROM prepared_cases WHERE Complaint AND NOT ({SPLIT_SQL})"""))
def q_model_reload(spark, sf_dir):
    """A saved and loaded model scores every test row as the fitted one does."""
    c = model_cases(spark, sf_dir).where("Complaint")
    model = ML.train_logistic(c.where("is_train"), "case_id", "text", "label_t", TYPE4, max_iter=10)
    root = scratch(spark, "models")
    ML.save_model(model, root, "complaint_type", 1, TYPE4, spark=spark)
    loaded, label_set = ML.load_model(root, "complaint_type", spark=spark)
    first = ML.score(model, c.where(~F.col("is_train")), TYPE4, keep=["case_id", "text"])
    first = materialize(first.withColumnsRenamed({"probs": "probs_1", "pred": "pred_1"}))
    again = ML.score(loaded, first, label_set, keep=["case_id", "probs_1", "pred_1"])
    return again.select("case_id", (F.col("probs") == F.col("probs_1")).alias("same_probs"),
                        (F.col("pred") == F.col("pred_1")).alias("same_pred"),
                        F.lit(label_set.name).alias("label_set"))


@query("lr_binary_roc", with_views(["prepared_cases"], f"""
SELECT m AS metric, count(*) FILTER (WHERE Complaint) AS positives,
       count(*) FILTER (WHERE NOT Complaint) AS negatives, true AS in_range
FROM prepared_cases, (SELECT unnest(['roc_auc', 'average_precision']) AS m)
WHERE NOT ({SPLIT_SQL}) GROUP BY m"""))
def q_lr_binary_roc(spark, sf_dir):
    """M6 + E10/E13: binary LR, test ROC AUC and average precision."""
    s = binary_scored(spark, sf_dir)
    n = s.agg(F.count_if(F.col("is_pos") == 1).alias("positives"),
              F.count_if(F.col("is_pos") == 0).alias("negatives"))
    return q_binary_figures(spark, sf_dir).select(
        "metric", n.select("positives").scalar().alias("positives"),
        n.select("negatives").scalar().alias("negatives"),
        F.col("value").between(0.0, 1.0).alias("in_range"))


@query("lr_binary_figures")
def q_binary_figures(spark, sf_dir):
    """M6 + E10/E13: ROC AUC and average precision of the binary LR."""
    s = binary_scored(spark, sf_dir)
    auc = M.roc_auc(s, "is_pos", "score").select(F.lit("roc_auc").alias("metric"),
                                                F.col("roc_auc").alias("value"))
    ap = M.average_precision(s, "is_pos", "score").select(
        F.lit("average_precision").alias("metric"), F.col("average_precision").alias("value"))
    return auc.unionByName(ap)


@query("mtl_metrics", with_views(["prepared_cases"], f"""
SELECT metric, (SELECT count(*) FROM prepared_cases WHERE NOT ({SPLIT_SQL})) AS n_rows, true AS in_range
FROM (VALUES ('accuracy_binary'), ('accuracy_multiclass'), ('f1_binary'), ('f1_multiclass')) m(metric)"""))
def q_mtl_metrics(spark, sf_dir):
    """M8 + E6: shared features, binary and type heads, joint metrics on the test split."""
    n = two_heads_scored(spark, sf_dir).select(F.count(F.lit(1)).alias("n")).scalar()
    return q_mtl_figures(spark, sf_dir).select("metric", n.alias("n_rows"),
                                               F.col("value").between(0.0, 1.0).alias("in_range"))


@query("mtl_figures")
def q_mtl_figures(spark, sf_dir):
    """M8 + E6: accuracy and F1 of both heads."""
    return M.joint_metrics(two_heads_scored(spark, sf_dir), bin_label="label_b", bin_logit="logit_b",
                           mc_label="label_t", mc_pred="pred", label_set=TYPE4).select("metric", "value")


# ------------------------------------------------------------ focal training, external models, keyless predictions

@query("focal_rounds")
def q_focal_rounds(spark, sf_dir):
    """M7 with the focal objective: focal loss of the training rows, round by round."""
    c = model_cases(spark, sf_dir).where("Complaint AND is_train")
    return ML.train_focal(c, "case_id", "text", "label_t", TYPE4)[1]


def length_model(content: bytes):
    """The hosted example: a logistic model on two counts of a text; its
    weights are a line of JSON."""
    import json

    import numpy as np

    w = json.loads(content)

    def predict(texts):
        n = np.array([len(t) for t in texts], dtype=float)
        e = np.array([t.count("e") for t in texts], dtype=float)
        p = 1.0 / (1.0 + np.exp(-((n - w["mean"]) / 2000.0 - e / 400.0 + 0.25)))
        return np.stack([1.0 - p, p], axis=1)

    return predict


EXTERNAL_SQL = """
SELECT case_id, Subject, TextBody, CAST(Complaint AS INTEGER) AS label, 1.0 / (1.0 + exp(-(
  (length(coalesce(TextBody, '')) - (SELECT avg(length(coalesce(TextBody, ''))) FROM prepared_cases)) / 2000.0
  - (length(coalesce(TextBody, '')) - length(replace(coalesce(TextBody, ''), 'e', ''))) / 400.0 + 0.25))) AS p
FROM prepared_cases"""


def external_scored(spark, sf_dir):
    """Every prepared case scored by the hosted model, which lies in the shared folder."""
    c = prepare_cases(email_cases(spark, sf_dir)).select(
        "case_id", "Subject", "TextBody", F.col("Complaint").cast("int").alias("label"))
    path = scratch(spark, "external-model")
    mean = c.agg(F.avg(F.length(F.coalesce("TextBody", F.lit(""))))).first()[0] or 0.0
    spark.createDataFrame([(f'{{"mean": {mean!r}}}',)], "w string").coalesce(1).write.text(path)
    return ML.score_external(c, "TextBody", f"{path}/part-*", length_model, 2,
                             keep=["case_id", "Subject", "TextBody", "label"])


@query("external_scores", with_views(["prepared_cases"], f"""
SELECT case_id, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS pred,
       round(greatest(p, 1.0 - p), 6) AS confidence FROM ({EXTERNAL_SQL})"""))
def q_external_scores(spark, sf_dir):
    """M9: a numpy model outside Spark, loaded once per worker, against SQL of its formula."""
    return external_scored(spark, sf_dir).select(
        "case_id", F.round(F.element_at("probs", 2), 6).alias("probability"), "pred",
        F.round("confidence", 6).alias("confidence"))


def keyless_aligned(spark, sf_dir):
    """Cases and their predictions as two file sets without a key, put side by side by position."""
    s = written(external_scored(spark, sf_dir), "scored")
    truth, scores = scratch(spark, "truth"), scratch(spark, "scores")
    ordered = s.repartitionByRange(5, "case_id").sortWithinPartitions("case_id")
    ordered.select("Subject", "TextBody", "label").write.parquet(truth)
    ordered = s.repartitionByRange(3, "case_id").sortWithinPartitions("case_id")
    S.export_jsonl(ordered.select("pred", "confidence", "probs"), scores)
    return align_positions(file_positions(spark.read.parquet(truth)), file_positions(
        S.read_jsonl(spark, scores, "pred int, confidence double, probs array<double>")))


@query("aligned_predictions", with_views(["prepared_cases"], f"""
SELECT CAST(row_number() OVER (ORDER BY case_id) - 1 AS BIGINT) AS position, Subject, TextBody, label AS True_Label,
       CAST(p > 0.5 AS INTEGER) AS Predicted_Label, round(p, 6) AS Complaint_Probability FROM ({EXTERNAL_SQL})"""))
def q_aligned_predictions(spark, sf_dir):
    """E19 + J5: the full prediction table, aligned by position."""
    t = ML.prediction_table(keyless_aligned(spark, sf_dir), keep=["position"])
    return t.withColumn("Complaint_Probability", F.round("Complaint_Probability", 6))


@query("aligned_classes", with_views(["prepared_cases"], f"""
SELECT Subject, CASE WHEN p > 0.5 THEN 'true' ELSE 'false' END AS Predicted_Class,
       round(greatest(p, 1.0 - p), 6) AS Confidence FROM ({EXTERNAL_SQL})"""))
def q_aligned_classes(spark, sf_dir):
    """E19 + J5, compact: subject, predicted class and confidence."""
    return ML.class_table(keyless_aligned(spark, sf_dir), BINARY).withColumn("Confidence", F.round("Confidence", 6))


@query("aligned_confidences", with_views(["prepared_cases"], f"""
SELECT CASE WHEN p > 0.5 THEN 'true' ELSE 'false' END AS predicted_label, round(greatest(p, 1.0 - p), 6) AS confidence,
       CASE WHEN label = 1 THEN 'true' ELSE 'false' END AS true_label FROM ({EXTERNAL_SQL})"""))
def q_aligned_confidences(spark, sf_dir):
    """E19 + J5, compact: predicted label, confidence and true label."""
    return ML.confidence_table(keyless_aligned(spark, sf_dir), BINARY).withColumn("confidence", F.round("confidence", 6))
