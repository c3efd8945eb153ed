import math

from mailcase.functions.labels import BINARY, TYPE4
from mailcase.operators import joins as J
from mailcase.operators import metrics as M
from mailcase.operators import profile as A


def test_value_counts_and_profile(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("a", None), (None, True), (None, True)],
                               "p string, c boolean")
    vc = [tuple(r) for r in A.value_counts(df, "p").collect()]
    assert vc == [(None, 2), ("a", 2), ("b", 1)]
    assert [tuple(r) for r in A.value_counts(df, "p", dropna=True).collect()] == [("a", 2), ("b", 1)]
    assert A.count_value(df, "p", "zzz").first()["count"] == 0
    rep = {(r["column"], r["value"]): r["count"] for r in A.profile_report(df, ["p", "c"]).collect()}
    assert rep[("c", "true")] == 3 and rep[("c", None)] == 1 and rep[("p", None)] == 2
    st = A.bool_stats(df, "c").first()
    assert (st["n_rows"], st["n_true"]) == (5, 3) and math.isclose(st["share_true"], 0.75)


def test_join_fan_out_and_null_safe(spark):
    emails = spark.createDataFrame([(1, "P1"), (2, "P2"), (3, None)], "id int, ParentId string")
    meta = spark.createDataFrame([("P1", "x"), ("P1", "y"), (None, "z")], "Meta_Id string, s string")
    j = sorted((r["id"], r["s"]) for r in J.join_metadata(emails, meta, "ParentId", "Meta_Id").collect())
    assert j == [(1, "x"), (1, "y"), (2, None), (3, None)]
    ns = sorted((r["id"], r["s"]) for r in J.join_metadata(emails, meta, "ParentId", "Meta_Id", null_safe=True).collect())
    assert ns == [(1, "x"), (1, "y"), (2, None), (3, "z")]
    cm = A.count_matching(meta, emails, "Meta_Id", "ParentId").first()
    assert (cm["matched"], cm["total"]) == (2, 3)


def test_metric_edge_cases(spark):
    empty = spark.createDataFrame([], "y int, p int")
    rep = {r["row"]: r for r in M.classification_report(empty, "y", "p", TYPE4).collect()}
    assert rep["accuracy"]["f1_score"] is None and rep["accuracy"]["support"] == 0
    assert all(rep[c]["precision"] == 0.0 for c in TYPE4.classes)
    # a class never predicted: precision 0, recall 0
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "y int, p int")
    prf = {r["class_id"]: r for r in M.per_class_prf(df, "y", "p", TYPE4).collect()}
    assert prf[1]["precision"] == 0.0 and prf[1]["recall"] == 0.0 and prf[1]["support"] == 1
    assert prf[3]["support"] == 0
    # all scores equal: AUC 0.5, AP = share of positives
    eq = spark.createDataFrame([(1, 0.3), (0, 0.3), (0, 0.3), (1, 0.3)], "y int, s double")
    assert math.isclose(M.roc_auc(eq, "y", "s").first()[0], 0.5)
    assert math.isclose(M.average_precision(eq, "y", "s").first()[0], 0.5)


def test_joint_metrics_out_of_set_and_nulls(spark):
    """Accuracy counts every comparable row (ids outside the label set too);
    F1 uses the label-set grid only."""
    rows = [(1, 2.0, 0, 0), (0, -2.0, 1, 1), (1, -1.0, 7, 7), (None, 1.0, 5, 6), (0, 3.0, None, 2)]
    df = spark.createDataFrame(rows, "yb int, xb double, ym int, pm int")
    got = {r["metric"]: r["value"] for r in M.joint_metrics(
        df, bin_label="yb", bin_logit="xb", mc_label="ym", mc_pred="pm", label_set=TYPE4).collect()}
    # binary: comparable rows 1,2,3,5 -> matches rows 1,2 -> 2/4
    assert math.isclose(got["accuracy_binary"], 0.5)
    # multiclass: comparable rows 1,2,3,4 -> matches 1,2,3 (7 == 7 counts) -> 3/4
    assert math.isclose(got["accuracy_multiclass"], 0.75)
    b = {r["class_id"]: r for r in M.per_class_prf(
        df.selectExpr("yb", "CAST(xb > 0 AS INT) AS pb"), "yb", "pb", BINARY).collect()}
    assert math.isclose(got["f1_binary"], b[1]["f1"])
