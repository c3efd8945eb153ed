"""Faults found in review: each test has the input that showed one."""

import pytest
from pyspark.sql import functions as F

from mailcase.functions.labels import BINARY, TYPE4
from mailcase.operators import features as FT
from mailcase.operators import metrics as M
from mailcase.operators import models as ML
from mailcase.sources.cases import read_cases


def _rows(spark, n, label):
    return spark.createDataFrame([(i, f"word{i % 5} other{i % 3} common text", label(i)) for i in range(n)],
                                 "id long, t string, y int")


def test_labels_outside_the_set_are_an_error(spark):
    with pytest.raises(ValueError, match="10 training rows"):
        ML.train_logistic(_rows(spark, 30, lambda i: i % 3 if i % 3 < 2 else 9), "id", "t", "y", TYPE4,
                          weighted=True)


def test_absent_last_class_keeps_its_probability(spark):
    df = _rows(spark, 30, lambda i: i % 3)
    m = ML.train_logistic(df, "id", "t", "y", TYPE4, weighted=True, max_iter=5)
    out = ML.score(m, df.withColumn("problem", F.lit("x")), TYPE4, keep=["id", "problem"]).collect()
    assert len(out) == 30 and {len(r.probs) for r in out} == {len(TYPE4)}


def test_best_round_waits_for_patience():
    assert ML.best_round([3, 2, 1, 2, 2], patience=2) == 3
    assert ML.best_round([3, 2, 1, 2], patience=2) is None
    assert ML.best_round([1.0 / i for i in range(1, 30)], patience=20) is None
    assert ML.best_round([1, 2, 0.5] + [1] * 20, patience=20) == 3


def test_boosting_learns_no_term_of_the_evaluation_rows(spark):
    df = spark.createDataFrame(
        [(i, ("good fine" if i % 2 else "bad poor") + (" secretword" if i % 4 == 0 else ""), i % 2, i % 4 == 0)
         for i in range(80)], "id long, t string, y int, ev boolean")
    m = ML.train_gbt(df, "id", "t", "y", validation="ev", params=dict(maxIter=6), patience=2)
    vocabulary = next(s for s in m.stages if hasattr(s, "vocabulary")).vocabulary
    assert vocabulary and not any("secretword" in t for t in vocabulary)
    pred = ML.score(m, df, BINARY, keep=["y"])
    assert pred.where("pred != y").count() == 0


def test_null_scores_and_groups_in_curves(spark):
    df = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.8), ("a", 0, 0.2), ("a", 1, None)],
                               "g string, y int, s double")
    auc = {r.g: r.roc_auc for r in M.roc_auc(df, "y", "s", ["g"]).collect()}
    assert auc == {None: 1.0, "a": 1.0}
    ap = {r.g: r.average_precision for r in M.average_precision(df, "y", "s", ["g"]).collect()}
    assert ap == {None: 1.0, "a": 1.0}


def test_files_with_swapped_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Subject;Name\ns1;n1\n")
    (tmp_path / "b.csv").write_text("Name;Subject\nn2;s2\n")
    got = sorted((r.Subject, r.Name) for r in read_cases(spark, str(tmp_path)).collect())
    assert got == [("s1", "n1"), ("s2", "n2")]


def test_no_text_is_shuffled_for_the_vocabulary(spark):
    df = spark.range(10).select("id", F.concat(F.lit("some text "), F.col("id").cast("string")).alias("body_text"))
    v = FT.fit_vocabulary(df, "id", "body_text")
    for frame in (v, FT.tfidf(FT.doc_terms(df, "id", "body_text"), v, "id")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" not in plan
    counts = {r.term: r.tf for r in FT.doc_terms(
        spark.createDataFrame([(1, "aa bb aa aa bb")], "id int, t string"), "id", "t").collect()}
    assert counts == {"aa": 3, "bb": 2, "aa bb": 2, "bb aa": 1, "aa aa": 1}


def test_a_bad_byte_far_into_a_file_is_seen(spark, tmp_path):
    from mailcase.sources.cases import encoding_report

    (tmp_path / "a.csv").write_bytes(b"x" * 200_000 + b"\xe9 end")
    (tmp_path / "b.csv").write_bytes("é".encode() * 100_000)
    got = {r.path.rsplit("/", 1)[1]: r.encoding for r in encoding_report(spark, f"{tmp_path}/*.csv").collect()}
    assert got == {"a.csv": "latin-1", "b.csv": "utf-8"}
