"""Cut ensembles, focal training, hosted models, keyless alignment, published versions, figures of the model queries."""
import json
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mailcase.functions.labels import BINARY, PRIORITY5, TYPE4
from mailcase.operators import boosting as B
from mailcase.operators import joins as J
from mailcase.operators import metrics as M
from mailcase.operators import models as ML
from mailcase.plans import q_models as Q


@pytest.fixture(scope="module")
def rows(spark):
    """Features with a learnable 0/1 label and an evaluation flag."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 6))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=600) * 0.7 > 0).astype(float)
    data = [(Vectors.dense(a.tolist()), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ["features", "label", "is_eval"]).repartition(3).cache()


PLAIN = dict(maxIter=12, maxDepth=3, stepSize=0.1, subsamplingRate=1.0, featureSubsetStrategy="all", seed=42)


def margins(model, rows):
    got = model.transform(rows).select(vector_to_array(model.getRawPredictionCol()).alias("r")).collect()
    return np.array([r["r"][1] for r in got])


def test_cut_model_scores_as_a_fit_of_so_many_rounds(spark, rows, tmp_out):
    params = dict(PLAIN, subsamplingRate=0.8, featureSubsetStrategy="0.8")
    fit = rows.where("NOT is_eval")
    long, short = (GBTClassifier(featuresCol="features", labelCol="label", **dict(params, maxIter=n)).fit(fit)
                   for n in (10, 4))
    cut = B.cut(long, 4)
    assert len(cut.treeWeights) == 4 and np.allclose(margins(cut, rows), margins(short, rows), rtol=1e-12)
    cut.write().save(tmp_out)
    again = type(cut).load(tmp_out)
    assert np.array_equal(margins(again, rows), margins(cut, rows))
    assert np.isclose(cut.featureImportances.toArray().sum(), 1.0)
    with pytest.raises(ValueError):
        B.cut(long, 11)


def test_boosting_goes_on_as_one_fit_would(rows):
    """Rounds added to a short ensemble are those of a long one."""
    fit = rows.where("NOT is_eval")
    whole = GBTClassifier(featuresCol="features", labelCol="label", **PLAIN).fit(fit)
    start = GBTClassifier(featuresCol="features", labelCol="label", **dict(PLAIN, maxIter=3)).fit(fit)
    ev = rows.where("is_eval")
    model, losses = B.boost_on(start, rows, "label", "is_eval", start.evaluateEachIteration(ev), params=PLAIN,
                               patience=50)
    assert np.allclose(margins(model, rows), margins(whole, rows), rtol=1e-9)
    assert np.allclose(losses, whole.evaluateEachIteration(ev), rtol=1e-9)


def test_patience_stops_and_cuts(rows):
    noise = rows.withColumn("label", (F.xxhash64(F.monotonically_increasing_id()) % 2 == 0).cast("double")).cache()
    model, losses = B.fit_boosted(noise, "label", "is_eval", params=dict(PLAIN, maxIter=60), patience=3, first_rounds=2)
    keep = len(model.treeWeights)
    assert losses[keep - 1] == min(losses) and len(losses) == keep + 3 < 60
    with pytest.raises(ValueError):
        B.fit_boosted(rows.withColumn("is_eval", F.lit(False)), "label", "is_eval", params=PLAIN)


def focal_cases(spark, n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        c = int(rng.choice(4, p=[0.6, 0.2, 0.15, 0.05]))
        w = [f"class{c if rng.random() < 0.6 else int(rng.integers(0, 4))}w{int(rng.integers(0, 3))}" for _ in range(2)]
        w += [f"noise{int(x)}" for x in rng.integers(0, 5, 2)]
        out.append((i, " ".join(w), c))
    return spark.createDataFrame(out, "id long, text string, y int").repartition(3)


def test_focal_training_lowers_the_focal_loss(spark):
    train, test = focal_cases(spark, 2000, 1), focal_cases(spark, 1000, 2)
    kw = dict(max_features=60, reg=0.02)
    focal, log = ML.train_focal(train, "id", "text", "y", TYPE4, max_rounds=8, **kw)
    plain, _ = ML.train_focal(train, "id", "text", "y", TYPE4, max_rounds=0, **kw)

    def loss(model, df):
        z = model.transform(df).withColumn("z", vector_to_array(model.stages[-1].getRawPredictionCol()))
        return M.focal_loss(z, "y", "z").first()[0]

    rounds = log.orderBy("round").collect()
    assert log.where("kept").count() == 1 and rounds[0]["focal_loss"] > min(r["focal_loss"] for r in rounds)
    assert math.isclose(loss(focal, train), min(r["focal_loss"] for r in rounds), rel_tol=1e-6)
    assert loss(focal, test) < loss(plain, test)


def test_hosted_model_is_loaded_once_and_rows_keep_their_order(spark, tmp_out):
    spark.createDataFrame([(json.dumps({"mean": 10.0}),)], "w string").coalesce(1).write.text(tmp_out)
    texts = ["e" * n for n in (50, 1, 30, 0, 7, 400)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string").coalesce(1)
    got = {r["id"]: r["probs"][1] for r in ML.score_external(
        df, "body", f"{tmp_out}/part-*", Q.length_model, 2, keep=["id"], batch_chars=40).collect()}
    want = Q.length_model(json.dumps({"mean": 10.0}).encode())([t or "" for t in texts])[:, 1]
    assert [got[i] for i in range(len(texts))] == want.tolist()
    calls = []
    for _ in range(3):
        ML.hosted("p", lambda content: calls.append(content) or len, b"x")
    assert calls == [b"x"]


@pytest.mark.parametrize("reader", ["parquet", "csv", "text"])
def test_file_positions_follow_files_and_lines(spark, tmp_out, reader):
    df = spark.range(1000).select(F.format_string("%05d", "id").alias("value"))
    df.repartitionByRange(7, "value").sortWithinPartitions("value").write.format(reader).save(tmp_out)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")           # several splits a file, packed out of order
        back = spark.read.schema("value string").format(reader).load(tmp_out)
        got = J.file_positions(back).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["position"], r["value"]) for r in got) == [(i, f"{i:05d}") for i in range(1000)]


def test_row_positions_and_lengths(spark):
    left = J.row_positions(spark.range(100, numPartitions=6).select(F.col("id").alias("a")))
    right = J.row_positions(spark.range(100, numPartitions=3).select((F.col("id") * 2).alias("b")))
    assert all(r["a"] == r["position"] and r["b"] == 2 * r["a"] for r in J.align_positions(left, right).collect())
    with pytest.raises(ValueError, match="100 rows can't be aligned with 99"):
        J.align_positions(left, right.where("position < 99"))
    with pytest.raises(ValueError, match="both sides"):
        J.align_positions(left, left)
    empty = J.row_positions(spark.range(0).select(F.col("id").alias("b")))
    assert empty.count() == 0 and J.align_positions(left.where("a < 0"), empty).count() == 0


def test_a_save_that_dies_leaves_the_old_version(spark, tmp_out, rows, monkeypatch):
    cases = focal_cases(spark, 60, 5)
    one, two = (ML.train_logistic(cases, "id", "text", "y", TYPE4, max_features=50, max_iter=n) for n in (1, 5))
    probs = lambda m: sorted(tuple(r[0]) for r in ML.score(m, cases).select("probs").collect())
    assert ML.latest_version(tmp_out, "m", spark=spark) is None
    with pytest.raises(LookupError):
        ML.load_model(tmp_out, "m", spark=spark)
    assert ML.save_model(one, tmp_out, "m", label_set=TYPE4, spark=spark) == 1
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        for version in (1, None):
            with pytest.raises(OSError):
                ML.save_model(two, tmp_out, "m", version, TYPE4, spark=spark)
    assert ML.latest_version(tmp_out, "m", spark=spark) == 1
    assert probs(ML.load_model(tmp_out, "m", spark=spark)[0]) == probs(one)
    assert ML.save_model(two, tmp_out, "m", 1, TYPE4, spark=spark) == 1       # the same version again: the last save counts
    loaded, labels = ML.load_model(tmp_out, "m", 1, spark=spark)
    assert probs(loaded) == probs(two) and labels == TYPE4
    assert ML.save_model(one, tmp_out, "m", spark=spark) == ML.latest_version(tmp_out, "m", spark=spark) == 2
    assert ML.load_model(tmp_out, "m", 2, spark=spark)[1] is None


def prf(true, pred, n):
    out = {}
    for c in range(n):
        tp = int(((true == c) & (pred == c)).sum())
        p = tp / max(1, int((pred == c).sum()))
        r = tp / max(1, int((true == c).sum()))
        out[c] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, int((true == c).sum()))
    return out


def test_figures_of_the_reports_follow_from_the_scored_rows(spark):
    for query, scored, label, ls in ((Q.q_priority_figures, Q.priority_scored, "label_p", PRIORITY5),
                                     (Q.q_type_figures, Q.type_scored, "label_t", TYPE4)):
        s = scored(spark, SF_SMALL).select(label, "pred", "probs").toPandas()
        want = prf(s[label].to_numpy(), s["pred"].to_numpy(), len(ls))
        got = {r["row"]: r for r in query(spark, SF_SMALL).collect()}
        for c, name in enumerate(ls.classes):
            r = got[name]
            assert np.allclose([r["precision"], r["recall"], r["f1_score"], r["support"]], want[c], atol=1e-5)
        assert math.isclose(got["accuracy"]["f1_score"], (s[label] == s["pred"]).mean(), abs_tol=1e-5)
        assert math.isclose(got["macro avg"]["f1_score"], np.mean([v[2] for v in want.values()]), abs_tol=1e-5)
        assert s["pred"].equals(s["probs"].map(np.argmax).astype(s["pred"].dtype))
        assert len({tuple(p) for p in s["probs"]}) > len(s) // 2         # not a constant model


def test_figures_of_the_binary_and_joint_models(spark):
    s = Q.binary_scored(spark, SF_SMALL).toPandas()
    got = {r["metric"]: r["value"] for r in Q.q_binary_figures(spark, SF_SMALL).collect()}
    pos, neg = s[s.is_pos == 1].score.to_numpy(), s[s.is_pos == 0].score.to_numpy()
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert math.isclose(got["roc_auc"], auc, rel_tol=1e-9) and s.score.nunique() > 2
    ap, tp, last = 0.0, 0, 0.0
    for v in sorted(s.score.unique(), reverse=True):
        tp = int((pos >= v).sum())
        ap += (tp / len(pos) - last) * tp / int((s.score >= v).sum())
        last = tp / len(pos)
    assert math.isclose(got["average_precision"], ap, rel_tol=1e-9)
    j = Q.two_heads_scored(spark, SF_SMALL).toPandas()
    got = {r["metric"]: r["value"] for r in Q.q_mtl_figures(spark, SF_SMALL).collect()}
    b = (j.logit_b >= 0).astype(int).to_numpy()
    assert math.isclose(got["accuracy_binary"], (b == j.label_b).mean(), rel_tol=1e-9)
    assert math.isclose(got["accuracy_multiclass"], (j.pred == j.label_t).mean(), rel_tol=1e-9)
    assert math.isclose(got["f1_binary"], prf(j.label_b.to_numpy(), b, 2)[1][2], rel_tol=1e-9, abs_tol=1e-12)
    per = prf(j.label_t.to_numpy(), j.pred.to_numpy(), 4)
    assert math.isclose(got["f1_multiclass"], sum(v[2] * v[3] for v in per.values()) / len(j), rel_tol=1e-9)


def test_boosted_predictions_and_rounds(spark):
    s = Q.gbt_scored(spark, SF_SMALL).toPandas().set_index("case_id")
    t = Q.q_gbt_predictions(spark, SF_SMALL).toPandas().set_index("case_id")
    assert t.columns.tolist() == ["Subject", "TextBody", "True_Label", "Predicted_Label", "Complaint_Probability"]
    assert np.allclose(t.Complaint_Probability, s.loc[t.index].probs.map(lambda p: p[1]))
    assert (t.Predicted_Label == (t.Complaint_Probability > 0.5)).all() and t.Complaint_Probability.nunique() > 2
    r = Q.q_gbt_rounds(spark, SF_SMALL).toPandas()
    kept = int(r.kept.sum())
    assert r.loss.idxmin() == kept - 1 and r["round"].tolist() == list(range(1, len(r) + 1))
    model = Q._gbt_model(spark, SF_SMALL)
    assert ML.rounds(model) == kept
    assert Q.q_feature_importance(spark, SF_SMALL).count() == 20
    assert ML.score(model, Q.model_cases(spark, SF_SMALL), BINARY).select("pred_name").distinct().count() >= 1


def test_rounds_over_sparse_rows_are_those_of_the_dense_fit(spark):
    """From the first round on, without sampling, the trees are MLlib's; most values are zero."""
    rng = np.random.default_rng(5)
    x = rng.exponential(size=(1500, 20)) * (rng.random((1500, 20)) < 0.3)
    y = (x[:, 0] - x[:, 1] + x[:, 2] * x[:, 3] + rng.normal(size=1500) * 0.5 > 0.1).astype(float)
    data = [(Vectors.sparse(20, np.flatnonzero(a).tolist(), a[a != 0].tolist()), float(b), i % 5 == 0)
            for i, (a, b) in enumerate(zip(x, y))]
    rows = spark.createDataFrame(data, ["features", "label", "is_eval"]).repartition(3).cache()
    plain = dict(PLAIN, maxDepth=2, maxIter=6)
    whole = GBTClassifier(featuresCol="features", labelCol="label", **plain).fit(rows.where("NOT is_eval"))
    model, losses = B.fit_boosted(rows, "label", "is_eval", params=plain, patience=50, dense_bytes=0)
    n = len(model.treeWeights)
    assert np.allclose(losses, whole.evaluateEachIteration(rows.where("is_eval")), rtol=1e-9)
    assert np.allclose(margins(model, rows), margins(B.cut(whole, n), rows), rtol=1e-9)
    assert np.allclose(model.featureImportances.toArray(), B.cut(whole, n).featureImportances.toArray())
    # With sampling a refit gives the same trees.
    kw = dict(params=dict(plain, subsamplingRate=0.8, featureSubsetStrategy="0.8"), patience=3, dense_bytes=0)
    assert B.fit_boosted(rows, "label", "is_eval", **kw)[1] == B.fit_boosted(rows, "label", "is_eval", **kw)[1]


def test_hosted_model_sees_slices_of_a_batch(spark, tmp_out, monkeypatch):
    """An Arrow batch is scored by slices; kept columns, nulls and the order of rows stay."""
    assert ML.slices([3, 3, 9, 1, 0], 6) == [(0, 2), (2, 3), (3, 5)] and ML.slices([], 6) == []
    monkeypatch.setattr(ML, "SLICE_CHARS", 64)
    spark.createDataFrame([("{}",)], "w string").coalesce(1).write.text(tmp_out)

    def load(content):
        def predict(texts):
            # All characters a call sees: at most those of a slice, unless it is one text.
            seen = sum(map(len, texts)) if len(texts) > 1 else 0
            return np.array([[len(t), seen] for t in texts], dtype=float)
        return predict

    data = [(i, None if i % 7 == 0 else "e" * (i % 40), None if i % 5 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(data, "id long, body string, n int").coalesce(1)
    got = ML.score_external(df, "body", f"{tmp_out}/part-*", load, 2, keep=["id", "n", "body"]).collect()
    assert [(r["id"], r["body"], r["n"]) for r in got] == data
    assert [r["probs"][0] for r in got] == [len(t or "") for _, t, _ in data]
    assert max(r["probs"][1] for r in got) <= 64
