import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_MED, SF_SMALL
from mailcase.functions.labels import BINARY, PRIORITY5
from mailcase.operators import features as FT
from mailcase.operators import models as ML
from mailcase.operators import sampling as X
from mailcase.plans.q_models import model_cases
from mailcase.sources.tables import table


def test_split_disjoint_complete_and_exact(spark):
    d = table(spark, SF_MED, "documents").select("doc_id")
    n = d.count()
    tr, te = X.split(d, "doc_id", 0.8, 42)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in te.collect()}
    assert not a & b and len(a | b) == n
    tr2, te2 = X.split(d, "doc_id", 0.8, 42, exact=True)
    assert tr2.count() == round(0.8 * n) and tr2.count() + te2.count() == n
    # the same rows for any partitioning
    tr3, _ = X.split(d.repartition(3), "doc_id", 0.8, 42)
    assert {r[0] for r in tr3.collect()} == a


def test_cap_per_class(spark):
    d = table(spark, SF_MED, "documents").select("doc_id", "lang")
    capped = X.cap_per_class(d, "lang", 7, "doc_id")
    counts = dict(capped.groupBy("lang").count().collect())
    assert set(counts.values()) == {7}
    firsts = {r[0]: r[1] for r in d.groupBy("lang").agg(F.min("doc_id")).collect()}
    got = {r[0]: r[1] for r in capped.groupBy("lang").agg(F.min("doc_id")).collect()}
    assert got == firsts


def test_vocabulary_bounds(spark):
    docs = table(spark, SF_SMALL, "documents")
    v = FT.fit_vocabulary(docs, "doc_id", "text", max_features=50)
    rows = v.collect()
    n = docs.count()
    assert len(rows) == 50
    assert all(2 <= r["df"] <= 0.95 * n for r in rows)
    for r in rows:
        assert math.isclose(r["idf"], math.log((1 + n) / (1 + r["df"])) + 1, rel_tol=1e-12)


def test_long_form_equals_mllib_featurizer(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    vocab = FT.fit_vocabulary(docs, "doc_id", "text", max_features=200)
    long = FT.tfidf(FT.doc_terms(docs, "doc_id", "text"), vocab, "doc_id")
    want = {(r[0], r[1]): r[2] for r in long.collect()}
    feat = FT.featurizer(vocab, "text")
    terms = feat.stages[2].vocabulary
    arr = feat.transform(docs).select("doc_id", vector_to_array("features").alias("v"))
    got = {}
    for r in arr.collect():
        for i, x in enumerate(r["v"]):
            if x != 0.0:
                got[(r["doc_id"], terms[i])] = x
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_unseen_terms_ignored(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    vocab = FT.fit_vocabulary(docs, "doc_id", "text", max_features=100)
    feat = FT.featurizer(vocab, "text")
    odd = spark.createDataFrame([(1, "zzqx qqzv"), (2, None)], "doc_id long, text string")
    out = feat.transform(odd).select(vector_to_array("features").alias("v")).collect()
    assert all(sum(r["v"]) == 0.0 for r in out)


def test_logistic_deterministic_and_save_load(spark, tmp_out):
    c = model_cases(spark, SF_SMALL)
    train = c.where("is_train")
    m1 = ML.train_logistic(train, "case_id", "text", "label_p", PRIORITY5, weighted=True,
                           max_features=300, max_iter=20)
    m2 = ML.train_logistic(train, "case_id", "text", "label_p", PRIORITY5, weighted=True,
                           max_features=300, max_iter=20)
    test = c.where(~F.col("is_train"))
    s1 = {r[0]: tuple(r[1]) for r in ML.score(m1, test, keep=["case_id"]).select(
        "case_id", "probs").collect()}
    s2 = {r[0]: tuple(r[1]) for r in ML.score(m2, test, keep=["case_id"]).select(
        "case_id", "probs").collect()}
    assert s1 == s2
    ML.save_model(m1, tmp_out, "priority", 1, PRIORITY5)
    m3, ls = ML.load_model(tmp_out, "priority", 1)
    assert ls.classes == PRIORITY5.classes
    s3 = {r[0]: tuple(r[1]) for r in ML.score(m3, test, keep=["case_id"]).select(
        "case_id", "probs").collect()}
    assert s3.keys() == s1.keys()
    assert all(math.isclose(a, b, rel_tol=1e-12) for k in s1 for a, b in zip(s1[k], s3[k]))
    assert all(math.isclose(sum(p), 1.0, rel_tol=1e-9) for p in s1.values())


def test_gbt_seeded_and_importance(spark):
    c = model_cases(spark, SF_SMALL)
    train = c.where("is_train")
    kw = dict(max_features=200, params={"maxIter": 5})
    m1 = ML.train_gbt(train, "case_id", "text", "label_b", **kw)
    m2 = ML.train_gbt(train, "case_id", "text", "label_b", **kw)
    p1 = ML.score(m1, c, BINARY, keep=["case_id"]).orderBy("case_id").collect()
    p2 = ML.score(m2, c, BINARY, keep=["case_id"]).orderBy("case_id").collect()
    assert p1 == p2
    imp = ML.feature_importance(m1, 10).collect()
    assert len(imp) == 10
    keys = [(-r["importance"], r["term"]) for r in imp]
    assert keys == sorted(keys)


def test_vector_entries_sparse_and_dense(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.sparse(6, [1, 4], [0.5, 0.25])),
                                (2, Vectors.dense([0.0, 2.0, 0.0, 3.0])),
                                (3, Vectors.sparse(3, [], []))], ["id", "v"])
    got = {r["id"]: [(e["i"], e["x"]) for e in r["e"]]
           for r in df.select("id", FT.vector_entries("v").alias("e")).collect()}
    assert got == {1: [(1, 0.5), (4, 0.25)], 2: [(1, 2.0), (3, 3.0)], 3: []}
    parsed = df.select("id", FT.vector_struct("v").alias("s")).select(
        "id", FT.vector_entries("s", parsed=True).alias("e"))
    assert {r["id"]: [(e["i"], e["x"]) for e in r["e"]] for r in parsed.collect()} == got
