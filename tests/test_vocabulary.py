"""Vocabulary by sketches: same rows as counting every term, proofs and the exact way out."""
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_MED, SF_SMALL
from mailcase.operators import features as FT
from mailcase.sources.tables import table


def brute(texts, k, min_df=2, max_df=0.95):
    bags = []
    for t in texts:
        w = [x for x in t.lower().split() if len(x) > 1]
        bags.append(Counter(w + [" ".join(p) for p in zip(w, w[1:])]))
    df = Counter(t for b in bags for t in b)
    cf = sum(bags, Counter())
    ok = [t for t in df if min_df <= df[t] <= max_df * len(texts)]
    ok = sorted(ok, key=lambda t: (-cf[t], t))[:k]
    return [(t, df[t], cf[t]) for t in ok]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


def found(v):
    return [tuple(r) for r in v.orderBy(F.desc("cf"), "term").select("term", "df", "cf").collect()]


def words(seed, n, vocabulary, size=30):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(f"w{x}" for x in rng.choices(range(vocabulary), weights, k=size)) for _ in range(n)]


@pytest.mark.parametrize("shards,tracked", [(FT.SHARDS, FT.TRACKED), (4, 64), (2, 1024)])
def test_same_rows_as_counting_all(spark, shards, tracked):
    texts = words(1, 400, 3000)
    v = FT.fit_vocabulary(frame(spark, texts), max_features=8, shards=shards, tracked=tracked)
    assert found(v) == brute(texts, 8)


def test_sketches_hold_fewer_terms_and_still_prove(spark):
    """Sketches that had to drop terms bound them, and the bound proves the result."""
    texts = words(2, 800, 20_000, size=60)
    docs = frame(spark, texts)
    candidates, bound = FT.heavy_terms(docs, 64, shards=4, tracked=512)
    counts = {r.term: r.cf for r in FT.term_counts(docs).collect()}
    assert len(counts) > 30_000 and len(candidates) == 64 and bound > 0
    assert max(c for t, c in counts.items() if t not in set(candidates)) <= bound
    rows = FT.proven_vocabulary(docs, 8, 2, 0.95 * 800, shards=4, tracked=512)
    assert rows == brute(texts, 8)


def test_exact_way_out_where_the_bound_is_tight(spark):
    """All terms occur equally often: nothing is above the bound, so all terms are counted."""
    texts = [" ".join(f"t{(i * 7 + j) % 1500:04d}" for j in range(30)) for i in range(1500)]
    docs = frame(spark, texts)
    assert FT.proven_vocabulary(docs, 10, 2, 1425, bigrams=False, shards=2, tracked=64) is None
    v = FT.fit_vocabulary(docs, max_features=10, bigrams=False, shards=2, tracked=64)
    assert [t for t, _, _ in found(v)] == [f"t{i:04d}" for i in range(10)]


def test_no_proof_while_candidates_tie_with_the_rest(spark):
    """Two terms tie at the last place and only one of them is a candidate."""
    texts = ["aa bb cc dd"] * 4 + ["aa"] * 3
    docs = frame(spark, texts)
    candidates, bound = FT.heavy_terms(docs, 2, bigrams=False)
    assert candidates == ["aa", "bb"] and bound == 4
    old, FT.CANDIDATES = FT.CANDIDATES, 1
    try:
        assert FT.proven_vocabulary(docs, 2, 2, 7, bigrams=False) is None
        assert FT.proven_vocabulary(docs, 1, 2, 7, bigrams=False) == [("aa", 7, 7)]
        assert found(FT.fit_vocabulary(docs, max_features=2, max_df=7, bigrams=False)) == [("aa", 7, 7), ("bb", 4, 4)]
    finally:
        FT.CANDIDATES = old


def test_rare_terms_only_and_empty(spark):
    texts = ["only once", "never again", ""]
    assert found(FT.fit_vocabulary(frame(spark, texts), max_features=5)) == []
    assert found(FT.fit_vocabulary(frame(spark, texts).limit(0), max_features=5)) == []
    assert found(FT.fit_vocabulary(frame(spark, texts), max_features=5, min_df=1)) == brute(texts, 5, 1)


def test_shuffle_of_the_fit_carries_sketches_and_candidates(spark):
    docs = table(spark, SF_MED, "documents").select("doc_id", "text")
    for plan in (FT.term_sketches(docs), FT.candidate_counts(docs, ["the", "of the"])):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1
        assert "hashpartitioning(term" not in text


def test_row_local_tfidf_has_no_exchange_and_equals_the_join(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    v = FT.fit_vocabulary(docs, max_features=300)
    rows = FT.tfidf_rows(docs, v)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {(r[0], r[1]): r[2] for r in rows.collect()}
    want = {(r[0], r[1]): r[2] for r in FT.tfidf(FT.doc_terms(docs), v).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_doc_terms_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "aa bb aa bb aa"), (2, None), (3, ""), (4, "x"), (5, "zz")],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in FT.doc_terms(docs).collect())
    assert got == [(1, "aa", 3), (1, "aa bb", 2), (1, "bb", 2), (1, "bb aa", 2), (5, "zz", 1)]
    assert sorted(r[0] for r in FT.term_rows(docs).collect()) == sorted(
        ["aa", "bb", "aa", "bb", "aa", "aa bb", "bb aa", "aa bb", "bb aa", "zz"])


def test_tokens_cut_in_numpy_are_those_of_the_regex(spark):
    """Letters of 1 to 4 bytes, marks, digits, borders of rows; one slice for all and one a row."""
    rng = random.Random(5)
    odd = ["", None, "a", "ab", "\u00e9", "\u00e9a", "\u0130stanbul \u0131I", "\u6f22\u5b57 \u4eee\u540d a\u6f22", "\U0001f642ab\U0001f642",
           "\U00010400\U00010401x \U0001d49c", "a\u0301b cd", "\u0663\u0664 \u00bd\u00bd", "_a __ _", "ab", "ab"]
    odd += ["".join(chr(rng.choice([32, 97, rng.randrange(33, 127), rng.randrange(0xA0, 0x600), rng.randrange(0x900, 0xD7FF),
                                    rng.randrange(0xE000, 0x1FFFF)])) for _ in range(80)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").coalesce(1)
    want = Counter()
    for r in FT._with_terms(docs, "text", True, "doc_id").collect():
        want.update((r.doc_id, t) for t in r["_t"])
    df = Counter(t for _, t in want)
    old = FT.SLICE_ROWS
    for FT.SLICE_ROWS in (old, 1):
        try:
            assert {(r.doc_id, r.term): r.tf for r in FT.doc_terms(docs).collect()} == dict(want)
            assert {r.term: r.df for r in FT.term_counts(docs).collect()} == dict(df)
        finally:
            FT.SLICE_ROWS = old


def test_terms_are_counted_before_they_reach_spark(spark):
    """No regex, no explode and no lambda per term in the plans of the counts."""
    docs = spark.createDataFrame([(1, "aa bb")], "doc_id long, text string")
    for plan in (FT.doc_terms(docs), FT.term_counts(docs), FT.term_sketches(docs)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in text and "regexp_extract_all" not in text and "Generate" not in text
    assert "transform(" not in FT._bigram_sql()
