"""Packed terms: the rows of the join by term, of far smaller shuffles."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mailcase.operators import features as FT
from mailcase.operators.packing import numbers_of, packed, packed_terms, terms_of, unpacked
from mailcase.plans.q_features import q_tfidf_full
from mailcase.sources.tables import table


def texts(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["é漢", "ab", f"only{seed}"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(30))) for _ in range(n)] + [None, "", "x", "zz"]


def rows(frame):
    return sorted((str(r[0]), r[1], round(r[2], 9)) for r in frame.collect())


def by_rows(docs, vocab=None):
    """The join by term and the norm by key, of long rows."""
    vocab = vocab or FT.fit_vocabulary(docs, max_features=None)
    return sorted(map(tuple, vocab.collect())), rows(FT.tfidf(FT.doc_terms(docs), vocab))


def by_slices(docs, vocab=None):
    terms = FT.doc_terms(docs, pack=True)
    vocab = vocab or FT.fit_vocabulary(terms, max_features=None)
    return sorted(map(tuple, vocab.collect())), rows(FT.tfidf(terms, vocab))


@pytest.mark.parametrize("kind,key", [("long", lambda i: i), ("long", lambda i: None if i % 20 == 0 else i % 70),
                                      ("string", lambda i: None if i % 20 == 0 else f"k{i % 70}")])
def test_same_rows_as_the_join_by_term(spark, monkeypatch, kind, key):
    """Keys of one document, and keys that repeat or are null; many slices, buckets and common words."""
    for name, few in (("PACKED_BYTES", 300), ("BUCKET_TOKENS", 200), ("COMMON", 5)):
        monkeypatch.setattr(FT, name, few)
    docs = spark.createDataFrame([(key(i), t) for i, t in enumerate(texts(1))], f"doc_id {kind}, text string").repartition(3)
    want = by_rows(docs)
    assert len(want[1]) > 1000 and by_slices(docs) == want


def test_vocabulary_of_other_documents_and_empty_ones(spark):
    docs, other = (spark.createDataFrame(list(enumerate(texts(s))), "doc_id long, text string") for s in (1, 2))
    vocab = FT.fit_vocabulary(other, max_features=None, min_df=1)
    assert by_slices(docs, vocab) == by_rows(docs, vocab)
    for none in (docs.limit(0), docs.where("text IS NULL OR text = ''")):
        assert by_slices(none, vocab)[1] == [] and by_slices(none) == ([], [])


def test_no_term_of_a_document_is_shuffled(spark):
    """Before, each of a document's terms was shuffled by term and its weight by key."""
    q = q_tfidf_full(spark, SF_SMALL)
    q.collect()
    plan = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and "Window" not in plan and "SortMergeJoin" not in plan
    assert set(re.findall(r"hashpartitioning\((\w+)#", plan)) == {"bucket", "slice", "doc_id"}
    assert "ReusedExchange" in plan                     # the fit and the join read the same blocks


def test_what_is_written_and_shuffled_is_smaller_than_the_text(spark):
    docs = table(spark, SF_SMALL, "documents")
    terms = FT.doc_terms(docs, pack=True)
    size = [f.agg(F.sum(F.length("blob"))).first()[0] for f in (terms.slices, terms.blocks)]
    text = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert terms.docs == docs.count() and sum(size) < text


def test_a_very_common_word_is_dealt_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(FT, "BUCKET_TOKENS", 1000)
    docs = spark.createDataFrame([(i, " ".join(f"the w{i * 50 + j}" for j in range(50))) for i in range(200)],
                                 "doc_id long, text string")
    terms = FT.doc_terms(docs, pack=True)
    deal, words = terms._dealer(), pa.array(["the"] + [f"w{i}" for i in range(5000)])
    pairs = np.arange(1, 5001) + 1                        # "the w0", "the w1", ...
    many = np.bincount(deal(pairs, words), minlength=terms.size)
    assert terms.size == 20 and many.max() < 5000 / 4


def test_packed_numbers_and_terms_come_back():
    x = [np.array([0, 3, 70_000]), np.array([]), np.array([0.5, np.nan, -1.0]), np.array([255, 256])]
    for a, b in zip(x, unpacked(packed(*x))):
        assert np.array_equal(a, b, equal_nan=True)
    words = pa.array(["aa", "éé", "cc"])
    code, bucket, df = np.array([0, 1, 3, 4, 6, 9]), np.array([1, 0, 1, 0, 2, 1]), np.array([1, 2, 3, 4, 5, 600])
    of, blobs = zip(*packed_terms(code, words, bucket, df))
    parts = [unpacked(b) for b in blobs]
    got, known, many = terms_of(parts)
    order = np.argsort(bucket, kind="stable")
    assert of == (0, 1, 2) and many.tolist() == [2, 3, 1] and numbers_of(parts, 0).tolist() == df[order].tolist()
    assert FT._spelled(got, known).to_pylist() == FT._spelled(code[order], words).to_pylist()
    assert list(packed_terms(code[:0], words, bucket[:0])) == []
