"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailcase.llm.decontamination import decontaminate
from mailcase.llm.exact_dedup import exact_dedup
from mailcase.llm.line_dedup import line_dedup
from mailcase.llm.mixing import mix, mixture
from mailcase.llm.near_dedup import near_dedup
from mailcase.llm.quality import quality_scores
from mailcase.llm.secrets import secret_scan
from mailcase.llm.substring_dedup import substring_dedup
from mailcase.llm.token_counts import token_counts
from mailcase.llm.toxicity import toxicity_scores

from .conftest import EDGE, LINE, LONG, WORDS


def ids(rows, name="doc_id"):
    return Counter(r[name] for r in rows)


EVERY = Counter(i for i, _, _ in EDGE)


def test_substring_dedup(edge, empty):
    got = substring_dedup(edge).collect()
    assert ids(got) == EVERY
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[1, 0].kept_text == "" and by[2, 0].n_removed == 0 and by[3, 0].n_words == 0
    assert by[None, 61].n_removed == 0          # a null key is smallest, so it is first
    assert by[4, 60].n_removed == 60 and by[4, 60].kept_text == ""
    assert [r.n_removed for r in got if r.doc_id == 5] == [60, 60]
    assert by[7, 60].n_removed == 0             # words are compared unchanged
    assert by[14, 62].kept_text == "w60 w61" and by[14, 62].spans[0].asDict() == {"start": 0, "end": 60}
    assert by[13, 3000].n_removed == 2999       # a run of one word repeats itself
    assert by[9, 1].n_removed == 0 and by[8, 120_000].n_words == len(LONG.split())
    assert substring_dedup(empty).collect() == []


def test_decontaminate(edge, empty, benchmark, spark):
    got = decontaminate(edge, benchmark).collect()
    assert ids(got) == EVERY
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[4, 60].n_hit == 20 and by[4, 60]["items"] == ["1"] and by[4, 60].contaminated
    assert by[7, 60].n_hit == 20
    assert by[6, 1]["items"] == [""] and by[6, 6]["items"] == ["2"] and by[6, 6].n_hit == 2
    assert by[1, 0].n_hit == 0 and not by[1, 0].contaminated
    small = decontaminate(edge, benchmark, max_windows=3).collect()
    assert sorted(map(str, small)) == sorted(map(str, got))     # more blocks, same rows
    assert decontaminate(empty, benchmark).collect() == []
    assert all(r.n_hit == 0 for r in decontaminate(edge, benchmark.limit(0)).collect())


def test_mixing(edge, empty):
    got = mix(edge).collect()
    assert ids(got) == EVERY
    sizes = Counter()
    for _, t, s in EDGE:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert {r.source: r.source_size for r in got} == sizes
    target = {r.source: r.target for r in got}
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(target[s] <= 3 * sizes[s] for s in sizes)
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert mix(empty).collect() == [] and mixture(empty).collect() == []
    out = mixture(edge)
    assert out.columns == edge.columns and out.count() == sum(r.copies for r in got)


def test_exact_dedup(edge, empty):
    got = exact_dedup(edge).collect()
    assert ids(got) == EVERY
    same = [r for r in got if r.group_size == 4]                 # 4, 5, 5 and 7 (upper case)
    assert ids(same) == Counter({4: 1, 5: 2, 7: 1}) and {r.keep_id for r in same} == {7}
    blank = [r for r in got if r.group_size == 3]                # null, empty, null key
    assert {r.keep_id for r in blank} == {2} and sum(r.kept for r in blank) == 1
    assert exact_dedup(empty).collect() == []


def test_exact_dedup_with_colliding_chunk_hashes(edge):
    def poor(c):
        return (F.length(c) % 3).cast("long")

    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text_sha256)
    good, bad = (sorted(exact_dedup(edge, **k).collect(), key=key) for k in ({}, {"chunk_hash": poor}))
    assert good == bad


def test_token_counts(edge, empty):
    got = token_counts(edge).collect()
    assert sum(r.n_docs for r in got) == len(EDGE)
    first = min(got, key=lambda r: r.n_tokens)
    assert first.n_tokens == 0 and first.docs_at_least == len(EDGE) and first.truncated_total == 0
    assert token_counts(empty).collect() == []


def test_near_dedup(edge, empty):
    got = near_dedup(edge).collect()
    assert ids(got) == EVERY
    classes = {r.doc_id: r.class_id for r in got if r.doc_id not in (None, 6)}
    assert classes[4] == classes[5] == classes[7] == classes[14] == 4
    assert [classes[i] for i in (1, 2, 3, 8, 9, 13)] == [1, 2, 3, 8, 9, 13]
    tail = [r for r in got if r.doc_id is None and r.class_id is not None]
    assert [(r.class_id, r.kept) for r in tail] == [(4, False)]
    assert near_dedup(empty).collect() == []


@pytest.mark.parametrize("fn, label", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_classifiers(fn, label, edge, empty, labels):
    got = fn(edge, labels).collect()
    assert ids(got) == EVERY and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    none = fn(edge, labels.where("doc_id < 0")).collect()
    assert {r.score for r in none} == {0.5}
    assert fn(empty, labels).collect() == []


def test_secret_scan(spark, edge, empty):
    assert ids(secret_scan(edge).collect()) == EVERY
    assert secret_scan(empty).collect() == []


def test_line_dedup(edge, empty):
    got = line_dedup(edge).collect()
    assert Counter(r.row.doc_id for r in got) == EVERY
    by = {r.row.doc_id: r for r in got if r.row.doc_id not in (None, 5, 6)}
    assert (by[1].n_lines, by[1].n_dropped, by[1].kept_text) == (1, 0, "")
    assert (by[10].n_dropped, by[10].kept_text) == (1, "own ten")
    assert (by[11].n_dropped, by[11].kept_text) == (1, "own eleven")
    assert by[12].n_dropped == 0 and by[12].kept_text == f"{LINE}\n{LINE}\nown twelve"
    # WORDS stands in 4, 5 and 7 (the repeated row of 5 is one document); 7 keeps it.
    assert by[4].kept_text == "" and by[7].n_dropped == 0
    assert by[14].n_dropped == 0 and WORDS in by[14].kept_text
    assert line_dedup(empty).collect() == []


def test_pipeline(spark, edge, empty, labels, benchmark, tmp_out):
    import corpus_pipeline as P

    labels.write.parquet(f"{tmp_out}/labels.parquet")
    benchmark.write.parquet(f"{tmp_out}/benchmark.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for docs in (edge, empty):
        for name, stage in P.STAGES:
            out = stage(spark, docs, tmp_out)
            assert out.columns == docs.columns, name
            assert out.schema.simpleString() == docs.schema.simpleString()
            out.count()
    kept = P.near_duplicates(spark, edge, tmp_out).collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 2, 3, 4, 6, 6, 8, 9, 10, 11, 12, 13, None])
    clean = {r.doc_id for r in P.decontamination(spark, edge, tmp_out).collect()}
    assert clean == {1, 2, 3, 8, 9, 10, 11, 12, 13, None}


def test_mix_joins_sources_that_are_not_broadcast(spark, monkeypatch):
    from mailcase.llm import mixing

    docs = spark.createDataFrame([(i, "a b c " * (i % 5), f"s{i % 4}" if i % 7 else None) for i in range(60)],
                                 "doc_id long, text string, source string")
    expected = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    joined = mixing.mix(docs)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, joined.collect())) == expected


def test_a_labelled_key_of_many_rows_weighs_as_one(spark):
    """A third of the rows share one labelled key: the model is that of one of its texts."""
    from .conftest import documents

    rows = [(i, f"{'you are a vile liar' if i % 2 else 'thank you for the kind note'} number {i}", "s")
            for i in range(60)]
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    one = {r.doc_id: r.score for r in toxicity_scores(documents(spark, rows), table).collect()}
    many = toxicity_scores(documents(spark, rows + [rows[7]] * 30).repartition(4), table).collect()
    assert len(many) == 90 and all(abs(one[r.doc_id] - r.score) < 1e-12 for r in many)
