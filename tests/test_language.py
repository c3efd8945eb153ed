from dataclasses import replace

from conftest import SF_MED
from mailcase.operators.language import (UNKNOWN, fit_language_model, keep_language,
                                         sentence_languages)
from mailcase.operators.sampling import in_sample
from mailcase.sources.tables import table


def _model(spark):
    d = table(spark, SF_MED, "documents")
    return fit_language_model(d.where(in_sample("doc_id", 0.8, 42)), "doc_id", "text", "lang")


def test_holdout_accuracy_and_paths_agree(spark):
    m = _model(spark)
    assert m.languages == ["de", "en", "es", "fr"]
    assert m.n_trigrams == m.profile.count()
    test = table(spark, SF_MED, "documents").where(~in_sample("doc_id", 0.8, 42))
    a = {r[0]: r[1] for r in m.detect(test, ["doc_id"], "text").collect()}
    shuffled = replace(m, broadcast_max_bytes=0)   # force the shuffle-join path
    b = {r[0]: r[1] for r in shuffled.detect(test, ["doc_id"], "text").collect()}
    assert a == b
    truth = {r[0]: r[1] for r in test.select("doc_id", "lang").collect()}
    correct = sum(a[k] == truth[k] for k in truth)
    assert correct / len(truth) > 0.95


def test_unknown_and_keep_language(spark):
    m = _model(spark)
    df = spark.createDataFrame(
        [(1, None), (2, "1234 !!"), (3, "the cat sat on the mat. le chat est sur le tapis"),
         (4, "")], "doc_id long, text string")
    det = {r[0]: r[1] for r in m.detect(df, ["doc_id"], "text").collect()}
    assert det[1] == UNKNOWN and det[2] == UNKNOWN and det[4] == UNKNOWN
    kept = {r[0]: r[1] for r in keep_language(df, "doc_id", "text", m, "en").collect()}
    assert kept[1] is None
    assert kept[2] == "" and kept[4] == ""
    assert kept[3] == "the cat sat on the mat"
    assert det[3] in m.languages


def test_sentence_languages(spark):
    m = _model(spark)
    df = spark.createDataFrame([(7, "the cat sat on the mat. der Hund ist im Haus")],
                               "doc_id long, text string")
    rows = sorted((r["pos"], r["sentence"], r["lang"])
                  for r in sentence_languages(df, "doc_id", "text", m).collect())
    assert [(p, s) for p, s, _ in rows] == [(0, "the cat sat on the mat"), (1, "der Hund ist im Haus")]
    assert rows[0][2] == "en" and rows[1][2] == "de"


def test_languages_are_a_label_set_or_few(spark):
    import pytest
    from mailcase.operators.language import MAX_LANGUAGES, fit_language_model

    rows = [(i, f"some words {i}", f"l{i}") for i in range(MAX_LANGUAGES + 1)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    with pytest.raises(ValueError, match="give the languages"):
        fit_language_model(df, "id", "text", "lang")
    assert fit_language_model(df, "id", "text", "lang", languages=["l2", "l1"]).languages == ["l1", "l2"]


def test_sentences_are_scored_in_the_row(spark):
    m = _model(spark)
    d = table(spark, SF_MED, "documents").where("doc_id < 200")
    kept = keep_language(d, "doc_id", "text", m, "en")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    joined = replace(m, row_max_bytes=0)          # profile taken for too large
    other = keep_language(d, "doc_id", "text", joined, "en")
    assert sorted(kept.collect()) == sorted(other.collect())
    a, b = (sentence_languages(d, "doc_id", "text", x) for x in (m, joined))
    assert sorted(a.collect()) == sorted(b.collect())


def test_repeated_sentences_count_once(spark):
    m = _model(spark)
    df = spark.createDataFrame([(1, "the cat sat. der Hund. the cat sat"), (2, None)],
                               "doc_id long, text string")
    rows = sentence_languages(df, "doc_id", "text", m, distinct=True).collect()
    assert sorted((r["pos"], r["sentence"]) for r in rows) == [(0, "the cat sat"), (1, "der Hund")]


def test_sums_in_the_row_are_those_of_the_join(spark):
    """Repeated and null keys, texts without letters, and texts longer than a piece."""
    import numpy as np
    from pyspark.sql import functions as F

    from mailcase.operators import language as L
    from mailcase.operators.language import trigram_keys, trigram_sums

    texts = [(1, "de kat zit op de mat", "nl"), (2, "the cat sat on the mat é", "en"), (2, "een twee drie", "nl"),
             (None, "one two three", "en"), (None, None, "nl"), (3, "12 34", "en"), (4, "zzz qqq", "nl"),
             (5, "the cat " * 50 + "de mat", "en")]
    df = spark.createDataFrame(texts, "id long, text string, lang string").repartition(3)
    m = fit_language_model(df.where("id IS NULL OR id < 4"), "id", "text", "lang")
    plain = df.where("id IS NULL OR id < 4").select("lang", F.explode(L.trigrams("text")).alias("trigram")).groupBy(
        "lang", "trigram").count().collect()
    for i, lang in enumerate(m.languages):
        want = {r["trigram"]: r["count"] for r in plain if r["lang"] == lang}
        got = {r["trigram"]: round(np.expm1(r[f"_l{i}"])) for r in m.profile.collect()}
        assert {k: v for k, v in got.items() if v} == want
    row, joined = m.detect(df, ["id"], "text"), replace(m, row_max_bytes=0).detect(df, ["id"], "text")
    assert "BroadcastHashJoin" not in row._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, row.collect())) == sorted(map(str, joined.collect()))
    text = " the cat sat on the mat "
    keys = np.unique(trigram_keys(text))
    logs = np.concatenate([np.arange(len(keys), dtype=float)[:, None], np.zeros((1, 1))])
    for piece in (4, 1 << 18):
        n, s = trigram_sums([text, None, " ab "], keys, logs, piece)
        assert n.tolist() == [22, 0, 2] and s[0, 0] == np.searchsorted(keys, trigram_keys(text)).sum() and s[2, 0] == 0
