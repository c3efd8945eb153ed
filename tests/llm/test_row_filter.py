"""Filter of rows: no false negative, few others; rows named by 128 bits; draws of a hot key."""
import re

import pytest
from pyspark.sql import functions as F

from mailcase.llm import bloom
from mailcase.llm.line_dedup import line_dedup
from mailcase.llm.mixing import mix
from mailcase.llm.substring_dedup import substring_dedup

from .conftest import documents
from .test_pipeline import TWINS


@pytest.mark.parametrize("max_bits, shard_bits", [(1 << 28, 1 << 23), (1 << 28, 1 << 13), (1 << 14, 1 << 12)])
def test_every_listed_row_passes(spark, monkeypatch, max_bits, shard_bits):
    monkeypatch.setattr(bloom, "SHARD_BITS", shard_bits)
    keys = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("t"))
    test = bloom.row_filter(keys, max_bits)
    rows = spark.range(-20_000, 3000).select(F.when(F.col("id") != 0, F.col("id").cast("int")).alias("i"))
    got = rows.withColumn("hit", test("i", F.lit("x"))).groupBy(F.coalesce("i", F.lit(0)) >= 0).agg(
        F.count_if("hit").alias("n"), F.count(F.lit(1)).alias("all")).collect()
    by = {r[0]: (r.n, r["all"]) for r in got}
    assert by[True] == (3000, 3000)
    assert max_bits < 1 << 20 or by[False][0] < 60
    assert bloom.row_filter(keys.limit(0))("k", "t") is not None
    assert rows.where(bloom.row_filter(keys.limit(0))("i", F.lit("x"))).count() == 0


def test_texts_of_one_key_with_equal_short_hashes_keep_their_own_spans(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(0, passage, "s"), (1, TWINS[0], "s"), (1, TWINS[1], "s"), (1, f"{TWINS[0]} {passage}", "s")]
    got = {(r.doc_id, r.kept_text) for r in substring_dedup(documents(spark, rows)).collect()}
    assert got == {(0, passage), (1, TWINS[0]), (1, TWINS[1]), (1, TWINS[0])}


def test_texts_without_a_finding_are_not_shuffled(spark):
    own = [(i, f"a line of document number {i} alone", "s") for i in range(50)]
    line = " ".join(f"p{i}" for i in range(25))
    docs = documents(spark, own + [(100 + i, line, "s") for i in range(5)])
    for df in (line_dedup(docs), substring_dedup(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Union\n")[1].split("\n")
        # The last branch of the union: rows that the filter does not know, from the scan to the result.
        last = next(i for i, x in enumerate(plan) if re.match(r" +\+- ", x))
        joined, rest = "\n".join(plan[:last]), "\n".join(plan[last:])
        assert "Exchange" in joined and "NOT pythonUDF" in rest and "Exchange" not in rest
        assert df.count() == 55


def test_a_key_on_a_third_of_the_rows_draws_text_by_text(spark):
    rows = [(7 if i % 3 == 0 else 1000 + i, f"word{i} and some others", f"s{i % 3}") for i in range(3000)]
    for r in mix(documents(spark, rows)).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 0.05 * r.target
