"""Headers in one job, salted joins, and languages of a batch at once."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from mailcase.operators import joins as J
from mailcase.operators import language as L
from mailcase.sources import cases as S


def put(spark, path, lines, encoding="UTF-8"):
    """Files of the given lines, written by Spark, one file per entry."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").repartitionByRange(
        len(lines), "i")
    df.select("value").write.text(path)


def test_files_of_different_headers_are_read_by_name(spark, tmp_out):
    put(spark, tmp_out, ["a;b;c\n1;2;3\n4;5\n6;7;8;9", "﻿c;a\n30;10\n31;11;12\n\"x;\ny\";\"\"", "a;b;c\n;NA;z", "d\nq"])
    got = S.read_cases(spark, f"{tmp_out}/part-*")
    assert sorted(got.columns) == ["a", "b", "c", "d"]
    rows = sorted(((r.a, r.b, r.c, r.d) for r in got.collect()), key=str)
    assert rows == sorted([("1", "2", "3", None), ("4", "5", None, None), ("10", None, "30", None),
                           (None, None, "x;\ny", None), (None, None, "z", None), (None, None, None, "q")], key=str)
    longer = S.read_cases(spark, f"{tmp_out}/part-*", skip_long_rows=False)
    assert longer.count() == 8


def jobs(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_files(spark, tmp_out):
    put(spark, f"{tmp_out}/few", ["a;b\n1;2"] * 3)
    put(spark, f"{tmp_out}/many", ["a;b\n1;2", "b;c\n3;4"] * 60)
    few = jobs(spark, "few-files", lambda: S.read_cases(spark, f"{tmp_out}/few/part-*"))
    many = jobs(spark, "many-files", lambda: S.read_cases(spark, f"{tmp_out}/many/part-*"))
    # Beyond 32 paths Spark lists them in a job of its own, once a read.
    assert 0 < few <= 8 and 0 < many <= few + 4
    assert S.read_cases(spark, f"{tmp_out}/many/part-*").count() == 120


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_is_the_join_and_spreads_a_hot_parent(spark, null_safe):
    emails = spark.range(9000).select(
        F.col("id").alias("case_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
            F.concat(F.lit("P"), F.col("id") % 500)).alias("ParentId"))
    meta = spark.createDataFrame([("hot", "x"), ("hot", "y"), (None, "none")] + [(f"P{i}", f"s{i}") for i in range(0, 500, 2)],
                                 "Id string, Segment string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(kept, ("false", "-1", "32")):
            spark.conf.set(k, v)
        assert J.hot_keys(emails, "ParentId", 0.05) == ["hot"]
        plain = J.join_metadata(emails, meta, "ParentId", "Id", null_safe=null_safe)
        salted = J.join_metadata_salted(emails, meta, "ParentId", "Id", null_safe=null_safe, share=0.05)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
        most = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert most(plain) > 6000 and most(salted) < 1500
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_languages_of_a_batch_equal_those_one_by_one():
    rng = np.random.default_rng(4)
    letters = list("abcdé日 🙂")
    texts = [None, "", "  "] + [" " + "".join(rng.choice(letters, int(n))) + " " for n in rng.integers(1, 40, 200)]
    known = sorted({t[i:i + 3] for t in texts if t for i in range(len(t) - 2)})[::2]
    logs = rng.random((len(known) + 1, 3))
    logs[-1] = 0
    norm = np.array([1.0, 1.1, 0.9])
    keys = np.array([L.trigram_keys(k)[0] for k in known])
    order = np.argsort(keys)
    want = []
    for t in texts:
        if t is None or len(t) < 3:
            want.append(-1)
            continue
        at = {k: i for i, k in enumerate(known)}
        ids = [at.get(t[i:i + 3], -1) for i in range(len(t) - 2)]
        want.append(int(np.argmax(logs[ids].sum(axis=0) - len(ids) * norm)))
    table = np.concatenate([logs[:-1][order], logs[-1:]])
    for piece in (1, 50, 1 << 18):
        assert L.best_languages(texts, keys[order], table, norm, piece) == want
    assert L.best_languages(["abc", None], keys[:0], np.zeros((1, 3)), norm) == [2, -1]
