from pyspark.sql import functions as F

from mailcase.functions import labels as L
from mailcase.operators import filters as P


def test_auto_reply_rule(spark):
    rows = [(1, "Automatic reply: x"), (2, "fw: hello"), (3, "Software: x"), (4, None),
            (5, "Order 5"), (6, "AUTOMATISCH ANTWOORD"), (7, "re")]
    df = spark.createDataFrame(rows, "id int, Subject string")
    kept = sorted(r[0] for r in P.drop_auto_replies(df).collect())
    assert kept == [4, 5, 7]


def test_complaint_flag_and_null_halves(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Quality")], "id int, t string")
    flags = {r[0]: r[1] for r in df.select("id", L.is_complaint("t")).collect()}
    assert flags == {1: False, 2: False, 3: True}
    a, b = P.partition_by_null(df, "t")
    assert sorted(r[0] for r in a.collect()) == [2, 3]
    assert [r[0] for r in b.collect()] == [1]


def test_remove_rows_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "Not applicable"), (2, None), (3, "x")], "id int, t string")
    assert sorted(r[0] for r in P.remove_rows(df, "t", "Not applicable").collect()) == [2, 3]


def test_normalize_na(spark):
    df = spark.createDataFrame([("NA",), ("nan",), ("",), ("ok",), ("null",)], "t string")
    assert [r[0] for r in P.normalize_na(df).collect()] == [None, None, None, "ok", None]


def test_prefix_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Id int, Meta_x int")
    assert P.prefix_columns(df, "Meta_").columns == ["Meta_Id", "Meta_x"]


def test_label_sets(spark):
    df = spark.createDataFrame(
        [(None,), ("",), (" Normal ",), ("normal",), ("Urgent",), ("nan",), ("Critical",)],
        "p string")
    r = df.select(L.priority5_label("p").alias("a"), L.priority7_label("p").alias("b")).collect()
    assert [x["a"] for x in r] == [4, 4, 1, 4, 2, 4, 4]
    assert [x["b"] for x in r] == [4, 4, 4, 4, 3, 4, 6]
    t = spark.createDataFrame([(None,), ("Quality",), ("Pricing errors",), ("other",)], "t string")
    assert [x[0] for x in t.select(L.type4_label("t")).collect()] == [0, 2, 3, 0]
    assert [x[0] for x in t.select(L.type6_label("t")).collect()] == [0, 3, 5, 0]


def test_compose_and_binary(spark):
    df = spark.createDataFrame([(None, "b", True), ("s", None, None)],
                               "s string, b string, c boolean")
    r = df.select(L.compose_text("s", "b"), L.binary_label("c")).collect()
    assert r[0][0] == "Subject: nan\nBody: b" and r[0][1] == 1
    assert r[1][0] == "Subject: s\nBody: nan" and r[1][1] == 0


def test_decode_and_match(spark):
    df = spark.createDataFrame([(0, "true", True), (5, "false", True), (9, "false", None)],
                               "i int, p string, c boolean")
    r = df.select(L.decode("i", L.TYPE6), L.matches_text("p", "c")).collect()
    assert [x[0] for x in r] == ["", "pricing errors", None]
    assert [x[1] for x in r] == [True, False, False]
