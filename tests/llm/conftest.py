import pytest
from pyspark.sql import types as T

#: Extra columns whose names clash with ones the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("doc", T.StringType()),
    T.StructField("tag", T.IntegerType()), T.StructField("row", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("_key", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("text_hash", T.StringType())])

WORDS = " ".join(f"w{i}" for i in range(60))
LINE = "this very line is found in several documents"
LONG = " ".join(f"x{i % 977}y{i % 1009}" for i in range(120_000))


def documents(spark, rows):
    """(doc_id, text, source) rows as a table with clashing extra columns."""
    full = [(i, t, "en", s, len(t or ""), "d", 1, "r", "s", "k", "l", "h") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


EDGE = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", "b"), (4, WORDS, "b"), (5, WORDS, None),
    (5, WORDS, None), (6, "short", "c"), (6, "other text under the same key", "c"),
    (None, WORDS + " tail", "c"), (None, None, None), (7, WORDS.upper(), "d"), (8, LONG, "d"),
    (9, "é" * 200_000, "d"), (10, f"{LINE}\nown ten", "a"), (11, f"  {LINE.upper()}  \nown eleven", "a"),
    (12, f"{LINE}\n{LINE}\nown twelve", "a"), (13, "a " * 3_000, "e"), (14, WORDS + " w60 w61", "e")]


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, EDGE).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (8, 1, 0), (None, 1, 1), (4, 0, 1), (6, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, " ".join(WORDS.split()[10:30])), (2, "other text"), (3, None), (4, ""), (None, "short"),
         (2, "never seen anywhere at all")], "item_id long, text string")
