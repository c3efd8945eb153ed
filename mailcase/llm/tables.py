"""Written intermediate tables and fixed-size count tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailcase.session import ensure_checkpoint_dir


#: Bytes of the texts that a task sends to Python in one Arrow batch, and the setting for it.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs started inside send texts to Python in batches of about ``BATCH_BYTES``:
    the JVM and the Python workers of an executor never hold 10,000 texts each."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: computed once, lineage cut, safe when executors are lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def summed_table(df: DataFrame, size: int,
                 count: Callable[[Iterator[pa.RecordBatch], np.ndarray], None],
                 segment: int = 1 << 14, dtype=np.int64) -> np.ndarray:
    """Sum of per-task tables of ``size`` numbers, as one array on the driver.

    Each task fills its own table (``count(batches, table)``), which is
    shuffled in segments and added up by segment, so no task holds more than
    one table and the driver gets ``size`` numbers whatever the input size.
    """
    name = np.dtype(dtype).str

    def fill(batches):
        table = np.zeros(size, dtype=dtype)
        count(batches, table)
        for i in range(0, size, segment):
            part = table[i:i + segment]
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {"seg": pa.array([i // segment], pa.int32()),
                     "part": pa.array([part.tobytes()], pa.binary())})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, p in zip(b.column(0).to_pylist(), b.column(1)):
                a = np.frombuffer(p.as_buffer(), dtype=name)
                if s in sums:
                    sums[s] += a
                else:
                    sums[s] = a.copy()
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"seg": pa.array(list(sums), pa.int32()),
                 "part": pa.array([a.tobytes() for a in sums.values()], pa.binary())})

    schema = "seg int, part binary"
    out = np.zeros(size, dtype=dtype)
    # A few segments a partition: the number of segments is fixed by ``size``.
    parts = max(1, min(12, -(-size // segment)))
    with small_batches(df.sparkSession):
        rows = df.mapInArrow(fill, schema).repartition(parts, "seg").mapInArrow(add, schema).collect()
    for r in rows:
        a = np.frombuffer(bytes(r["part"]), dtype=name)
        out[r["seg"] * segment:r["seg"] * segment + len(a)] = a
    return out


def text_id(text) -> F.Column:
    """128 bits that stand for a whole text (null for null): what names a row together with its key."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def text_tag(text: str) -> F.Column:
    """(h, id): the short hash that results show, and the 128 bits that rows are told apart by."""
    return F.struct(F.hash(text).alias("h"), text_id(text).alias("id"))


#: Type of ``text_tag``.
TAG = "struct<h: int, id: binary>"


def same(left, right, names) -> F.Column:
    """Null-safe equality of the named columns of two frames."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond
