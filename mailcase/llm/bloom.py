"""Bloom filters over 64-bit hashes, and one over the rows of a table.

A filter of rows spares a join: rows that a small table can't name are known in
the row itself, and only the others are shuffled to be compared exactly. There
are no false negatives; a crowded filter only costs more shuffling.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.llm.wordhash import mix

PROBES = 4
#: A filter of rows has 16 bits a row, but at most 32 MB, cut into shards of 1 MB.
BITS_A_ROW = 16
MAX_BITS = 1 << 28
SHARD_BITS = 1 << 23


def probes(h: np.ndarray, bits: int):
    """``PROBES`` bit positions of each hash in a filter of ``bits`` bits."""
    step = mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    return [((h + np.uint64(i) * step) >> np.uint64(8)) & np.uint64(bits - 1) for i in range(PROBES)]


def has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), dtype=bool)
    for p in probes(h, len(bitmap) * 8):
        ok &= (bitmap[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def put(bitmap: np.ndarray, h: np.ndarray) -> None:
    for p in probes(h, len(bitmap) * 8):
        np.bitwise_or.at(bitmap, (p >> np.uint64(3)).astype(np.int64),
                         np.left_shift(1, (p & np.uint64(7)).astype(np.uint8)).astype(np.uint8))


def _fill(bits: int):
    """The filter of each shard from the hashes of its rows (a shard lies in one task)."""
    def run(batches):
        table: dict[int, np.ndarray] = {}
        for b in batches:
            h, shard = b.column("h").to_numpy().view(np.uint64), b.column("shard").to_numpy()
            for k in np.unique(shard).tolist():
                put(table.setdefault(k, np.zeros(bits // 8, dtype=np.uint8)), mix(h[shard == k]))
        for k, bitmap in table.items():
            yield pa.RecordBatch.from_pydict({"shard": pa.array([k], pa.int32()),
                                              "bits": pa.array([bitmap.tobytes()], pa.binary())})
    return run


def row_filter(keys: DataFrame, max_bits: int = MAX_BITS) -> Callable[..., Column]:
    """A test on columns like those of ``keys``: true where they equal a row of ``keys``
    (nulls are equal to each other), false for almost all other rows.

    ``keys`` is read twice, so it should be a written table. Its distinct
    hashes are dealt to the tasks by shard, and the driver gets one filter a
    shard, ``max_bits`` in all whatever the number of rows.
    """
    types = [f.dataType for f in keys.schema]
    h = keys.select(F.xxhash64(*keys.columns).alias("h")).distinct()
    n = h.count()
    if not n:
        return lambda *_: F.lit(False)
    bits = min(max_bits, max(1 << 12, 1 << (BITS_A_ROW * n).bit_length()))
    shards = max(1, bits // SHARD_BITS)
    rows = h.withColumn("shard", F.col("h").bitwiseAND(F.lit(shards - 1).cast("long")).cast("int"))
    filters = rows.repartition(shards, "shard").mapInArrow(_fill(bits // shards), "shard int, bits binary")
    table = {r["shard"]: np.frombuffer(bytes(r["bits"]), dtype=np.uint8) for r in filters.collect()}
    sent = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def known(x: pd.Series) -> pd.Series:
        h = x.to_numpy().view(np.uint64)
        ok, shard = np.zeros(len(h), dtype=bool), h & np.uint64(shards - 1)
        for k, bitmap in sent.value.items():
            mine = np.flatnonzero(shard == k)
            if len(mine):
                ok[mine] = has(bitmap, mix(h[mine]))
        return pd.Series(ok)

    def test(*columns) -> Column:
        same = [(F.col(c) if isinstance(c, str) else c).cast(t) for c, t in zip(columns, types, strict=True)]
        return known(F.xxhash64(*same))
    return test
