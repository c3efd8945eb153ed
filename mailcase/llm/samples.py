"""Labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.llm.tables import stored


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row is in the held-out fold: crc32(key as text) mod folds = fold.
    A row without a key is not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def training_labels(labels: DataFrame, key: str, label: str, folds: int, fold: int,
                    bound: int) -> DataFrame:
    """(key, label) of at most ``bound`` labelled rows outside the held-out fold.

    The rows with the smallest hashes of their key, so the choice is the same
    in every run and the frame has a proven size bound (it may be broadcast).
    A key that is labelled several times counts once, with its largest label.
    """
    rows = (labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
            .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
            .where(~held_out(F.col("_id"), folds, fold))
            .groupBy("_id").agg(F.max("_label").alias("_label")))
    return stored(rows.orderBy(F.xxhash64("_id"), "_id").limit(bound), "labelled")
