"""Lifecycle (a): prepare a case export for training.

read -> anonymize -> drop auto replies -> complaint flag -> clean body ->
project -> split -> stats -> write. One lazy plan; the only shuffle is the
tiny stats aggregate (the split is a per-row hash predicate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.functions.text import clean_body, clean_whitespace, remove_punctuation
from mailcase.operators.filters import (anonymize, complaints_only, drop_auto_replies,
                                        with_complaint)
from mailcase.operators.profile import bool_stats
from mailcase.operators.sampling import in_sample


def prepare_cases(cases: DataFrame, *, type_col: str = "Type_of_Complaint",
                  body_col: str = "TextBody", key: str | None = "case_id",
                  name_col: str | None = None, complaints_only_: bool = False,
                  strip_punctuation: bool = False, short: bool = False) -> DataFrame:
    """Filter, label and clean a case export; keeps ``key`` and six output columns,
    or four with ``short`` (subject, body, complaint flag and type, P2)."""
    df = cases
    if name_col and name_col in df.columns:
        df = anonymize(df, name_col)
    df = drop_auto_replies(df)
    if complaints_only_:
        df = complaints_only(df, type_col)
    df = with_complaint(df, type_col)
    body = clean_whitespace(clean_body(F.col(body_col)))
    if strip_punctuation:
        body = remove_punctuation(body)
    df = df.withColumn(body_col, body)
    columns = ["Subject", body_col, "Complaint", "Complaint_type"] if short else [
        "Subject", body_col, "Priority", type_col, "Complaint", "Complaint_type"]
    return df.select(*([key] if key else []), *columns)


def with_split(df: DataFrame, key: str = "case_id", frac: float = 0.8, seed: int = 42
               ) -> DataFrame:
    return df.withColumn("split", F.when(in_sample(key, frac, seed), F.lit("train"))
                         .otherwise(F.lit("test")))


def split_stats(prepared: DataFrame, key: str = "case_id", frac: float = 0.8,
                seed: int = 42) -> DataFrame:
    """A5 per split: n_rows, n_true (complaints), share_true."""
    return bool_stats(with_split(prepared, key, frac, seed), "Complaint", by=["split"])


def write_splits(prepared: DataFrame, out_dir: str, key: str = "case_id", frac: float = 0.8,
                 seed: int = 42, fmt: str = "parquet") -> None:
    """Write train/test as one dataset partitioned by ``split`` (one pass)."""
    from mailcase.sources.cases import write_cases

    tagged = with_split(prepared, key, frac, seed)
    if fmt == "csv":
        for name in ("train", "test"):
            write_cases(tagged.where(F.col("split") == name).drop("split"),
                        f"{out_dir}/{name}")
    else:
        tagged.write.mode("overwrite").partitionBy("split").parquet(out_dir)
