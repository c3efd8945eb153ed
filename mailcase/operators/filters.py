"""Row filters and column reshaping.

All are narrow transformations: no shuffle, pushed under the text
expressions by Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.functions.labels import is_complaint

# --- fixed values: subjects that mark automatic replies and forwards ---
AUTO_REPLY_MARKERS = ("Automatic reply", "Automatisch antwoord", "Fw:", "RE:")
# Missing-value spellings a CSV reader turns into null.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")
# --- end of fixed values ---

AUTO_REPLY_PATTERN = "(?iu)" + "|".join(AUTO_REPLY_MARKERS)


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    """Fail at plan time with a clear message when a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; available: {df.columns}")


def present_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """S14 (lenient form): the subset of ``cols`` that exists, in order."""
    return [c for c in cols if c in df.columns]


def anonymize(df: DataFrame, col: str = "Name", value: str = "1") -> DataFrame:
    """Overwrite a column with a constant (nulls too)."""
    return df.withColumn(col, F.lit(value))


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix every column name that lacks the prefix."""
    return df.toDF(*[c if c.startswith(prefix) else prefix + c for c in df.columns])


def auto_reply(subject="Subject") -> Column:
    """P7 predicate: subject contains a marker anywhere (case-insensitive)."""
    s = F.col(subject) if isinstance(subject, str) else subject
    return F.coalesce(s.rlike(AUTO_REPLY_PATTERN), F.lit(False))


def drop_auto_replies(df: DataFrame, subject: str = "Subject") -> DataFrame:
    """Drop automatic replies / forwards / replies; a null subject is kept."""
    return df.where(~auto_reply(subject))


def with_complaint(df: DataFrame, type_col: str = "Type_of_Complaint") -> DataFrame:
    """P5 + P6: ``Complaint`` flag and a copy ``Complaint_type``."""
    return df.withColumns({"Complaint": is_complaint(type_col),
                           "Complaint_type": F.col(type_col)})


def complaints_only(df: DataFrame, type_col: str = "Type_of_Complaint") -> DataFrame:
    """Keep rows whose complaint type is present and not empty."""
    return df.where(is_complaint(type_col))


def partition_by_null(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(not-null half, null half); ``''`` goes to the not-null half."""
    return df.where(F.col(col).isNotNull()), df.where(F.col(col).isNull())


def remove_rows(df: DataFrame, col: str, value) -> DataFrame:
    """P10: drop rows equal to ``value``; nulls are kept."""
    require_columns(df, [col])
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def removal_counts(df: DataFrame, col: str, value) -> DataFrame:
    """P10: (n_before, n_after) rows around ``remove_rows``, in one scan."""
    require_columns(df, [col])
    return df.agg(F.count(F.lit(1)).alias("n_before"),
                  F.count_if(~F.col(col).eqNullSafe(F.lit(value))).alias("n_after"))


def normalize_na(df: DataFrame, cols: Iterable[str] | None = None,
                 tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Missing-value spellings -> null, for string columns."""
    tokens = list(tokens)
    cols = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({
        c: F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in cols})
