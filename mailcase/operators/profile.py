"""Profiles and counts.

Every profile is one scan with map-side partial aggregation; the shuffled
data is at most one row per distinct value per input partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailcase.functions.labels import LabelSet, matches_text
from mailcase.operators.filters import present_columns

# --- fixed values: languages reported by the language share profile ---
SHARE_LANGUAGES = ("nl", "en", "fr", "es", "it")
# --- end of fixed values ---


def value_counts(df: DataFrame, col: str, dropna: bool = False) -> DataFrame:
    """A1: (value, count) by count descending, value ascending; nulls kept unless ``dropna``."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return (src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("value").asc_nulls_first()))


def count_value(df: DataFrame, col: str, value) -> DataFrame:
    """A2: how many rows equal ``value`` (0 when none)."""
    return df.agg(F.count_if(F.col(col).eqNullSafe(F.lit(value))).alias("count"))


def language_share(df: DataFrame, lang_col: str = "lang",
                   languages: Sequence[str] = SHARE_LANGUAGES) -> DataFrame:
    """A3: Language, Count, Percentage of all rows, for a fixed language list."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(lang_col) == F.lit(lg)).alias(f"_c{i}") for i, lg in enumerate(languages)]
    one = df.agg(*aggs)
    pairs = [F.struct(F.lit(lg).alias("Language"), F.col(f"_c{i}").alias("Count"))
             for i, lg in enumerate(languages)]
    return one.select("_n", F.inline(F.array(*pairs))).select(
        "Language", F.col("Count").cast("bigint").alias("Count"),
        F.try_divide(F.col("Count") * F.lit(100.0), F.col("_n")).alias("Percentage"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4: distinct values, null included."""
    return df.select(col).distinct()


def bool_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """A5: size, sum and mean of a boolean column, optionally per group."""
    x = F.col(col).cast("int")
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(x), F.lit(0)).alias("n_true"),
            F.avg(x).alias("share_true")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def non_empty_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """(column, n_non_empty) for the columns that exist, in one pass.

    Non-empty means not null and not ``''`` (the documented intent).
    """
    cols = present_columns(df, cols)
    one = df.agg(*[F.count_if(non_empty(F.col(c))).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("n_non_empty"))
             for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*pairs)))


def class_table(df_or_spark, label_set: LabelSet) -> DataFrame:
    """The label set as a tiny (class_id, class_name) DataFrame (a parameter, not data)."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return spark.createDataFrame(list(enumerate(label_set.classes)),
                                 "class_id int, class_name string")


def label_histogram(df: DataFrame, label_col: str, label_set: LabelSet) -> DataFrame:
    """(class_id, class_name, n) zero-filled in label-set order."""
    label = F.col(label_col).cast("int")
    # At most one row per class, whatever other labels the data hold.
    counts = df.where(label.between(0, len(label_set.classes) - 1)).groupBy(
        label.alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    grid = class_table(df, label_set)
    return (grid.join(F.broadcast(counts), "class_id", "left")
            .select("class_id", "class_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def class_weights(df: DataFrame, label_col: str, label_set: LabelSet) -> DataFrame:
    """``w_c = (1/n_c) / sum_k (1/n_k)``; an empty class gets NULL and is
    left out of the sum, so the other weights still add up to 1."""
    h = label_histogram(df, label_col, label_set)
    inv = F.try_divide(F.lit(1.0), F.when(F.col("n") > 0, F.col("n").cast("double")))
    # The window spans the label grid only (len(label_set) rows).
    total = F.sum("inv").over(Window.partitionBy())
    return (h.withColumn("inv", inv)
            .select("class_id", "class_name", "n", F.try_divide(F.col("inv"), total).alias("weight")))


def match_accuracy(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """Matches of ``pred == lower(str(truth))``, rows, percent (NULL when empty)."""
    m = matches_text(F.col(pred), F.col(truth))
    return df.agg(F.count_if(m).alias("n_match"), F.count(F.lit(1)).alias("n_rows")).select(
        "n_match", "n_rows",
        F.try_divide(F.col("n_match") * F.lit(100.0), F.col("n_rows")).alias("accuracy_pct"))


def profile_report(df: DataFrame, cols: Sequence[str] = ("Priority", "Complaint_type", "Complaint")
                   ) -> DataFrame:
    """A10: value counts of several columns in one scan: (column, value, count).

    Each row becomes one row per profiled column; partial aggregation
    collapses them map-side before the single shuffle.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             for c in present_columns(df, cols)]
    return (df.select(F.inline(F.array(*pairs))).groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def data_amount_report(df: DataFrame, cols: Sequence[str], filled: Sequence[str], flag: str
                       ) -> DataFrame:
    """A10 with A6: (section, column, value, count) in one scan: ``values`` of
    ``cols``, ``non_empty`` counts of ``filled`` and the ``total`` of a boolean column."""
    def entry(section, c, value, counts):
        return F.struct(F.lit(section).alias("section"), F.lit(c).alias("column"),
                        value.cast("string").alias("value"), counts.cast("long").alias("n"))

    entries = [entry("values", c, F.col(c), F.lit(1)) for c in present_columns(df, cols)]
    entries += [entry("non_empty", c, F.lit(None), non_empty(F.col(c))) for c in present_columns(df, filled)]
    entries.append(entry("total", flag, F.lit(None), F.coalesce(F.col(flag), F.lit(False))))
    return (df.select(F.inline(F.array(*entries))).groupBy("section", "column", "value")
            .agg(F.sum("n").alias("count")))


def count_matching(meta: DataFrame, emails: DataFrame, meta_key: str, email_key: str,
                   null_safe: bool = False) -> DataFrame:
    """How many metadata rows have a matching e-mail (semi join).

    Returns one row (matched, total, ratio). With ``null_safe`` a null key
    matches a null key.
    """
    for frame, key in ((meta, meta_key), (emails, email_key)):
        if key not in frame.columns:
            raise ValueError(f"column {key!r} not found")
    keys = emails.select(F.col(email_key).alias("_k"))
    if null_safe:
        hit = F.col(meta_key).eqNullSafe(F.col("_k"))
    else:
        keys, hit = keys.where(F.col("_k").isNotNull()), F.col(meta_key) == F.col("_k")
    keys = keys.distinct().withColumn("_here", F.lit(True))
    flagged = meta.join(keys, hit, "left").select(F.col("_here").isNotNull().alias("_hit"))
    return flagged.agg(F.count_if("_hit").alias("matched"), F.count(F.lit(1)).alias("total")
                       ).withColumn("ratio", F.try_divide(F.col("matched"), F.col("total")))
