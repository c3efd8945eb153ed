"""Case-export files: CSV in and out, JSON lines, training logs, encodings,
reports (S1-S4, S6-S13).

Scale notes: quoted fields may hold newlines, which needs ``multiLine``;
such a file cannot be split, so one task reads one file. Large exports
should arrive as many files, and be ingested once to Parquet
(``ingest_cases``); everything downstream then gets column pruning and
filter push-down.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.operators.filters import NA_TOKENS, normalize_na
from mailcase.session import written
from mailcase.sources import encodings

SENTINEL = "_extra_field"
# A value no export contains: empty fields are read as '' (not null), so
# the missing-value rule is applied in one place.
NO_NULL_VALUE = "\u0000\u0001"
BOM = "\ufeff"


def _csv_reader(spark: SparkSession, sep: str, encoding: str, multiline: bool):
    return (spark.read.option("sep", sep).option("quote", '"').option("escape", '"')
            .option("multiLine", multiline).option("encoding", encoding)
            .option("nullValue", NO_NULL_VALUE).option("mode", "PERMISSIVE"))


def header_columns(spark: SparkSession, path: str, sep: str = ";",
                   encoding: str = "UTF-8") -> list[str]:
    """Column names from the header line (a UTF-8 BOM is removed)."""
    cols = _csv_reader(spark, sep, encoding, False).option("header", True).csv(path).columns
    return [c.lstrip(BOM) for c in cols]


def file_headers(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, line): the first non-blank line of every file, in one distributed job.

    Each line is read as one field, in the files' encoding; only the first row of the
    first block of a file is kept, before the shuffle.
    """
    lines = (spark.read.option("sep", "\u0001").option("quote", "").option("encoding", encoding)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .schema("line string").csv(path))
    at = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_id"), "line").where("_block = 0")
    return at.groupBy("file").agg(F.min_by("line", "_id").alias("line"))


def _names(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line; an unnamed or repeated column is named by its position."""
    names = next(csv.reader([line.lstrip(BOM)], delimiter=sep, quotechar='"'), [])
    return tuple(n if n and names.count(n) == 1 else f"{n}_c{i}" if n else f"_c{i}" for i, n in enumerate(names))


def read_cases(spark: SparkSession, path: str, *, sep: str = ";", encoding: str = "UTF-8",
               multiline: bool = True, na_tokens: Sequence[str] | None = NA_TOKENS,
               skip_long_rows: bool = True) -> DataFrame:
    """S1 + S3 + S5: all-string read of a ``;`` export.

    Rows with more fields than the header are dropped (an extra sentinel
    column catches the surplus); shorter rows are padded with null.
    Missing-value spellings become null unless ``na_tokens`` is None.

    ``path`` may name several files. Columns are matched by name, and a column
    that some files lack is null there: one job reads the headers of all
    files, and one scan reads all rows by position; a row's header, found by
    its file, gives the positions their names. Only the distinct headers
    reach the driver.
    """
    found = written(file_headers(spark, path, encoding), "headers")
    lines = [r[0] for r in found.select("line").distinct().orderBy("line").collect()]
    headers = sorted({_names(line, sep) for line in lines})
    if len(headers) < 2:
        return _read_group(spark, path, list(headers[0]) if headers else header_columns(spark, path, sep, encoding),
                           sep, encoding, multiline, na_tokens, skip_long_rows)
    number = {h: i for i, h in enumerate(headers)}
    group = F.create_map(*[F.lit(v) for line in lines for v in (line, number[_names(line, sep)])])
    width = max(map(len, headers)) + 1
    schema = T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(width)])
    rows = (_csv_reader(spark, sep, encoding, multiline).option("header", True).option("enforceSchema", True)
            .schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias("_file")))
    rows = rows.join(found.select(F.col("file").alias("_of"), group[F.col("line")].alias("_g")),
                     F.col("_file") == F.col("_of"))

    def by_header(at):
        """The field of a row that ``at`` gives the position of, by the row's header."""
        cases = [F.when(F.col("_g") == i, F.col(f"_p{at(h)}")) for h, i in number.items() if at(h) is not None]
        return F.coalesce(*cases)

    if skip_long_rows:
        rows = rows.where(by_header(len).isNull())
    columns = list(dict.fromkeys(c for h in headers for c in h))
    df = rows.select(*[by_header(lambda h, c=c: h.index(c) if c in h else None).alias(c) for c in columns])
    return normalize_na(df, columns, na_tokens) if na_tokens is not None else df


def _read_group(spark: SparkSession, path, cols: list[str], sep: str, encoding: str, multiline: bool,
                na_tokens: Sequence[str] | None, skip_long_rows: bool) -> DataFrame:
    """Files that share the header ``cols``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols]
                          + [T.StructField(SENTINEL, T.StringType())])
    df = (_csv_reader(spark, sep, encoding, multiline).option("header", True)
          .option("enforceSchema", True).schema(schema).csv(path))
    if skip_long_rows:
        df = df.where(F.col(SENTINEL).isNull())
    df = df.drop(SENTINEL)
    return normalize_na(df, cols, na_tokens) if na_tokens is not None else df


def read_labelled(spark: SparkSession, path: str, *, bool_cols: Sequence[str] = ("Complaint",),
                  **kw) -> DataFrame:
    """Typed read: boolean columns from ``True``/``False`` text (else null)."""
    df = read_cases(spark, path, **kw)
    return df.withColumns({
        c: F.when(F.lower(F.col(c)) == "true", F.lit(True))
        .when(F.lower(F.col(c)) == "false", F.lit(False)) for c in bool_cols if c in df.columns})


def first_rows(df: DataFrame, n: int, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows (by ``order_by`` for a stable result)."""
    if order_by is None:
        return df.limit(n)
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)


def ingest_cases(spark: SparkSession, csv_path: str, parquet_path: str, **kw) -> DataFrame:
    """Read a CSV export once and keep it as Parquet."""
    read_cases(spark, csv_path, **kw).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_cases(df: DataFrame, path: str, *, sep: str = ";", bom: bool = True,
                mode: str = "overwrite") -> None:
    """``;`` CSV with a header and no index; ``bom`` puts U+FEFF before the
    header of every part file (what ``utf-8-sig`` consumers expect)."""
    out = df
    if bom and df.columns:
        first = df.columns[0]
        out = df.withColumnRenamed(first, BOM + first)
    # Spark's CSV writer trims surrounding spaces by default; values are kept as is.
    (out.write.mode(mode).option("sep", sep).option("header", True).option("quote", '"')
     .option("escape", '"').option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def save_head(df: DataFrame, path: str, n: int, order_by, **kw) -> None:
    """The first ``n`` rows by ``order_by``, written as S6."""
    write_cases(first_rows(df, n, order_by), path, **kw)


def write_results(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",",
                  mode: str = "overwrite") -> None:
    """Prediction / result tables (Parquet by default, CSV with a header)."""
    if fmt == "csv":
        (df.write.mode(mode).option("sep", sep).option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    else:
        df.write.mode(mode).parquet(path)


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (one object per row)."""
    df.write.mode(mode).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None
               ) -> DataFrame:
    """JSON lines with an explicit schema (no inference at scale)."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)


LOG_ENTRY = T.StructType([
    T.StructField("epoch", T.DoubleType()), T.StructField("step", T.LongType()),
    T.StructField("loss", T.DoubleType()), T.StructField("grad_norm", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()), T.StructField("eval_accuracy", T.DoubleType()),
    T.StructField("eval_runtime", T.DoubleType()),
    T.StructField("eval_samples_per_second", T.DoubleType()),
    T.StructField("eval_steps_per_second", T.DoubleType()),
])
TRAINER_STATE = T.StructType([
    T.StructField("best_metric", T.DoubleType()),
    T.StructField("best_model_checkpoint", T.StringType()),
    T.StructField("global_step", T.LongType()),
    T.StructField("log_history", T.ArrayType(LOG_ENTRY)),
])


def read_training_logs(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row per logged entry of every run state file under ``path_glob``:
    run (the file), entry fields; feeds E16/E17."""
    raw = spark.read.schema(TRAINER_STATE).option("multiLine", True).json(path_glob)
    return raw.select(F.col("_metadata.file_path").alias("run"),
                      F.explode("log_history").alias("e")).select("run", "e.*")


def encoding_report(spark: SparkSession, path_glob: str, range_bytes: int = encodings.RANGE_BYTES) -> DataFrame:
    """(path, encoding, length, confidence, counts) per file, read in byte
    ranges (see ``encodings.encoding_report``)."""
    files = spark.read.format("binaryFile").load(path_glob).select("path", "length")
    return encodings.encoding_report(files, range_bytes)


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """A per-run report table (a handful of rows: one file is fine)."""
    out = report.coalesce(1)
    if fmt == "csv":
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").parquet(path)
