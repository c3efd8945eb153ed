"""Registered queries for file sources and sinks.

Each query writes Spark-derived data to the shared checkpoint folder named
by the session (``spark.checkpoint.dir``) and reads it back, so the file
formats are exercised on data that grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mailcase.operators import metrics as M
from mailcase.operators import profile as A
from mailcase.operators.filters import NA_TOKENS
from mailcase.plans.oracle_views import with_views
from mailcase.plans.prepare import prepare_cases
from mailcase.plans.registry import query
from mailcase.session import ensure_checkpoint_dir
from mailcase.sources import cases as S
from mailcase.sources.tables import email_cases, table, training_log


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/mailcase-{name}-{uuid.uuid4().hex}"


def _na(col: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {col} IN ({toks}) THEN NULL ELSE {col} END"


@query("cases_csv_roundtrip", with_views(["prepared_cases"], f"""
SELECT CAST(case_id AS BIGINT) AS case_id, {_na('Subject')} AS Subject,
       {_na('TextBody')} AS TextBody, {_na('Priority')} AS Priority,
       {_na('Type_of_Complaint')} AS Type_of_Complaint, Complaint
FROM prepared_cases"""))
def q_cases_csv_roundtrip(spark, sf_dir):
    """S6 (``;``, header, BOM) -> S1/S3 (sentinel, multi-line) -> S5 -> S2 (typed)."""
    path = scratch(spark, "csv")
    p = prepare_cases(email_cases(spark, sf_dir)).drop("Complaint_type")
    S.write_cases(p, path)
    back = S.read_labelled(spark, path)
    return back.select(F.col("case_id").cast("bigint").alias("case_id"), "Subject", "TextBody",
                       "Priority", "Type_of_Complaint", "Complaint")


@query("cases_jsonl_roundtrip", with_views(["prepared_cases"], """
SELECT case_id, Subject, TextBody, Complaint FROM prepared_cases"""))
def q_cases_jsonl_roundtrip(spark, sf_dir):
    """S9 -> S10: JSON lines out and back with an explicit schema."""
    path = scratch(spark, "jsonl")
    p = prepare_cases(email_cases(spark, sf_dir)).select("case_id", "Subject", "TextBody",
                                                         "Complaint")
    S.export_jsonl(p, path)
    return S.read_jsonl(spark, path, "case_id bigint, Subject string, TextBody string, "
                                     "Complaint boolean")


@query("save_head_csv", with_views(["prepared_cases"], """
SELECT CAST(case_id AS BIGINT) AS case_id, Subject FROM prepared_cases
ORDER BY case_id LIMIT 100"""))
def q_save_head_csv(spark, sf_dir):
    """S7 + S4: first 100 rows by key written as CSV, read back."""
    path = scratch(spark, "head")
    p = prepare_cases(email_cases(spark, sf_dir)).select("case_id", "Subject")
    S.save_head(p, path, 100, "case_id")
    back = S.read_cases(spark, path)
    return back.select(F.col("case_id").cast("bigint").alias("case_id"), "Subject")


#: Log entries of one state file at most.
LOG_ENTRIES = 100_000


@query("training_logs_roundtrip", with_views(["training_log"], """
SELECT run, step, 'train_loss' AS curve, round(loss, 6) AS value FROM training_log
WHERE loss IS NOT NULL
UNION ALL
SELECT run, step, 'eval_accuracy', round(eval_accuracy, 6) FROM training_log
WHERE eval_accuracy IS NOT NULL"""))
def q_training_logs_roundtrip(spark, sf_dir):
    """S11 + E16: run logs written as JSON state files, read back as curves.

    A run has a state file for every ``LOG_ENTRIES`` steps, so no file grows
    with the run.
    """
    path = scratch(spark, "logs")
    files = (training_log(spark, sf_dir)
             .groupBy("run", F.expr(f"step div {LOG_ENTRIES}").alias("part"))
             .agg(F.max("step").alias("global_step"),
                  F.collect_list(F.struct("step", "loss", "eval_accuracy")).alias("log_history")))
    files.write.partitionBy("run", "part").json(path)
    log = S.read_training_logs(spark, f"{path}/run=*/part=*/*.json")
    log = log.withColumn("run", F.regexp_extract("run", r"/run=(\d+)/", 1).cast("bigint"))
    c = M.loss_curves(log, eval_metric="eval_accuracy")
    return c.select("run", "step", "curve", F.round("value", 6).alias("value"))


@query("encoding_report", """
SELECT 'utf-8' AS written, 'utf-8' AS encoding, sum(octet_length(encode(coalesce(text, ''))) + 3) AS n_bytes FROM documents
UNION ALL SELECT 'latin-1', 'latin-1', NULL UNION ALL SELECT 'utf-8-sig', 'utf-8-sig', NULL""")
def q_encoding_report(spark, sf_dir):
    """The encodings of whole files written as UTF-8, with a BOM and as
    Latin-1; every line starts with a letter outside ASCII."""
    lines = table(spark, sf_dir, "documents").select(F.concat(F.lit("\u00e9"), F.coalesce("text", F.lit(""))).alias("value"))
    paths = {w: scratch(spark, "encoding") for w in ("utf-8", "latin-1", "utf-8-sig")}
    lines.write.text(paths["utf-8"])
    lines.write.option("encoding", "ISO-8859-1").csv(paths["latin-1"])
    S.write_cases(lines, paths["utf-8-sig"])
    out = None
    for written, path in paths.items():
        r = S.encoding_report(spark, f"{path}/part-*").where("length > 0").groupBy("encoding").agg(
            F.sum("length").alias("n"))
        r = r.select(F.lit(written).alias("written"), "encoding",
                     F.when(F.lit(written == "utf-8"), F.col("n")).alias("n_bytes"))
        out = r if out is None else out.unionByName(r)
    return out


@query("encoding_counts", """
WITH t AS (SELECT coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\\x00-\\x7F]', '', 'g') AS high FROM documents)
SELECT 'utf-8' AS encoding, CAST(sum(length(high) + 1) AS BIGINT) AS n_sequences,
       CAST(sum(octet_length(encode(high)) + 2) AS BIGINT) AS n_high,
       CAST(sum(octet_length(encode(high)) - length(high) + 1) AS BIGINT) AS n_continued, 0::BIGINT AS n_faults,
       CAST(sum(octet_length(encode(t)) + 3) AS BIGINT) AS length FROM t""")
def q_encoding_counts(spark, sf_dir):
    """What the report judges by, of all texts written as UTF-8 and read in ranges of 64 KB."""
    path = scratch(spark, "encoding")
    table(spark, sf_dir, "documents").select(F.concat(F.lit("\u00e9"), F.coalesce("text", F.lit(""))).alias("value")).write.text(path)
    r = S.encoding_report(spark, f"{path}/part-*", range_bytes=1 << 16).where("length > 0")
    return r.groupBy("encoding").agg(*[F.sum(c).alias(c) for c in (
        "n_sequences", "n_high", "n_continued", "n_faults", "length")])


@query("report_files", """
SELECT source, CAST(n_rows AS VARCHAR) AS n_rows FROM (
  SELECT source, count(*) AS n_rows FROM documents GROUP BY source)""")
def q_report_files(spark, sf_dir):
    """A report table written as one CSV file, read back."""
    path = scratch(spark, "report")
    S.write_report(table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows")), path)
    return spark.read.option("header", True).csv(path)


@query("optional_columns", with_views(["email_cases"], """
SELECT c AS "column", n AS n_non_empty FROM (
  SELECT count(*) FILTER (WHERE Subject <> '') AS s, count(*) FILTER (WHERE Priority <> '') AS p
  FROM email_cases), LATERAL (SELECT 'Subject' AS c, s AS n UNION ALL SELECT 'Priority', p)"""))
def q_optional_columns(spark, sf_dir):
    """A profile over columns of which some are missing."""
    return A.non_empty_counts(email_cases(spark, sf_dir), ["Subject", "Region", "Priority", "Channel"])
