"""Registered queries for the streaming lifecycle.

The stream reads the ``documents`` table as a file source, runs lifecycle
(a) per micro-batch and appends to a Parquet table in the shared checkpoint
folder named by the session; the query returns that table read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.plans.oracle_views import with_views
from mailcase.plans.q_prepare import SPLIT_SQL
from mailcase.plans.q_sources import scratch
from mailcase.plans.registry import query
from mailcase.streaming.cases import run_prepare_stream


@query("stream_prepared_cases", with_views(["prepared_cases"], f"""
SELECT case_id, Subject, TextBody, Priority, Type_of_Complaint, Complaint, Complaint_type,
       CASE WHEN {SPLIT_SQL} THEN 'train' ELSE 'test' END AS split
FROM prepared_cases"""))
def q_stream_prepared_cases(spark, sf_dir):
    """Lifecycle (a) as a file stream (availableNow) into a split-partitioned table."""
    base = scratch(spark, "stream")
    out = run_prepare_stream(spark, sf_dir, f"{base}/out", f"{base}/checkpoint")
    back = spark.read.parquet(out)
    return back.select("case_id", "Subject", "TextBody", "Priority", "Type_of_Complaint",
                       "Complaint", "Complaint_type", F.col("split"))
