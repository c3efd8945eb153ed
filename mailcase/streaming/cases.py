"""Structured Streaming versions of the row-local lifecycles.

Everything in lifecycle (a) (auto-reply filter, complaint flag, body
cleaner, projection, hash split) and M9 scoring is row-local, so the same
column expressions run unchanged on a streaming DataFrame. New case files
arriving in a folder are picked up by a file source, joined to the static
labels table (stream-static left join: no state is kept), cleaned and
appended to a Parquet table partitioned by split. The checkpoint folder
records which files were processed, so a restarted job (or one that lost
executors) resumes without duplicates; the file sink is exactly-once.
"""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mailcase.functions.labels import LabelSet
from mailcase.operators.models import score
from mailcase.plans.prepare import prepare_cases, with_split
from mailcase.sources.tables import cases_from


def read_table_stream(spark: SparkSession, path: str, *,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a Parquet folder or single Parquet file.

    The schema is read once from the existing files (a stream never infers
    it). A single file is addressed by a one-file glob under its folder,
    because the file source needs a folder as its base path.
    """
    batch = spark.read.parquet(path)
    r = spark.readStream.schema(batch.schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # Spark lists the input, so any file system works: a single file lists itself.
    plain = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path.rstrip("/"))
    is_dir = not any(unquote(f).endswith(plain) for f in batch.inputFiles()[:1])
    if is_dir:
        return r.parquet(path)
    folder, name = os.path.split(path.rstrip("/"))
    glob = re.sub(r"(.)$", r"[\1]", name)  # matches exactly this file
    return r.option("basePath", folder).parquet(f"{folder}/{glob}")


def prepare_stream(documents: DataFrame, labels: DataFrame, *, key: str = "case_id",
                   frac: float = 0.8, seed: int = 42) -> DataFrame:
    """Lifecycle (a) on a stream: cases -> P7 -> P5/P6 -> F9/F10 -> P2 -> X3 tag."""
    return with_split(prepare_cases(cases_from(documents, labels)), key, frac, seed)


def score_stream(model: PipelineModel, stream: DataFrame, label_set: LabelSet | None = None,
                 keep=("case_id",)) -> DataFrame:
    """M9 on a stream: the fitted pipeline applied to each micro-batch."""
    return score(model, stream, label_set, keep)


def write_parquet_stream(df: DataFrame, path: str, checkpoint: str, *,
                         partition_by: tuple[str, ...] = (), available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table (exactly-once file sink).

    ``available_now`` processes every file present at start in bounded
    micro-batches and stops; otherwise the query runs with a processing-time
    trigger until stopped.
    """
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_prepare_stream(spark: SparkSession, sf_dir: str, out: str, checkpoint: str, *,
                       max_files_per_trigger: int | None = None,
                       timeout_s: float | None = None) -> str:
    """Run lifecycle (a) as a stream over ``documents`` until the present files
    are done; returns ``out`` (Parquet, partitioned by ``split``)."""
    docs = read_table_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet",
                             max_files_per_trigger=max_files_per_trigger)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    q = write_parquet_stream(prepare_stream(docs, labels), out, checkpoint,
                             partition_by=("split",))
    ended = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if ended is False:
        q.stop()
        raise TimeoutError(f"the stream did not finish in {timeout_s} s; it can resume from {checkpoint}")
    if q.exception() is not None:
        raise q.exception()
    return out
