"""Spark session helpers.

The library itself never creates a session; callers pass one in. These
helpers exist for tests, ``bench.py`` and the command-line plans.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "mailcase") -> SparkSession:
    """A local session with AQE on and the UI off (tests and benchmarks)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoint files go once nothing refers to their frame.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local tests) is a scratch folder
    created, and only for a local master.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; a shared folder is required on a cluster")
        path = tempfile.mkdtemp(prefix="mailcase-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df):
    """Compute ``df`` once and cut its lineage.

    A reliable checkpoint in the shared folder named by
    ``spark.checkpoint.dir``: later reads scan the written rows instead of
    recomputing the plan, and the data survives lost executors. Use it for
    results that several branches of a plan read (predictions before a
    metric suite, per-score counts before the curve windows).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str = "table"):
    """``df`` as Parquet in the shared checkpoint folder, read back.

    For wide rows that several jobs read: columnar and compressed, so a later
    job reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
