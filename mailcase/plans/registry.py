"""Registered queries: one per operator of the inventory, each paired with
the DuckDB SQL that computes the same rows (the correctness oracle).

Every query reads the driver tables (through the fixture views) and runs
over whole tables and whole texts. Floats are rounded to 6 digits on both
sides; every computed column carries the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from mailcase.plans import (q_prepare, q_profile, q_labels, q_metrics,  # noqa: F401
                                q_features, q_injected, q_language, q_models, q_sources,
                                q_streaming)
