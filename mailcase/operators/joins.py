"""Joins (J1, J2 in ``profile``, J3 in ``sampling``, J4 in ``metrics``,
J5 by position here, J6 in ``features``).

Catalyst chooses the physical join; AQE turns a shuffle join into a
broadcast one at run time when a side turns out small, and splits skewed
partitions. An explicit broadcast is only used for sides whose size is
bounded by a parameter (label sets, a capped vocabulary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailcase.session import materialize


def join_metadata(emails: DataFrame, meta: DataFrame, left_on: str, right_on: str, *,
                  null_safe: bool = False) -> DataFrame:
    """Left equi-join of e-mails to case metadata; may fan out.

    ``null_safe=True`` matches null keys with each other (pandas merge
    semantics); the default follows SQL.
    """
    cond = (emails[left_on].eqNullSafe(meta[right_on]) if null_safe
            else emails[left_on] == meta[right_on])
    return emails.join(meta, cond, "left")


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """The non-null values of ``key`` that hold at least ``share`` of the rows, at most 1 / share.

    A mergeable frequent-items sketch over one scan; its counts are upper
    bounds, so a value at the limit may be listed that holds a little less.
    """
    n = int(4 / share)
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {int(1 / share)}, {max(n, 1000)})").alias("t"),
                 F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in top["t"] or [] if x["item"] is not None and x["count"] >= share * top["n"]]


def join_metadata_salted(emails: DataFrame, meta: DataFrame, left_on: str, right_on: str, *,
                         null_safe: bool = False, share: float = 0.01, salts: int = 32) -> DataFrame:
    """J1 for a parent key that may hold a large share of the e-mails, whatever AQE does.

    Rows of a hot key (and of the null key) are dealt over ``salts`` groups by
    a hash of the whole row, so a retried task deals them alike; the metadata
    rows of these keys are repeated in every group. All other rows are joined
    as they are. The result is that of ``join_metadata``.
    """
    hot = hot_keys(emails, left_on, share)
    is_hot = lambda c: c.isNull() | c.isin(hot) if hot else c.isNull()
    dealt = F.pmod(F.xxhash64(*emails.columns), F.lit(salts))
    left = emails.withColumn("_salt", F.when(is_hot(F.col(left_on)), dealt).otherwise(F.lit(0)).cast("int"))
    groups = F.when(is_hot(F.col(right_on)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = meta if null_safe else meta.where(F.col(right_on).isNotNull())
    right = right.withColumn("_salt_m", F.explode(groups))
    same = left[left_on].eqNullSafe(right[right_on]) if null_safe else left[left_on] == right[right_on]
    return left.join(right, same & (left["_salt"] == right["_salt_m"]), "left").drop("_salt", "_salt_m")


def _numbered(d: DataFrame, blocks: Sequence[str], order: Sequence, name: str) -> DataFrame:
    """Position of every row: rows of the blocks before its own, plus its place inside.

    ``_id`` rises by 1 inside a block. Only one row per block is summed up in
    order, first the blocks of a group, then the groups.
    """
    group, *rest = blocks
    sizes = d.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = (Window.partitionBy(group).orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1) if rest else None)
    inner = F.coalesce(F.sum("_n").over(before), F.lit(0)) if rest else F.lit(0)
    sizes = sizes.withColumn("_inner", inner)
    groups = sizes.groupBy(group).agg(F.sum("_n").alias("_total"))
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col(group).alias("_g"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_outer"))
    starts = sizes.join(groups, sizes[group].eqNullSafe(groups["_g"])).select(
        *[F.col(b).alias(f"_at{b}") for b in blocks], (F.col("_inner") + F.col("_outer") - F.col("_first")).alias("_start"))
    cond = F.lit(True)
    for b in blocks:
        cond = cond & d[b].eqNullSafe(starts[f"_at{b}"])
    own = [c for c in d.columns if c not in (*blocks, "_id")]
    return d.join(starts, cond).select(*own, (F.col("_id") + F.col("_start")).alias(name))


def file_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a file source with their 0-based position: files by name, rows as
    in the file. ``df`` must come straight from a reader.

    Part files are named by number, so a longer name is a later one. A file may
    be read in several splits; each is one block.
    """
    d = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                  F.monotonically_increasing_id().alias("_id"))
    return _numbered(d, ["_file", "_block"], [F.length("_file"), "_file"], name)


def row_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """The rows with their 0-based position: partitions in order, rows as they come.
    The rows are checkpointed, as a second run might order them otherwise."""
    d = materialize(df.withColumn("_id", F.monotonically_increasing_id()))
    d = d.withColumn("_part", F.shiftright("_id", 33))
    return _numbered(d, ["_part"], ["_part"], name)


def align_positions(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """Rows of two frames without a key, side by side by their position.

    Raises ``ValueError`` when the frames differ in length, or share a column
    other than the position. The join is on the position, which has no hot value.
    """
    clash = sorted(set(left.columns) & set(right.columns) - {position})
    if clash:
        raise ValueError(f"both sides have the columns {clash}")
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} rows can't be aligned with {m}")
    return left.join(right, position)
