"""Deterministic splits, heads and per-class caps.

The default split is a hash threshold on the row key: each row decides on
its own, so the split needs no shuffle, no global order and gives the same
rows for any partitioning or executor retry.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 8  # hash prefix compared against the threshold


def _key_hash(key, seed, salt: str = "") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    parts = [k.cast("string"), F.lit(f":{seed}")]
    if salt:
        parts.append(F.lit(f":{salt}"))
    return F.md5(F.concat(*parts))


def threshold_hex(frac: float) -> str:
    """Hex prefix below which a hash falls with probability ``frac``."""
    return format(int(frac * 16 ** HEX_DIGITS), f"0{HEX_DIGITS}x")


def in_sample(key, frac: float, seed: int = 42, salt: str = "") -> Column:
    """True for rows whose key hash is below the ``frac`` threshold."""
    if frac >= 1:
        return F.lit(True)
    if frac <= 0:
        return F.lit(False)
    h = F.substring(_key_hash(key, seed, salt), 1, HEX_DIGITS)
    return h < F.lit(threshold_hex(frac))


def split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, *,
          exact: bool = False, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """(train, test), disjoint and complete.

    ``exact=True`` returns exactly ``round(frac * n)`` training rows: a
    histogram of hash prefixes (65,536 counts, bounded) finds the boundary
    bucket, and only rows of that bucket are ranked.
    """
    if not exact:
        flag = in_sample(key, frac, seed, salt)
        return df.where(flag), df.where(~flag)
    flag = exact_sample_flag(df, key, frac, seed, salt)
    tagged = df.withColumn("_train", flag)
    return (tagged.where("_train").drop("_train"), tagged.where(~F.col("_train")).drop("_train"))


def exact_sample_flag(df: DataFrame, key: str, frac: float, seed: int = 42,
                      salt: str = "") -> Column:
    """Column that is true for exactly ``round(frac * n)`` rows of ``df``."""
    h = _key_hash(key, seed, salt)
    hist = (df.select(F.substring(h, 1, 4).alias("b")).groupBy("b").count()
            .orderBy("b").collect())  # at most 16^4 rows
    total = sum(r["count"] for r in hist)
    want = round(frac * total)
    below, boundary, need = 0, None, 0
    for r in hist:
        if below + r["count"] >= want:
            boundary, need = r["b"], want - below
            break
        below += r["count"]
    if boundary is None:
        return F.lit(True)
    hk = F.concat(h, F.lit("|"), F.col(key).cast("string"))
    inside = F.substring(h, 1, 4) == F.lit(boundary)
    cut = (df.where(inside).select(hk.alias("hk")).orderBy("hk")
           .limit(need).agg(F.max("hk").alias("m")).collect()[0]["m"]) if need else ""
    return (F.substring(h, 1, 4) < F.lit(boundary)) | (inside & (hk <= F.lit(cut)) & F.lit(need > 0))


def holdout(df: DataFrame, key: str, frac: float = 0.1, seed: int = 42
            ) -> tuple[DataFrame, DataFrame]:
    """(train, eval) with ``frac`` held out, always seeded."""
    ev, tr = split(df, key, frac, seed, salt="holdout")
    return tr, ev


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows by a total order (TakeOrderedAndProject)."""
    cols = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    return df.orderBy(*cols).limit(n)


def cap_per_class(df: DataFrame, class_col: str, n: int, order_by) -> DataFrame:
    """First ``n`` rows of each class.

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so no task holds more than ``n`` rows per class per
    input partition.
    """
    cols = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    w = Window.partitionBy(class_col).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def balanced_sample(df: DataFrame, class_col: str, n: int, order_by) -> DataFrame:
    """X2 + U1: first ``n`` rows with ``class_col`` present plus first ``n``
    without it (the two halves of P9), as one frame."""
    tagged = df.withColumn("_has", F.col(class_col).isNotNull())
    return cap_per_class(tagged, "_has", n, order_by).drop("_has")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Row concatenation by column name (UNION ALL)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def complement(df: DataFrame, subset: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``subset`` (left anti join)."""
    return df.join(subset.select(key), key, "left_anti")


def top_k(df: DataFrame, k: int, score: str, name: str) -> DataFrame:
    """Top ``k`` by score descending, ties by name ascending."""
    return df.orderBy(F.col(score).desc(), F.col(name).asc()).limit(k)
