"""Mixing sources to target weights (DataFrame functions only).

Tokens are summed per source, each source gets a target, and the repetition
rate of a source is target / tokens. A document is emitted floor(rate) times
plus one more copy with probability rate - floor(rate), drawn from a hash of
its key, its text and a seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.llm.tables import stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3.0
SEED = 17
#: Size in memory up to which the table of sources is broadcast.
BROADCAST_BYTES = 32 << 20


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(key: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the md5 of ``key:seed:md5 of the text`` (52 bits)."""
    name = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}:"),
                    F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source in code point order, null last.

    Sorted by range partitions; a position is the number of rows in earlier
    partitions (one number per partition) plus the row's place in its own.
    """
    s = stored(sources.orderBy(F.col("source").asc_nulls_last())
               .withColumn("_id", F.monotonically_increasing_id()), "sources")
    part = F.shiftright(F.col("_id"), 33)
    per = s.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    before, total = {}, 0
    for r in per:
        before[r["p"]] = total
        total += r["n"]
    if not before:
        return s.withColumn("rank", F.lit(0).cast("long")).drop("_id")
    offset = F.create_map(*[x for p, n in before.items() for x in (F.lit(p), F.lit(n))])
    return s.withColumn("rank", offset[part] + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: float = MAX_REPEATS
                   ) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Targets share the sum of all sizes by weight. A target above
    ``max_repeats`` times its source's size stops there, and the excess goes
    to the others by weight until none is above. Each round is one small
    aggregate; the number of rounds is at most that of distinct size-to-weight
    ratios, in practice two or three.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    r = _ranked(per)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("rank") % len(weights) + 1).cast("int"))
    r = stored(r.select("source", "source_size", w.alias("weight"),
                        (F.col("source_size") * F.lit(float(max_repeats))).alias("cap")), "weights")
    a = r.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    total, level = float(a["t"] or 0), 0.0
    if a["w"]:
        level = total / a["w"]
        while True:
            above = F.col("weight") * F.lit(level) > F.col("cap")
            s = r.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("held"),
                      F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("w"),
                      F.count_if(above).alias("n")).first()
            if not s["w"]:
                break
            new = (total - s["held"]) / s["w"]
            if new <= level:
                break
            level = new
    return r.select("source", "source_size",
                    F.least(F.col("weight") * F.lit(level), F.col("cap")).alias("target"))


def _mixed(docs: DataFrame, key: str, text: str, source: str, weights, max_repeats: float,
           seed: int) -> DataFrame:
    """Every row (as ``_row``) with its source's figures and its number of copies."""
    src = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"),
                      F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                      unit_hash(F.col(key), F.col(text), seed).alias("_draw"))
    targets = source_targets(src.select("source", "size"), weights, max_repeats)
    # A row is a name, two numbers and the relation's overhead.
    row = F.coalesce(F.octet_length(F.col("source").cast("string")), F.lit(0)) + F.lit(96)
    if (targets.agg(F.sum(row.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES:
        targets = F.broadcast(targets)
    t = targets.withColumnRenamed("source", "_source")
    j = src.join(t, src["source"].eqNullSafe(t["_source"])).drop("_source")
    j = j.withColumn("_rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    extra = F.col("_draw") < F.col("_rate") - F.floor("_rate")
    return j.withColumn("copies", F.floor("_rate") + extra.cast("long"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
        weights=WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """(key, size, source, source_size, target, copies, taken) of every document.

    ``copies`` is how often the mix takes the document, ``taken`` the words
    that gives. The draw depends on key, text and seed alone, so reruns agree;
    texts that share a key draw each on their own, rows equal in both alike. Null texts have size 0; a null source is a
    source of its own, ranked last; a source without words has target 0 and
    its documents are not taken. An empty table gives an empty result.
    """
    j = _mixed(docs, key, text, source, weights, max_repeats, seed)
    return j.select(F.col("_key").alias(key), "size", "source", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"))


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
            weights=WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, with all
    its columns. The rows do not move; only the table of sources is joined."""
    j = _mixed(docs, key, text, source, weights, max_repeats, seed)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return j.where("copies > 0").select("_row", copies.alias("_one")).select("_row.*")
