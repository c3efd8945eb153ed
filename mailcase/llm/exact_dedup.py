"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A normalised text (A-Z lower-cased) is cut into chunks at places that depend
on its own words: a chunk ends at a line end or after a sentence, at least
``MIN_CHUNK`` characters after the last cut and at most ``MAX_CHUNK``. The
recipe of a text is its ordered list of chunk hashes.

1. Recipes are counted; only documents that share one go on, and of the
   others no text moves at all.
2. The chunks of these candidates are deduplicated by content before they
   are shuffled, and each distinct content under a hash gets a number, so
   (hash, number) is a verified identifier.
3. Hashes with one content (all, in practice) need no lookup. Where a hash
   has several, the recipes are rewritten by joining on the content.
4. Texts are equal exactly if their ordered identifier lists are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailcase.llm.tables import same, stored

MIN_CHUNK = 512
MAX_CHUNK = 4096
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; a null is the empty text."""
    t = F.coalesce(text, F.lit(""))
    # lower() is the same thing, and faster, where all characters are ASCII.
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, _UPPER, _UPPER.lower()))


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Chunks of a text in order; joined they give the text back."""
    cut = rf"(?s).{{{least},{most}}}?(?:\n|[.!?] )|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
                chunk_hash=F.xxhash64) -> DataFrame:
    """(key, keep_key, group_size, kept, text_sha256) of every row.

    Texts are equal when identical after lower-casing A-Z; null counts as the
    empty text. Of equal texts the row with the largest key stays (a null key
    is the smallest). Rows that repeat a key and a text count separately in
    ``group_size`` and all carry ``kept`` if theirs is the largest key. An
    empty table gives an empty result; other columns are not read.
    ``chunk_hash`` maps a string column to a long.
    """
    src = docs.select(F.col(key).alias("_key"), lower_ascii(F.col(text)).alias("_text"))
    cut = src.select("_key", "_text", chunks(F.col("_text")).alias("_chunks"))
    recipe = F.transform("_chunks", lambda c: chunk_hash(c))
    listed = stored(cut.select("_key", F.sha2("_text", 256).alias("_sha"), recipe.alias("_recipe")),
                    "recipes")
    shared = stored(listed.groupBy("_recipe").count().where("count > 1").select("_recipe"), "shared")

    # Verified identifiers: the distinct contents under each chunk hash.
    members = listed.join(shared, "_recipe", "left_semi").select("_key").distinct()
    members = stored(members, "members")
    long_texts = cut.select("_key", "_chunks")
    texts = long_texts.join(members, same(long_texts, members, ["_key"]), "left_semi")
    parts = (texts.select(F.explode("_chunks").alias("_chunk"))
             .select(chunk_hash(F.col("_chunk")).alias("_h"), "_chunk").distinct())
    w = Window.partitionBy("_h").orderBy("_chunk")
    ids = stored(parts.withColumn("_n", F.row_number().over(w) - 1)
                 .withColumn("_several", F.count(F.lit(1)).over(Window.partitionBy("_h")) > 1)
                 .where("_several").select("_h", "_chunk", "_n"), "identifiers")

    # Numbers for the chunks whose hash has several contents, by place in the text.
    if ids.isEmpty():
        fixed = listed.withColumn("_ids", F.array().cast("array<struct<at: int, n: int>>"))
    else:
        placed = cut.select("_key", F.sha2("_text", 256).alias("_sha"),
                            F.posexplode("_chunks").alias("_at", "_chunk"))
        placed = placed.withColumn("_h", chunk_hash(F.col("_chunk")))
        numbers = (placed.join(ids, ["_h", "_chunk"]).distinct().groupBy("_key", "_sha")
                   .agg(F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"),
                                                             F.col("_n").alias("n")))).alias("_ids")))
        fixed = listed.join(numbers, same(listed, numbers, ["_key", "_sha"]), "left").select(
            listed["_key"], listed["_sha"], "_recipe", "_ids")
    fixed = fixed.select("_key", "_sha", "_recipe",
                         F.coalesce("_ids", F.array().cast("array<struct<at: int, n: int>>")).alias("_ids"))
    groups = (fixed.groupBy("_recipe", "_ids")
              .agg(F.max("_key").alias("_keep"), F.count(F.lit(1)).alias("_size"))
              .where("_size > 1"))
    groups = stored(groups, "groups")
    out = fixed.join(groups, ["_recipe", "_ids"], "left")
    keep = F.when(F.col("_size").isNull(), F.col("_key")).otherwise(F.col("_keep"))
    return out.select(F.col("_key").alias(key), keep.alias("keep_" + key.removeprefix("doc_")),
                      F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("_key").eqNullSafe(keep).alias("kept"), F.col("_sha").alias("text_sha256"))
