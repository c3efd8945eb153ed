"""Line dedup with two Bloom filters per hash range.

1. Every document gives each of its distinct line keys as a 64-bit hash;
   a task passes a hash on at most twice for each piece it works on (it only
   matters whether a hash is seen once or more often). Hashes are dealt by
   range to shards; a shard's task runs them through two Bloom filters: a
   hash that the *once* filter knows goes into the *twice* filter.
2. The twice filters of all shards, together of bounded size, are sent to the
   tasks that read the documents. Only lines that they suspect leave their
   task, as text, and are counted exactly: by key the number of documents
   and the largest document.
3. Confirmed keys are joined back to the suspected lines, which gives the
   lines that each document loses.
4. A third filter, of the documents that lose lines, tells the others in their
   own task: they are written as they are, by column functions (the filter has
   a Python worker already), and only the texts that the filter lets through
   are shuffled to meet their dropped lines.

Bloom filters have no false negatives and every suspicion is confirmed by
text, so the result is exact; a crowded filter only costs more shuffling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.llm.bloom import has, put, row_filter
from mailcase.llm.tables import same, small_batches, stored, text_id
from mailcase.llm.wordhash import LOWER, byte_hashes, pieces, signed

MIN_CHARS = 20
MIN_DOCS = 3
#: Bits of all twice filters together (32 MB, the bound of the broadcast), and
#: the largest number of shards they are cut into.
MAX_BITS = 1 << 28
MAX_SHARDS = 1024
SHARD_BYTES = 1 << 26
BITS_A_KEY = 16

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _lines(buf: np.ndarray, off: np.ndarray):
    """(starts, ends, first line of each document) of all lines, in bytes."""
    lo, hi = int(off[0]), int(off[-1])
    breaks = np.flatnonzero(buf[lo:hi] == 10) + lo
    first = np.searchsorted(breaks, off, "left") + np.arange(len(off))
    starts = np.empty(len(breaks) + len(off) - 1, dtype=np.int64)
    ends = np.empty_like(starts)
    is_doc_start = np.zeros(len(starts), dtype=bool)
    is_doc_start[first[:-1]] = True
    starts[is_doc_start] = off[:-1]
    starts[~is_doc_start] = breaks + 1
    is_doc_end = np.zeros(len(starts), dtype=bool)
    is_doc_end[first[1:] - 1] = True
    ends[is_doc_end] = off[1:]
    ends[~is_doc_end] = breaks
    return starts, ends, first


def _stripped(buf, off, starts, ends):
    """Line ranges without white space at both ends (empty ranges for blank lines)."""
    lo, hi = int(off[0]), int(off[-1])
    ink = np.flatnonzero(~_SPACE[buf[lo:hi]]) + lo
    if not len(ink):
        return starts, starts
    a = np.minimum(np.searchsorted(ink, starts, "left"), len(ink) - 1)
    z = np.maximum(np.searchsorted(ink, ends, "left") - 1, 0)
    s, e = ink[a], ink[z] + 1
    blank = (s >= ends) | (s < starts) | (e <= starts)
    return np.where(blank, starts, s), np.where(blank, starts, e)


def _keys(buf, off, least: int):
    """(line index, key hash, starts, ends, first) of the lines long enough."""
    starts, ends, first = _lines(buf, off)
    s, e = _stripped(buf, off, starts, ends)
    lo, hi = int(off[0]), int(off[-1])
    # Code points: bytes that do not continue a character.
    points = np.zeros(hi - lo + 1, dtype=np.int32 if hi - lo < 1 << 31 else np.int64)
    np.cumsum((buf[lo:hi] & 0xC0) != 0x80, out=points[1:])
    long_ = np.flatnonzero(points[e - lo] - points[s - lo] >= least)
    s, e = s[long_], e[long_]
    return long_, byte_hashes(buf, s, e, LOWER), s, e, first


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash by its first bits (``shards`` is a power of two)."""
    return ((h >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int32)


def _emit_hashes(least: int, shards: int):
    def run(batches):
        for b in batches:
            for _, _, buf, off in pieces(b.column("text")):
                line, h, _, _, first = _keys(buf, off, least)
                doc = np.searchsorted(first, line, "right") - 1
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                # Each key once a document, then at most twice a piece.
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h = h[new]
                if len(h) > 2:
                    h = h[np.concatenate(([True, True], h[2:] != h[:-2]))]
                yield pa.RecordBatch.from_pydict({"shard": pa.array(_shard(h, shards)),
                                                  "h": pa.array(signed(h))})
    return run


def _twice(bits: int):
    """Runs each shard's hashes through the once and twice filters."""
    def run(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for b in batches:
            h_all = b.column("h").to_numpy().view(np.uint64)
            s_all = b.column("shard").to_numpy()
            for s in np.unique(s_all).tolist():
                a = once.setdefault(s, np.zeros(bits // 8, dtype=np.uint8))
                z = twice.setdefault(s, np.zeros(bits // 8, dtype=np.uint8))
                h, n = np.unique(h_all[s_all == s], return_counts=True)
                put(z, h[has(a, h) | (n > 1)])
                put(a, h)
        for s, z in twice.items():
            yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()),
                                              "bits": pa.array([z.tobytes()], pa.binary())})
    return run


def _suspects(filters, least: int, shards: int):
    """(doc, tag, line key) for each distinct suspected line of each document."""
    def run(batches):
        table = filters.value
        for b in batches:
            for i, _, buf, off in pieces(b.column("text")):
                line, h, s, e, first = _keys(buf, off, least)
                ok = np.zeros(len(h), dtype=bool)
                shard = _shard(h, shards)
                for k, bitmap in table.items():
                    mine = np.flatnonzero(shard == k)
                    if len(mine):
                        ok[mine] = has(bitmap, h[mine])
                doc = np.searchsorted(first, line, "right") - 1
                found = sorted({(int(d), LOWER[buf[x:y]].tobytes()) for d, x, y in
                                zip(doc[ok], s[ok], e[ok])})
                rows = pa.array([d + i for d, _ in found], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc": b.column("doc").take(rows), "tag": b.column("tag").take(rows),
                    "line": pa.array([k.decode() for _, k in found], pa.string())})
    return run


def _drop(least: int, text: int):
    """``text``: position of the text among the columns of ``row``."""
    def parts(batches):
        """Rows with about a MB of text: what is made of a batch is not held as a whole."""
        for b in batches:
            for i, j, _, _ in pieces(b.column("row").field(text)):
                yield b.slice(i, j - i)

    def run(batches):
        for b in parts(batches):
            n_lines, n_dropped, kept = [], [], []
            for t, drop in zip(b.column("row").field(text), b.column("drop")):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                lines = raw.split(b"\n")
                n_lines.append(len(lines))
                if drop.is_valid:
                    gone = {x.as_buffer().to_pybytes() for x in drop.values}
                    # bytes.lower() and strip() know ASCII letters and white space only
                    lines = [x for x in lines
                             if len(x) < least or x.strip(b" \t\n\x0b\x0c\r").lower() not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines).decode())
            yield pa.RecordBatch.from_pydict({
                "row": b.column("row"), "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                "kept_text": pa.array(kept, pa.string())})
    return run


def filter_size(n_bytes: int) -> tuple[int, int]:
    """(shards, bits of one shard's filter) for a corpus of so many bytes, powers
    of two: a shard for each ``SHARD_BYTES``, and ``BITS_A_KEY`` bits for each
    line if all lines were twice the shortest one that counts."""
    shards = min(MAX_SHARDS, max(8, 1 << (n_bytes // SHARD_BYTES).bit_length()))
    bits = int(n_bytes / (2 * MIN_CHARS) * BITS_A_KEY / shards)
    return shards, min(MAX_BITS // shards, max(1 << 12, 1 << bits.bit_length()))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, n_lines, n_dropped, kept_text): every input row as struct ``row``.

    A text is split at \\n; a line's key is the line without ASCII white space
    at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
    found in at least ``min_docs`` documents lose all their lines except in
    the largest document that holds them.

    Null and empty texts are one empty line (kept text ""). Documents are
    ordered by key, a null key smallest; rows that share a key but not the
    text are documents of their own, ordered by a hash of the text; equal rows
    count as one document and get equal results. Lines repeated inside one
    document count once, and stay or go together. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.struct("*").alias("row"), F.col(key).alias("doc"), F.col(text).alias("text"))
    src = src.withColumn("tag", text_id("text"))
    kind = src.schema["doc"].dataType.simpleString()
    n_bytes = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, bits = filter_size(n_bytes)

    hashes = src.select("text").mapInArrow(_emit_hashes(min_chars, shards), "shard int, h long")
    twice = hashes.repartition(shards, "shard").mapInArrow(_twice(bits), "shard int, bits binary")
    with small_batches(spark):
        twice = twice.collect()
    filters = spark.sparkContext.broadcast(
        {r["shard"]: np.frombuffer(bytes(r["bits"]), dtype=np.uint8) for r in twice})

    suspects = stored(src.select("doc", "tag", "text").mapInArrow(
        _suspects(filters, min_chars, shards), f"doc {kind}, tag binary, line string"), "suspects")
    place = F.struct("doc", "tag")
    confirmed = stored(suspects.distinct().groupBy("line").agg(
        F.count(F.lit(1)).alias("n"), F.max(place).alias("last")).where(F.col("n") >= min_docs)
        .select("line", "last"), "confirmed")
    dropped = stored(suspects.join(confirmed, "line").where(~place.eqNullSafe(F.col("last")))
                     .select("doc", "tag", "line"), "dropped")
    drops = dropped.groupBy("doc", "tag").agg(F.collect_set("line").alias("drop")).hint("merge")
    loses = row_filter(dropped.select("doc", "tag"))("doc", "tag")
    hit = src.where(loses)
    j = hit.join(drops, same(hit, drops, ["doc", "tag"]), "left").select("row", "drop")
    at = [c.lower() for c in docs.columns].index(text.lower())
    cut = j.mapInArrow(_drop(min_chars, at), T.StructType([
        src.schema["row"], T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]))
    # A text that loses nothing needs no Python beside the filter's.
    kept = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(kept) - F.octet_length(F.replace(kept, F.lit("\n"), F.lit("")))
    whole = src.where(~loses).select("row", (breaks + 1).cast("long").alias("n_lines"),
                                     F.lit(0).cast("long").alias("n_dropped"), kept.alias("kept_text"))
    return cut.unionByName(whole)
