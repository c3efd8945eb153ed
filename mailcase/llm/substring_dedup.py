"""Substring dedup by relative Lempel-Ziv parsing.

The reference of the parse is the corpus itself. It is cut into *blocks* at
content-defined anchors: of the 20-word windows of a document, consecutive
ones whose smallest 5-word hash sits on the same gram (the anchor) form a
block, which spans these windows' words. A window's anchor depends only on
its words, so two occurrences of a window always meet under one anchor.

1. Anchors that occur once in the corpus can't be part of a repeat and are
   dropped after a count (map-side combined, 8 bytes a row).
2. Greedy factors: a block whose anchor and whole content occur earlier in
   the index is copied whole from the first place that holds it, its source.
   Each content is kept once, however many copies there are.
3. Where a copied block is followed by one that is not copied whole, the
   factor is read on over the words that follow its source, as far as they
   agree. The words that both sides need are taken from the texts in one pass:
   those of a block (at most 35) and as many after the source.
4. What a factor does not reach is looked up anew: where an anchor is indexed
   with several contents, the first occurrence of each is cut into the windows
   that are left, and these are looked up one by one. A window that a factor
   reached need not be indexed, as its source holds it earlier.
5. Factors (blocks, what they were read on, windows) of at least 20 words whose
   words start earlier elsewhere are the duplicate spans.

The keys are 128 bits (anchor and content hash), and so are the names of texts
that share a document key. All joins are on them or on the document, sides are
pre-aggregated, and AQE may split a hot anchor. Texts are only shuffled where a
filter of the documents with boundaries or spans lets them through.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.llm.bloom import row_filter
from mailcase.llm.tables import same, stored
from mailcase.llm.wordhash import (NON_SPACE, Words, gram_hashes, mix, pieces, range_hashes,
                                   signed)

WINDOW = 20
GRAM = 5


def _anchors(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest entry of x[i:i+width] for each i."""
    idx, length = np.arange(len(x)), 1
    while length < width:
        step = min(length, width - length)
        left, right = idx[:-step], idx[step:]
        idx = np.where(x[right] < x[left], right, left)
        length += step
    return idx


def _windows(words: Words, window: int, gram: int):
    """(word hashes, gram hashes, starts of the windows inside a document, their anchors)."""
    h = words.hashes()
    x = gram_hashes(h, gram)
    if len(h) < window:
        none = np.zeros(0, dtype=np.int64)
        return h, x, none, none
    idx = _anchors(x, window - gram + 1)
    s = np.flatnonzero(np.arange(len(idx)) + window <= words.doc_end()[:len(idx)])
    return h, x, s, idx[s]


#: The 128 bits that stand for a text, as two longs.
ID = ("t1", "t2")
#: Type of the removed word ranges.
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def _places(batch: pa.RecordBatch, rows: np.ndarray, lo: np.ndarray, n) -> dict[str, pa.Array]:
    """Document, text and window range (first window and number of windows in one long)."""
    at = pa.array(rows)
    return {**{c: batch.column(c).take(at) for c in ("doc", *ID)},
            "at": pa.array((lo.astype(np.int64) << 32) | n)}


def _ranges(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of ranges packed by ``_places``."""
    v = packed.to_numpy(zero_copy_only=False)
    return v >> 32, v & 0xFFFFFFFF


def _blocks(window: int, gram: int):
    def run(batches):
        for b in batches:
            for i, j, buf, off in pieces(b.column("text")):
                words = Words(buf, off, NON_SPACE)
                h, x, s, p = _windows(words, window, gram)
                if not len(s):
                    continue
                new = np.ones(len(s), dtype=bool)
                new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
                at = np.flatnonzero(new)
                lo, p = s[at], p[at]
                n = np.diff(np.append(at, len(s)))
                c = range_hashes(h, lo, lo + n + window - 1)
                c = mix(c ^ ((p - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                doc = np.searchsorted(words.first, lo, "right") - 1
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(signed(x[p])), "c": pa.array(signed(c)),
                    **_places(b, doc + i, lo - words.first[doc], n)})
    return run


def _take(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values[lo:hi] of all ranges in a row)."""
    off = np.zeros(len(lo) + 1, dtype=np.int64)
    np.cumsum(hi - lo, out=off[1:])
    return off, values[np.repeat(lo - off[:-1], hi - lo) + np.arange(off[-1])]


def _lists(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    off, flat = _take(values, lo, hi)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(signed(flat)))


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of word lists; a null is an empty list."""
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy().astype(np.int64)
    return (col.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
            np.concatenate(([0], np.cumsum(sizes))))


#: Ranges whose words are handed on at once.
RANGES = 1 << 14
#: Added to the number of windows of an open block that a factor leads to.
LED = 1 << 31


def _passages(window: int, gram: int):
    """Word hashes of the listed ranges; one without windows has as many words as a block can."""
    longest = 2 * window - gram

    def run(batches):
        for b in batches:
            edges = b.column("edges")
            for i, j, buf, off in pieces(b.column("text")):
                words = Words(buf, off, NON_SPACE)
                h, part = words.hashes(), edges.slice(i, j - i)
                at, n = _ranges(part.flatten())
                size = n & (LED - 1)
                doc = np.repeat(np.arange(j - i), np.diff(part.offsets.to_numpy()))
                end = words.first[doc + 1]
                lo = np.minimum(words.first[doc] + at, end)
                hi = np.minimum(lo + np.where(size > 0, size + window - 1, longest), end)
                for k in range(0, len(at), RANGES):
                    r = slice(k, k + RANGES)
                    yield pa.RecordBatch.from_pydict({**_places(b, doc[r] + i, at[r], n[r]),
                                                      "words": _lists(h, lo[r], hi[r])})
    return run


def _agreeing(mine: pa.Array, theirs: pa.Array) -> np.ndarray:
    """Length of the common prefix of each pair of lists."""
    x, xo = _flat(mine)
    y, yo = _flat(theirs)
    n = np.minimum(np.diff(xo), np.diff(yo))
    off, left = _take(x, xo[:-1], xo[:-1] + n)
    _, right = _take(y, yo[:-1], yo[:-1] + n)
    row = np.repeat(np.arange(len(n)), n)
    bad = np.flatnonzero(left != right)
    np.minimum.at(n, row[bad], bad - off[row[bad]])
    return n


def _read_on(window: int):
    """Open blocks that a factor leads to, in two parts: the windows that the factor reaches
    over the words after its source (no words), and those that are left."""
    def run(batches):
        for b in batches:
            lo, n = _ranges(b.column("at"))
            n &= LED - 1
            reach = np.minimum(np.maximum(_agreeing(b.column("words"), b.column("theirs")) - window + 1, 0), n)
            got, left = np.flatnonzero(reach > 0), np.flatnonzero(reach < n)
            if len(got):
                yield pa.RecordBatch.from_pydict({
                    **_places(b, got, lo[got], reach[got]),
                    "words": pa.nulls(len(got), pa.list_(pa.int64()))})
            if len(left):
                h, off = _flat(b.column("words"))
                yield pa.RecordBatch.from_pydict({
                    **_places(b, left, (lo + reach)[left], (n - reach)[left]),
                    "words": _lists(h, (off[:-1] + reach)[left], off[1:][left])})
    return run


def _edge_windows(window: int, gram: int):
    """The single windows of word lists: (anchor hash, window hash, document, start)."""
    def run(batches):
        for b in batches:
            h, off = _flat(b.column("words"))
            if not len(h):
                continue
            lo, n = _ranges(b.column("at"))
            row = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            s = off[row] + k
            x = gram_hashes(h, gram)
            # The anchor depends on the words alone; the window hash covers all of them.
            a = x[_anchors(x, window - gram + 1)[s]]
            w = range_hashes(h, s, s + window)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(signed(a)), "w": pa.array(signed(w)),
                **_places(b, row, lo[row] + k, 1)})
    return run


def _keep(window: int):
    def run(batches):
        for whole in batches:
            # About a MB of texts at a time: kept texts and word lists never pile up for a batch.
            for i, j, *_ in pieces(whole.column("text")):
                b = whole.slice(i, j - i)
                yield _kept(b, window)
    return run


def _kept(b: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The result rows of some texts."""
    n_words, removed, kept, cut = [], [], [], []
    for t, sp in zip(b.column("text"), b.column("spans")):
        raw = t.as_buffer().to_pybytes() if t.is_valid else b""
        w = raw.split()            # bytes.split() cuts at \x20 and \x09-\x0D
        n = len(w)
        n_words.append(n)
        if not sp.is_valid or not len(sp.values):
            removed.append(0)
            cut.append([])
            kept.append(b" ".join(w).decode())
            continue
        lo, size = _ranges(sp.values)
        d = np.zeros(n + 2, dtype=np.int64)
        np.add.at(d, lo, 1)
        np.add.at(d, lo + size + window - 1, -1)
        gone = np.cumsum(d[:n]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        cut.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
        removed.append(int(gone.sum()))
        kept.append(b" ".join(itertools.compress(w, ~gone)).decode())
    return pa.RecordBatch.from_pydict({
        "doc": b.column("doc"), "n_words": pa.array(n_words, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string()),
        "spans": pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))})


def _split_join(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join of ``rows`` with an aggregate that has one row for each value of ``on``.

    AQE splits a hot key only where both sides are shuffled for the join. The
    aggregate already lies by ``on``, so a derived key is compared as well, by
    which its few rows are shuffled once more. It is not part of the rows.
    """
    k = keys.select(*[F.col(c).alias(f"_{c}") if c in on else c for c in keys.columns]).hint("merge")
    mine, theirs = [rows[c] for c in on], [k[f"_{c}"] for c in on]
    cond = F.hash(*mine) == F.hash(*theirs)
    for x, y in zip(mine, theirs):
        cond = cond & (x == y)
    return rows.join(k, cond, how)


def _with_ranges(src: DataFrame, ranges: DataFrame, name: str, how: str = "inner",
                 listed: Column | None = None) -> DataFrame:
    """The rows of ``src`` that a filter of the listed rows lets through, with their ranges.

    Only these texts are shuffled. ``ranges`` is a written table.
    """
    row = ["doc", *ID]
    listed = row_filter(ranges.select(*row))(*row) if listed is None else listed
    per = ranges.groupBy(*row).agg(F.collect_list("at").alias(name)).hint("merge")
    hit = src.where(listed)
    return hit.join(per, same(hit, per, row), how).select(*[hit[c] for c in hit.columns], name)


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, n_words, n_removed, kept_text, spans) of every document.

    A word is removed if a window of ``window`` words that covers it also
    starts earlier: in a document of smaller key, or before in the same one.
    ``spans`` lists the removed word ranges, ``kept_text`` the kept words
    joined by one space.

    Null and empty texts have no words and keep the empty text. A null key is
    smaller than any other. Rows that share a key are told apart by a hash of
    their text and ordered by it; equal rows (same key and text) count as one
    document and get equal results. An empty table gives an empty result;
    columns other than key and text are not read.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    src = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    src = src.select("doc", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")
    row = ["doc", *ID]
    kind = f"doc {src.schema['doc'].dataType.simpleString()}, t1 long, t2 long, at long"
    blocks = src.mapInArrow(_blocks(window, gram), f"a long, c long, {kind}")
    repeated = blocks.groupBy("a").count().where("count > 1").select("a")
    hits = stored(_split_join(blocks, repeated, ["a"], "left_semi"), "blocks")

    place = F.struct(*row, "at")
    # Written once: three steps read it, each other columns.
    first = stored(hits.groupBy("a", "c").agg(F.min(place).alias("f"),
                                              F.count(F.lit(1)).alias("copies")), "contents")
    copied = first.where("copies > 1").select("a", "c", "f")
    factors = stored(hits.join(copied.hint("merge"), ["a", "c"]).where(~place.eqNullSafe(F.col("f")))
                     .select(*row, "at", "f"), "factors")

    several = first.groupBy("a").count().where("count > 1").select("a")
    open_blocks = stored(_split_join(first, several, ["a"], "left_semi").select("f.*"), "edges")
    # Positions are packed as in ``_places``; one without windows is the start of a passage.
    open_at = open_blocks.select(*row, "at", F.expr("at >> 32 << 32").alias("start"))
    after = factors.select(*row, F.expr("((at >> 32) + (at & 4294967295)) << 32").alias("start"),
                           F.struct(*[F.col(f"f.{c}").alias(c) for c in row],
                                    F.expr("((f.at >> 32) + (at & 4294967295)) << 32").alias("at")).alias("go_on"))
    at_open = row_filter(open_at.select(*row, "start"))
    # Equal rows have equal factors; one of them is enough.
    after = after.where(at_open(*row, "start")).groupBy(*row, "start").agg(F.min("go_on").alias("go_on"))
    marked = stored(open_at.join(after, same(open_at, after, [*row, "start"]), "left").select(
        *[open_at[c] for c in row], F.when(F.col("go_on").isNull(), open_at["at"])
        .otherwise(open_at["at"].bitwiseOR(F.lit(LED))).alias("at"), "go_on"), "ends")
    ends = marked.where("go_on is not null")
    wanted = stored(marked.select(*row, "at").unionByName(ends.select("go_on.*").distinct()), "ranges")
    words = stored(_with_ranges(src, wanted, "edges").mapInArrow(
        _passages(window, gram), f"{kind}, words array<bigint>"), "words")
    size = F.col("at").bitwiseAND(F.lit((1 << 32) - 1))
    # Only the blocks that a factor leads to, and what follows its source, are brought together.
    passages = words.where(size == 0).select(F.struct(*row, "at").alias("p"), F.col("words").alias("theirs"))
    source = ends.join(passages.hint("merge"), F.col("go_on").eqNullSafe(F.col("p"))).select(*row, "at", "theirs")
    led = words.where(size >= LED)
    read = led.join(source.hint("merge"), same(led, source, [*row, "at"])).select(
        *[led[c] for c in (*row, "at", "words")], "theirs")
    read = stored(read.mapInArrow(_read_on(window), f"{kind}, words array<bigint>"), "open")
    reached = read.where("words is null").select(*row, "at")

    left = words.where((size > 0) & (size < LED)).unionByName(read.where("words is not null"))
    single = left.mapInArrow(_edge_windows(window, gram), f"a long, w long, {kind}")
    seen = (single.groupBy("a", "w").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("copies"))
            .where("copies > 1").select("a", "w", "f"))
    borders = _split_join(single, seen, ["a", "w"]).where(~place.eqNullSafe(F.col("f"))).select(*row, "at")

    found = stored(factors.select(*row, "at").unionByName(reached).unionByName(borders), "spans")
    loses = row_filter(found.select(*row))(*row)
    joined = _with_ranges(src, found, "spans", "left", loses).select("doc", "text", "spans")
    cut = joined.mapInArrow(_keep(window), T.StructType([
        T.StructField("doc", src.schema["doc"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
        T.StructField("spans", SPANS)]))
    # A text that loses nothing needs no Python beside the filter's.
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    whole = src.where(~loses).select("doc", kept.alias("kept_text")).select(
        "doc", F.when(F.col("kept_text") == "", 0)
        .otherwise(F.length("kept_text") - F.length(F.translate("kept_text", " ", "")) + 1)
        .cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), "kept_text",
        F.array().cast(SPANS).alias("spans"))
    return cut.unionByName(whole).withColumnRenamed("doc", key)
