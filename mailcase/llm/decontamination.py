"""Benchmark decontamination as a prefix-filtered set join.

Each benchmark item is cut into windows of 13 words (a shorter item is one
window). A window is a record whose elements are its 5-word shingles; a
document contains the window only if it contains every shingle, so the
prefix that must be joined is the single rarest one.

1. Rarity: the occurrences of the benchmark's shingles in the corpus are
   counted over all documents (one table of one number per shingle).
2. Prefix join: a document's shingles are looked up among the windows'
   rarest shingles.
3. Positional and length bounds: the shingle's offset in the window gives the
   only possible start, which must leave room for the window in the document.
4. Verification: all words of the window are compared.

The windows are a stated query set. They go out in blocks of at most
``MAX_WINDOWS`` (a bounded broadcast); a larger benchmark takes more passes
over the documents, and the document text is never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.llm.tables import TAG, stored, summed_table, text_tag
from mailcase.llm.wordhash import ALNUM, LOWER, Words, gram_hashes, pieces

WINDOW = 13
SHINGLE = 5
#: Windows of one broadcast block: about 100 bytes each.
MAX_WINDOWS = 200_000


def _cut_items(window: int):
    """(item, words): one row per window; words are 8-byte word hashes."""
    def run(batches):
        for b in batches:
            item, words = [], []
            for i, j, buf, off in pieces(b.column("text")):
                w = Words(buf, off, ALNUM)
                h = w.hashes(LOWER)
                for d, (s, e) in enumerate(zip(w.first[:-1], w.first[1:])):
                    name = b.column("item")[i + d].as_py()
                    for k in range(s, max(e - window, s) + 1) if e > s else ():
                        item.append(name)
                        words.append(h[k:min(k + window, e)].tobytes())
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.string()),
                                              "words": pa.array(words, pa.binary())})
    return run


class _Block:
    """Windows of one block, with the shingles of every window."""

    def __init__(self, items: list[str], words: list[bytes], shingle: int):
        self.items = items
        self.length = np.array([len(w) // 8 for w in words], dtype=np.int64)
        width = int(self.length.max(initial=1))
        self.words = np.zeros((len(words), width), dtype=np.uint64)
        for r, w in enumerate(words):
            self.words[r, :len(w) // 8] = np.frombuffer(w, dtype=np.uint64)
        # A window of fewer words than a shingle is one shingle of its length.
        self.size = np.minimum(self.length, shingle)
        rec, off, key = [], [], []
        for n in range(1, shingle + 1):
            rows = np.flatnonzero(self.size == n)
            for o in range(width - n + 1):
                r = rows[o + n <= self.length[rows]]
                if len(r):
                    acc = np.concatenate([gram_hashes(x, n, n) for x in self.words[r, o:o + n]])
                    rec.append(r)
                    off.append(np.full(len(r), o))
                    key.append(acc)
        none = [np.zeros(0, dtype=np.int64)]
        self.rec, self.off = np.concatenate(rec or none), np.concatenate(off or none)
        self.key = np.concatenate(key or [np.zeros(0, dtype=np.uint64)])
        self.shingles = np.unique(self.key)
        self.sizes = sorted(set(self.size.tolist()))

    def choose_prefix(self, counts: np.ndarray) -> None:
        """Keep each window's rarest shingle (ties: smaller hash, then first offset)."""
        c = counts[np.searchsorted(self.shingles, self.key)]
        order = np.lexsort((self.off, self.key, c, self.rec))
        first = order[np.concatenate(([True], self.rec[order][1:] != self.rec[order][:-1]))] \
            if len(order) else order
        by = first[np.argsort(self.key[first], kind="stable")]
        self.rec, self.off, self.key = self.rec[by], self.off[by], self.key[by]
        self.shingles, self.from_ = np.unique(self.key, return_index=True)
        self.to = np.append(self.from_[1:], len(self.key))


def _found(keys: np.ndarray, sorted_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in keys, positions in sorted_set) of the keys in the set."""
    if not len(sorted_set) or not len(keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)
    q = np.flatnonzero(sorted_set[at] == keys)
    return q, at[q]


def _count_shingles(block):
    def run(batches, table):
        v = block.value
        for b in batches:
            for i, j, buf, off in pieces(b.column("text")):
                w = Words(buf, off, ALNUM)
                h, end = w.hashes(LOWER), w.doc_end()
                for n in v.sizes:
                    q, at = _found(gram_hashes(h, n, n), v.shingles)
                    at = at[q + n <= end[q]]
                    table += np.bincount(at, minlength=len(table))
    return run


def _probe(block, every: bool):
    """Hit ranges and items of each document; only documents with hits unless ``every``."""
    def run(batches):
        v = block.value
        for b in batches:
            rows, n_words, ranges, items = [], [], [], []
            for i, j, buf, off in pieces(b.column("text")):
                w = Words(buf, off, ALNUM)
                h, end = w.hashes(LOWER), w.doc_end()
                starts, recs = [], []
                for n in v.sizes:
                    q, at = _found(gram_hashes(h, n, n), v.shingles)
                    per = v.to[at] - v.from_[at]
                    e = np.repeat(v.from_[at], per) + np.arange(per.sum()) - \
                        np.repeat(np.cumsum(per) - per, per)
                    q, r = np.repeat(q, per), v.rec[e]
                    s = q - v.off[e]
                    ok = s >= 0
                    q, r, s = q[ok], r[ok], s[ok]
                    # Length bound, and both ends inside one document.
                    ok = (s + v.length[r] <= end[q]) & (end[s] == end[q])
                    r, s = r[ok], s[ok]
                    ok = np.ones(len(r), dtype=bool)
                    for k in range(v.words.shape[1]):
                        inside = k < v.length[r]
                        ok &= ~inside | (h[np.where(inside, s + k, s)] == v.words[r, k])
                    starts.append(s[ok])
                    recs.append(r[ok])
                s = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
                r = np.concatenate(recs) if recs else s
                d = np.zeros(len(h) + 1, dtype=np.int64)
                np.add.at(d, s, 1)
                np.add.at(d, s + v.length[r], -1)
                hit = np.cumsum(d[:-1]) > 0
                doc = np.searchsorted(w.first, s, "right") - 1
                named: dict[int, set] = {}
                for x, y in set(zip(doc.tolist(), r.tolist())):
                    named.setdefault(x, set()).add(v.items[y])
                for x in range(j - i) if every else sorted(named):
                    lo, hi = w.first[x], w.first[x + 1]
                    rows.append(i + x)
                    n_words.append(int(hi - lo))
                    if x not in named:
                        ranges.append([])
                        items.append([])
                        continue
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[lo:hi], [0]))))
                    ranges.append([{"lo": int(p), "hi": int(q)} for p, q in
                                   zip(edge[::2], edge[1::2])])
                    items.append(sorted(named[x]))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc": b.column("doc").take(take), "tag": b.column("tag").take(take),
                "n_words": pa.array(n_words, pa.int64()),
                "ranges": pa.array(ranges, pa.list_(pa.struct([("lo", pa.int32()),
                                                               ("hi", pa.int32())]))),
                "items": pa.array(items, pa.list_(pa.string()))})
    return run


def _covered(ranges: Column) -> Column:
    """Words in the union of [lo, hi) ranges."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(ranges), start,
        lambda a, x: F.struct(
            F.greatest(a["end"], x["hi"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(a["end"], x["lo"]))).alias("n")),
        lambda a: a["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", *, window: int = WINDOW,
                  shingle: int = SHINGLE, share: int = 20,
                  max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(key, text_hash, text_id, n_words, n_hit, items, contaminated) of every document.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased. A word inside any occurrence of an item window is hit;
    ``items`` lists the ids (as strings, sorted) of the items with occurring
    windows. A document is contaminated if ``share`` times its hit words reach
    its words and it has a hit.

    Null and empty texts have no words; items without words have no window.
    An item with a null id is reported under the empty string. Every row is a
    document: rows that share a key, a text or both each have their row
    (``text_id`` tells the texts of a key apart). Empty tables and other
    columns change nothing.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    src = src.select("doc", text_tag("text").alias("tag"), "text")
    kind = src.schema["doc"].dataType.simpleString()
    wins = stored(benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                                   F.col(item_text).alias("text"))
                  .mapInArrow(_cut_items(window), "item string, words binary").distinct(),
                  "windows")
    n_blocks = max(1, -(-wins.count() // max_windows))
    hits = None
    for i in range(n_blocks):
        mine = F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)) == i
        got = wins.where(mine).orderBy("item", "words").toArrow()
        block = _Block(got.column("item").to_pylist(), got.column("words").to_pylist(), shingle)
        sent = spark.sparkContext.broadcast(block)
        size = max(1, len(block.shingles))
        block.choose_prefix(summed_table(src.select("text"), size, _count_shingles(sent)))
        sent = spark.sparkContext.broadcast(block)
        part = src.mapInArrow(
            _probe(sent, i == 0), f"doc {kind}, tag {TAG}, n_words long, "
            "ranges array<struct<lo: int, hi: int>>, items array<string>").withColumn("block", F.lit(i))
        hits = part if hits is None else hits.unionByName(part)
    g = hits                               # one block of windows: a row is complete as it is
    if n_blocks > 1:
        # Equal rows have equal hits in a block: one of them stands for all, and the first block counts them.
        g = hits.groupBy("doc", "tag", "block").agg(
            F.count_if(F.col("block") == 0).alias("n"), F.first("n_words").alias("n_words"),
            F.first("ranges").alias("ranges"), F.first("items").alias("items"))
        g = g.groupBy("doc", "tag").agg(
            F.max("n").alias("n"), F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("ranges")).alias("ranges"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        g = g.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))))
    g = g.select(F.col("doc").alias(key), F.col("tag.h").alias("text_hash"), F.col("tag.id").alias("text_id"),
                 "n_words", _covered(F.col("ranges")).alias("n_hit"), "items")
    return g.withColumn("contaminated", (F.col("n_hit") > 0)
                        & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))
