"""Ranked lexical search: the Best Position Algorithm over impact lists of document shards.

1. One scan counts, for the terms of a block of items, the documents that hold
   them, and over all documents their number N and total length L.
2. In a second scan each task builds, for shards of its documents, one list per
   term: the documents by falling impact, and the same postings by document
   for direct access.
3. For an item the lists of its terms are read in parallel. A document met
   anywhere is scored at once by direct access to all lists, and its position
   is marked as seen in each. A list's best position ends its unbroken run of
   seen positions, which is never before the last position read by sorted
   access and often far beyond it. The sum of the impacts at the best positions
   bounds every unseen document; the search stops when it is strictly below
   the k-th score, so that ties of the k-th are still found. The k best of the
   earlier shards of a task count too.
4. A task returns at most k documents an item; these are merged in two steps.

Items go in blocks bounded by number and bytes, so neither the driver nor a
task holds more than one block. Impacts are 64-bit integers; a term's weight
comes from N and its document frequency. Terms are found by hash and then
compared byte by byte.

Rules: texts and items that are null or hold no term match nothing. Every row
of ``docs`` is a document, equal rows too; every row of ``items`` is an item,
so a repeated one has its ranking once per row. Null keys rank behind others
of equal score. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailcase.llm.tables import stored, summed_table
from mailcase.llm.wordhash import ALNUM, LOWER, Words, pieces, text_buffers

TOP = 20
#: Bounds of a block of items.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 1 << 21
#: Postings of a shard, after which its items are searched and it is let go.
SHARD_POSTINGS = 1 << 21
#: First number of positions read by sorted access before the bound is checked.
STEP = 64
_NO_KEY = np.iinfo(np.int64).max


class Terms:
    """The distinct terms of a block of items, and each item's terms with their repeats."""

    def __init__(self, texts: list[str | None]):
        col = pa.array(texts, pa.string())
        buf, off = text_buffers(col)
        w = Words(buf, off, ALNUM)
        folded = LOWER[buf].tobytes()
        found = [folded[s:e] for s, e in zip(w.starts.tolist(), w.ends.tolist())]
        self.terms = sorted(set(found))
        number = {t: i for i, t in enumerate(self.terms)}
        self.items = [Counter(number[t] for t in found[a:b]) for a, b in zip(w.first[:-1], w.first[1:])]
        self.bytes = np.frombuffer(b"".join(self.terms), dtype=np.uint8)
        self.size = np.array([len(t) for t in self.terms], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        each = Words(self.bytes, np.append(self.begin, len(self.bytes)), ALNUM)
        hashes = each.hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def __len__(self) -> int:
        return len(self.terms)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term): the words that are terms of the block, and which."""
        if not len(self) or not len(w.starts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        h = w.hashes(LOWER)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self) - 1)
        word = np.flatnonzero(self.hashes[at] == h)
        term = self.order[at[word]]
        n = self.size[term]
        fits = n == w.ends[word] - w.starts[word]
        word, term, n = word[fits], term[fits], n[fits]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        equal = LOWER[w.buf[np.repeat(w.starts[word], n) + inside]] == \
            self.bytes[np.repeat(self.begin[term], n) + inside]
        differ = np.unique(np.repeat(np.arange(len(word)), n)[~equal])
        return np.delete(word, differ), np.delete(term, differ)


def _counted(terms: Terms, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences), sorted by document."""
    word, term = terms.find(w)
    doc = np.searchsorted(w.first, word, "right") - 1
    key, tf = np.unique(doc * np.int64(len(terms) or 1) + term, return_counts=True)
    return key // (len(terms) or 1), key % (len(terms) or 1), tf.astype(np.int64)


def corpus_counts(docs: DataFrame, terms: Terms, text: str = "text") -> tuple[np.ndarray, int, int]:
    """(documents per term, N, L) over all rows."""
    size = len(terms)

    def count(batches, table):
        for b in batches:
            for _, _, buf, off in pieces(b.column(0)):
                w = Words(buf, off, ALNUM)
                _, term, _ = _counted(terms, w)
                table[:size] += np.bincount(term, minlength=size)[:size]
                table[size] += (w.counts > 0).sum()
                table[size + 1] += len(w.starts)

    out = summed_table(docs.select(F.col(text).cast("string")), size + 2, count)
    return out[:size], int(out[size]), int(out[size + 1])


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in df],
                    dtype=np.int64)


class Shard:
    """Impact lists of some documents, for one block of items.

    Postings are held twice: by (term, document) for direct access, and by
    (term, falling impact); ``place`` leads from the first to the second.
    Documents are numbered by rising key.
    """

    def __init__(self, keys: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        rank = np.argsort(keys, kind="stable")
        number = np.empty(len(keys), dtype=np.int64)
        number[rank] = np.arange(len(keys))
        self.keys, self.n = keys[rank], len(keys)
        doc = number[doc]
        order = np.lexsort((doc, term))
        doc, term, self.impact = doc[order], term[order], impact[order]
        self.cell = term * self.n + doc
        by_impact = np.lexsort((doc, -self.impact, term))
        self.listed, self.height = doc[by_impact], self.impact[by_impact]
        self.place = np.empty(len(doc), dtype=np.int64)
        self.place[by_impact] = np.arange(len(doc))
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.seen = np.zeros(len(doc), dtype=bool)
        self.score = np.zeros(self.n, dtype=np.int64)
        self.met = np.zeros(self.n, dtype=bool)

    def _direct(self, new: np.ndarray, lists: np.ndarray, repeats: np.ndarray) -> None:
        """Scores documents by direct access to all lists and marks their positions as seen."""
        rows = max(1, (1 << 18) // len(lists))
        for i in range(0, len(new), rows):
            part = new[i:i + rows]
            cell = (lists[:, None] * self.n + part[None, :]).ravel()
            at = np.minimum(np.searchsorted(self.cell, cell), len(self.cell) - 1)
            hit = self.cell[at] == cell
            gain = np.where(hit, self.impact[at], 0).reshape(len(lists), -1) * repeats[:, None]
            self.score[part] = gain.sum(axis=0)
            self.seen[self.place[at[hit]]] = True
        self.met[new] = True

    def search(self, item: Counter, k: int, floor: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents by rank, their scores, positions read): the k best of this shard.

        ``floor``: scores already held by documents of other shards; a document
        that k of them beat strictly need not be found.
        """
        lists = np.array([t for t in sorted(item) if self.first[t] < self.first[t + 1]], dtype=np.int64)
        if not len(lists):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
        repeats = np.array([item[int(t)] for t in lists], dtype=np.int64)
        start, end = self.first[lists], self.first[lists + 1]
        best = start.copy()                       # first position not seen without a break
        met: list[np.ndarray] = []
        held = np.array(sorted(floor, reverse=True)[:k], dtype=np.int64)
        depth, step = 0, STEP
        while True:
            read = [self.listed[s + depth:min(e, s + depth + step)] for s, e in zip(start, end)]
            depth, step = depth + step, step * 2
            new = np.unique(np.concatenate(read))
            new = new[~self.met[new]]
            if len(new):
                self._direct(new, lists, repeats)
                met.append(new)
                held = np.concatenate([held, self.score[new]])
                if len(held) > k:
                    held = np.partition(held, len(held) - k)[len(held) - k:]
            bound = 0
            for i in range(len(lists)):
                b, e = int(best[i]), int(end[i])
                while b < e:                      # the unbroken run grows by blocks
                    run = self.seen[b:min(e, b + 1024)]
                    gap = int(run.argmin())
                    if not run[gap]:
                        b += gap
                        break
                    b += len(run)
                best[i] = b
                if b < e:                         # the impact at the best position, its own if none is seen
                    bound += int(self.height[max(b - 1, int(start[i]))]) * int(repeats[i])
            if (best == end).all() or (len(held) >= k and bound < held.min()):
                break
        docs = np.concatenate(met)
        score = self.score[docs]
        top = np.lexsort((docs, -score))[:k]
        found, points = docs[top], score[top]
        for s, e in zip(start, end):
            self.seen[s:e] = False
        self.met[docs] = False
        keep = points > 0
        return found[keep], points[keep], int(np.minimum(depth, end - start).sum())


def _merge(held: list, keys: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The k best of both, as (-score, key)."""
    return sorted(held + list(zip((-scores).tolist(), keys.tolist())))[:k]


def search_block(docs: DataFrame, terms: Terms, df: np.ndarray, n: int, total: int, *, key: str = "doc_id",
                 text: str = "text", k: int = TOP, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item, key, score): the k best documents of each task for each item of a block, by item number."""
    w_of = weights(df, n)

    def scan(batches):
        best: list[list] = [[] for _ in terms.items]
        keys, parts, rows, held = [], [], 0, 0

        def flush():
            if parts:
                doc, term, impact = (np.concatenate(x) for x in zip(*parts))
                shard = Shard(np.concatenate(keys), doc, term, impact, len(terms))
                for i, item in enumerate(terms.items):
                    found, scores, _ = shard.search(item, k, [-s for s, _ in best[i]])
                    best[i] = _merge(best[i], shard.keys[found], scores, k)

        for b in batches:
            ids = b.column(0).fill_null(_NO_KEY).to_numpy()
            for lo, hi, buf, off in pieces(b.column(1)):
                w = Words(buf, off, ALNUM)
                doc, term, tf = _counted(terms, w)
                use = w_of[term] > 0              # a weight of 0 adds nothing to any score
                doc, term, tf = doc[use], term[use], tf[use]
                some, doc = np.unique(doc, return_inverse=True)
                m = 75 + (25 * w.counts[some] * n) // max(1, total)
                impact = w_of[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                keys.append(ids[lo:hi][some])
                parts.append((doc + rows, term, impact))
                rows, held = rows + len(some), held + len(doc)
                if held >= shard_postings:
                    flush()
                    keys, parts, rows, held = [], [], 0, 0
        flush()
        item = [i for i, found in enumerate(best) for _ in found]
        pair = [p for found in best for p in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([p[1] if p[1] != _NO_KEY else None for p in pair], pa.int64()),
             pa.array([-p[0] for p in pair], pa.int64())], ["item", "doc_id", "score"])

    source = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return source.mapInArrow(scan, "item int, doc_id long, score long")


def _blocks(items: DataFrame, item: str, text: str):
    """Lists of (item key, text) within the bounds of a block, streamed to the driver."""
    rows, held = [], 0
    for r in items.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t")).toLocalIterator():
        n = len((r.t or "").encode())
        if rows and (len(rows) >= BLOCK_ITEMS or held + n > BLOCK_BYTES):
            yield rows
            rows, held = [], 0
        rows.append((r.i, r.t))
        held += n
    if rows:
        yield rows


def ranked_search(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", k: int = TOP,
                  shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item, rank, doc_id, score): the k highest-scoring documents of each item, ties by rising key."""
    spark = docs.sparkSession
    kind = items.schema[item].dataType
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    out = None
    for block in _blocks(items, item, item_text):
        terms = Terms([t for _, t in block])
        df, n, total = corpus_counts(docs, terms, text)
        found = stored(search_block(docs, terms, df, n, total, key=key, text=text, k=k,
                                    shard_postings=shard_postings), "found")
        # Tasks' lists are merged by groups of keys first, so an item's last merge is small.
        some = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*best_first)
        some = found.withColumn("r", F.row_number().over(some)).where(F.col("r") <= k).drop("r")
        last = Window.partitionBy("item").orderBy(*best_first)
        ranked = some.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)],
                                      f"item int, {item} {kind.simpleString()}")
        part = ranked.join(F.broadcast(names), "item").select(item, "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"{item} {kind.simpleString()}, rank int, doc_id long, score long")
    return out
