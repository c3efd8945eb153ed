"""MinHash near-dedup: consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of 5-word shingles are counted over all documents in
   a hashed table of fixed size; a shingle's weight is tf * idf.
2. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples of
   each document; two documents share a sample with probability equal to the
   weighted Jaccard similarity of their shingles. As many min-hashes share with
   probability equal to the plain one. ``ROWS`` samples of a kind make a band.
3. Documents with the same word sequence are copies; one node, named by their
   smallest key and the 128-bit hash of the words, stands for all of them. Nodes that share a band are candidates.
4. First each band bucket's nodes are compared with its hub, the node that
   shares most bands with others (of edited copies, mostly the original).
   Then, in buckets that still hold several components, the nodes outside the
   largest component there are compared with the nodes of other components.
   Members of one component are never paired again, and a pair is made once,
   in the first band it shares, if the prefixes of both
   have a shingle in common: with shingles ordered by rarity, the first ones
   that hold a fifth of a text's weight or number, which similar texts can't all
   differ in; and the weight or number outside the shingles that only one text has
   must allow 0.8. A copy with many edits of its own passes neither, so a large group of
   copies costs a few comparisons a node.
5. A comparison is exact: the weighted or the plain Jaccard similarity of both
   shingle sets must reach 0.8. Weights alone would part copies with edits of
   their own in a large group, whose shared shingles weigh little, and the more
   so the larger the table is.
6. Classes are the connected components of the verified links.

A pair of either similarity 0.8 shares a band of 4 out of that kind's 15 with probability
1 - (1 - 0.8 ** 4) ** 15 = 0.9999985. No pair that shares a band is dropped by
chance: the bounds before a comparison are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.llm.components import components
from mailcase.llm.tables import TAG, same, stored, summed_table, text_tag
from mailcase.llm.wordhash import ALNUM, LOWER, Words, gram_hashes, mix, pieces, range_hashes, signed

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 15, 4
#: Entries of the hashed document-frequency table.
BUCKETS = 1 << 18
SEED = 11
#: Entries of the table that orders shingles by rarity among open candidates. Any
#: order gives the same links; a fuller table only prunes less.
RARITY = 1 << 20
#: Bytes of text whose shingles a task holds at a time; each document's are its own.
_PIECE = 1 << 18
#: Shingles compared at a time by a verifying task.
_BLOCK = 1 << 19
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _gamma2(levels: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, by bisection."""
    p = (np.arange(levels) + 0.5) / levels
    lo, hi = np.zeros(levels), np.full(levels, 60.0)
    for _ in range(80):
        mid = (lo + hi) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return lo


class _Tables:
    """Random variables of the sampling by hash bits: r, 1/r, ln c and beta."""

    def __init__(self):
        self.r = _gamma2(1 << 12).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.ln_c = np.log(_gamma2(1 << 16)).astype(np.float32)
        self.beta = ((np.arange(1 << 12) + 0.5) / (1 << 12)).astype(np.float32)


def _shingles(words: Words, n: int):
    """(document, shingle hash, tf) of the distinct shingles of each document, sorted.

    A document of fewer than ``n`` words, but not none, has one shingle.
    """
    h, end = words.hashes(LOWER), words.doc_end()
    x = gram_hashes(h, n)
    at = np.flatnonzero(np.arange(len(x)) + n <= end[:len(x)])
    x, doc = x[at], words.doc_of()[at]
    few = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(few):
        short = range_hashes(h, words.first[few], words.first[few + 1])
        x, doc = np.concatenate((x, short)), np.concatenate((doc, few))
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    if not len(x):
        return doc, x, x.astype(np.int64), h
    first = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (doc[1:] != doc[:-1]))))
    return doc[first], x[first], np.diff(np.append(first, len(x))), h


def _count(n: int):
    """Documents by shingle bucket; the last entry counts the documents."""
    def run(batches, table):
        for b in batches:
            for i, j, buf, off in pieces(b.column(0), _PIECE):
                doc, x, _, _ = _shingles(Words(buf, off, ALNUM), n)
                cell = np.unique(doc * BUCKETS + (x % np.uint64(BUCKETS)).astype(np.int64))
                table[:-1] += np.bincount(cell % BUCKETS, minlength=BUCKETS)
                table[-1] += j - i
    return run


def shingle_idf(docs: DataFrame, text: str = "text", n: int = SHINGLE) -> np.ndarray:
    """1 + ln((1 + documents) / (1 + documents in the bucket)) by bucket, over all documents."""
    t = summed_table(docs.select(text), BUCKETS + 1, _count(n))
    return (1 + np.log((1 + t[-1]) / (1 + np.minimum(t[:-1], t[-1])))).astype(np.float32)


def _samples(doc, x, weight, k: int, seed: int, tables: _Tables):
    """``k`` consistent weighted samples (hashes) of each document in sorted ``doc``."""
    start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    size = np.diff(np.append(start, len(doc)))
    local = np.repeat(np.arange(len(start)), size)
    ln_w = np.log(weight).astype(np.float32)
    odd = mix(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)
    out = np.empty((len(start), k), dtype=np.uint64)
    for j in range(k):
        y = x * odd[j]
        y ^= y >> np.uint64(29)
        y *= _C2
        ri = (y >> np.uint64(52)).astype(np.int32)
        ci = ((y >> np.uint64(36)) & np.uint64(0xFFFF)).astype(np.int32)
        bi = ((y >> np.uint64(24)) & np.uint64(0xFFF)).astype(np.int32)
        r, beta = tables.r[ri], tables.beta[bi]
        t = np.floor(ln_w * tables.inverse[ri] + beta)
        a = tables.ln_c[ci] - r * (t - beta + 1)
        least = np.minimum.reduceat(a, start)
        p = np.flatnonzero(a == least[local])
        p = p[np.searchsorted(local[p], np.arange(len(start)))]
        out[:, j] = mix(x[p] ^ mix(t[p].astype(np.int64).view(np.uint64) + odd[j]))
    return start, out


def _minima(start, x, k: int, seed: int) -> np.ndarray:
    """``k`` min-hashes of each document, whose shingles begin at ``start``."""
    odd = mix(np.arange(1, k + 1, dtype=np.uint64) + np.uint64((seed + 1) << 20)) | np.uint64(1)
    out = np.empty((len(start), k), dtype=np.uint64)
    for j in range(k):
        y = x * odd[j]
        y ^= y >> np.uint64(29)
        y *= _C2
        out[:, j] = np.minimum.reduceat(y, start)
    return out


def _sign(idf, n: int, bands: int, rows: int, seed: int):
    def run(batches):
        tables = _Tables()
        table = idf.value
        for b in batches:
            for i, j, buf, off in pieces(b.column("text"), _PIECE):
                w = Words(buf, off, ALNUM)
                doc, x, tf, h = _shingles(w, n)
                if not len(x):
                    continue
                weight = tf * table[(x % np.uint64(BUCKETS)).astype(np.int64)]
                start, s = _samples(doc, x, weight, bands * rows, seed, tables)
                s = np.concatenate((s, _minima(start, x, bands * rows, seed)), axis=1)
                band = np.zeros((len(start), 2 * bands), dtype=np.uint64)
                for r in range(rows):
                    band = mix(band * _C2 + s[:, r::rows])
                d = doc[start]
                whole, again = _whole(w, h, d)
                yield pa.RecordBatch.from_pydict({
                    "doc": b.column("doc").take(pa.array(d + i)),
                    "tag": b.column("tag").take(pa.array(d + i)),
                    "d1": pa.array(whole), "d2": pa.array(again),
                    "bands": pa.FixedSizeListArray.from_arrays(
                        pa.array(signed(band.ravel())), 2 * bands).cast(pa.list_(pa.int64()))})
    return run


def _whole(w: Words, h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of the word sequence of each document in ``d``, as two signed columns."""
    whole = range_hashes(h, w.first[d], w.first[d + 1])
    again = range_hashes(mix(h + np.uint64(3)), w.first[d], w.first[d + 1])
    return signed(whole), signed(again)


def _vectors(n: int):
    """Shingles of each node's text as sorted 32-bit hashes, repeated as often as they occur.

    Texts that are not the node's are left out.
    """
    def run(batches):
        for b in batches:
            for i, j, buf, off in pieces(b.column("text"), _PIECE):
                w = Words(buf, off, ALNUM)
                doc, x, tf, h = _shingles(w, n)
                if not len(x):
                    continue
                s32 = np.repeat((x & np.uint64(0xFFFFFFFF)).astype(np.uint32), tf).view(np.int32)
                start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                size = np.concatenate(([0], np.cumsum(tf)))
                d = doc[start]
                node = b.column("node").take(pa.array(d + i))
                whole, again = _whole(w, h, d)
                own = np.flatnonzero((node.field("d1").to_numpy() == whole)
                                     & (node.field("d2").to_numpy() == again))
                sh = pa.ListArray.from_arrays(
                    pa.array(np.append(size[start], size[-1]).astype(np.int32)), pa.array(s32))
                yield pa.RecordBatch.from_pydict({"node": node.take(pa.array(own)),
                                                  "sh": sh.take(pa.array(own))})
    return run


def _rarity(batches, table):
    """Occurrences of shingles (hashed) in texts."""
    for b in batches:
        sh = b.column(0).flatten().to_numpy().view(np.uint32)
        for lo in range(0, len(sh), _BLOCK):
            table += np.bincount(sh[lo:lo + _BLOCK] % RARITY, minlength=RARITY)


def _prefix(idf, rarity, threshold: float):
    """(node, weight, common, size, shared, plain, heavy, before): a text's weight and number of
    shingles, both of the shingles which other texts may have, and the rarest shingles that
    hold 1 - threshold of the number (``plain``) and of the weight (``heavy``, with the weight
    of the shingles ``before`` each), rarest first."""
    def run(batches):
        for b in batches:
            weight, common, size, shared = [], [], [], []
            plain, heavy, ahead = [], [], []
            for row in b.column("sh"):
                sh, tf = np.unique(row.values.to_numpy().view(np.uint32), return_counts=True)
                w = tf * idf.value[sh % BUCKETS].astype(float)
                count = rarity.value[sh % RARITY]
                weight.append(float(w.sum()))
                common.append(float(w[count > tf].sum()))
                size.append(len(sh))
                shared.append(int((count > tf).sum()))
                order = np.lexsort((sh, count))
                before = np.cumsum(w[order]) - w[order]
                # A little more than needed, for rounding.
                part = 1 - threshold + 1e-6
                plain.append(sh[order][np.arange(len(sh)) <= part * len(sh)].view(np.int32))
                held = before <= part * w.sum()
                heavy.append(sh[order][held].view(np.int32))
                ahead.append(before[held])
            yield pa.RecordBatch.from_pydict({
                "node": b.column("node"), "weight": weight, "common": common, "size": size,
                "shared": shared, "plain": pa.array(plain, pa.list_(pa.int32())),
                "heavy": pa.array(heavy, pa.list_(pa.int32())),
                "before": pa.array(ahead, pa.list_(pa.float64()))})
    return run


def _verify(idf, threshold: float):
    """Keeps the pairs whose weighted or plain Jaccard similarity reaches the threshold."""
    def similar(pa_, pb_, n):
        sides = []
        for col in (pa_, pb_):
            o = col.offsets.to_numpy()
            sh = col.flatten().to_numpy().view(np.uint32).astype(np.uint64)
            pair = np.repeat(np.arange(n, dtype=np.uint64), np.diff(o))
            sides.append(np.unique((pair << np.uint64(32)) | sh, return_counts=True))
        (ka, ta), (kb, tb) = sides
        w = lambda k: idf.value[(k % np.uint64(BUCKETS)).astype(np.int64)].astype(float)
        of = lambda k: (k >> np.uint64(32)).astype(np.int64)
        total = np.bincount(of(ka), ta * w(ka), n) + np.bincount(of(kb), tb * w(kb), n)
        both, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
        common = np.bincount(of(both), np.minimum(ta[ia], tb[ib]) * w(both), n)
        size = np.bincount(of(ka), minlength=n) + np.bincount(of(kb), minlength=n)
        shared = np.bincount(of(both), minlength=n)
        return ((common / np.maximum(total - common, 1e-12) >= threshold)
                | (shared / np.maximum(size - shared, 1) >= threshold))

    def run(batches):
        for b in batches:
            a, z = b.column("a"), b.column("z")
            size = np.cumsum(np.diff(a.offsets.to_numpy()) + np.diff(z.offsets.to_numpy()))
            lo = 0
            while lo < len(b):
                base = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, base + _BLOCK, "right")))
                ok = similar(a.slice(lo, hi - lo), z.slice(lo, hi - lo), hi - lo)
                rows = pa.array(np.flatnonzero(ok) + lo)
                yield pa.RecordBatch.from_pydict({"u": b.column("u").take(rows),
                                                  "v": b.column("v").take(rows)})
                lo = hi
    return run


def _keyless(h: Column, kind: str) -> Column:
    """A key for texts that have null keys only, larger than any usual key."""
    low = h.bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    return low if kind == "long" else F.concat(F.lit("\uffff"), low.cast("string"))


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", *, n: int = SHINGLE,
               threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
               seed: int = SEED) -> DataFrame:
    """(key, text_hash, text_id, class_key, kept) of every row: rows of a class share the
    class key, its smallest key. One text with that key is kept in each class, and
    all rows that repeat it and the key.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased. Texts with the same words are copies whatever their length.
    A null, empty or wordless text is near nothing and is its own class. Rows
    that share a key but not the words may fall into different classes, which have
    equal class keys if that key is the smallest in each; a null key counts as larger than any other, and a class of null keys only has as
    its class key a hash (above 2**62, or after U+FFFF), and one text kept.
    Keys are integers (taken as long) or strings. An empty table gives an
    empty result; columns other than key and text are not read.
    """
    sc = docs.sparkSession.sparkContext
    kind = docs.schema[key].dataType.simpleString()
    kind = "long" if kind in ("tinyint", "smallint", "int", "bigint") else kind
    if kind not in ("long", "string"):
        raise TypeError(f"keys are integers or strings, not {kind}")
    name = f"struct<k:{kind},d1:bigint,d2:bigint>"
    src = docs.select(F.col(key).cast(kind).alias("doc"), F.col(text).alias("text"))
    src = src.select("doc", text_tag("text").alias("tag"), "text")
    idf = sc.broadcast(shingle_idf(src, "text", n))
    signed_rows = stored(src.mapInArrow(_sign(idf, n, bands, rows, seed),
                                        f"doc {kind}, tag {TAG}, d1 long, d2 long, bands array<long>"),
                         "signatures")
    # One node for each distinct word sequence.
    at = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "tag")).alias("at")
    nodes = signed_rows.groupBy("d1", "d2").agg(at, F.first("bands").alias("bands"))
    nodes = stored(nodes.select(
        F.struct(F.coalesce("at.doc", _keyless(F.col("d1"), kind)).alias("k"), "d1", "d2").alias("node"),
        "at", "bands"), "nodes")
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    sizes = stored(buckets.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), "buckets")
    shared = stored(buckets.join(sizes, ["band", "h"]), "shared")
    ties = shared.groupBy("node").agg(F.sum("n").alias("ties"))
    hubs = shared.join(ties, "node").groupBy("band", "h").agg(
        F.max_by("node", F.struct("ties", "node")).alias("hub"))
    hubs = stored(hubs, "hubs")
    # The text of one row of each candidate.
    need = stored(nodes.join(shared.select("node").distinct(), "node", "left_semi")
                  .select("node", "at.doc", "at.tag"), "candidates")
    need = need.hint("merge")              # the same plan at every size
    texts = src.join(need, same(src, need, ["doc", "tag"])).select("node", "text")
    vectors = texts.mapInArrow(_vectors(n), f"node {name}, sh array<int>")
    vectors = stored(vectors.dropDuplicates(["node"]), "vectors")

    def links(pairs: DataFrame) -> DataFrame:
        p = pairs.join(vectors.select(F.col("node").alias("v"), F.col("sh").alias("z")), "v")
        p = p.join(vectors.select(F.col("node").alias("u"), F.col("sh").alias("a")), "u")
        return stored(p.select("u", "v", "a", "z").mapInArrow(
            _verify(idf, threshold), f"u {name}, v {name}"), "verified")

    first = shared.join(hubs, ["band", "h"]).where("node != hub")
    first = stored(first.select(F.least("hub", "node").alias("u"), F.greatest("hub", "node").alias("v"))
                   .distinct(), "pairs")
    found = links(first)
    labels = components(found)

    # Buckets with several components: every node outside the largest one there.
    own = shared.join(labels, "node", "left").select(
        "band", "h", "node", F.coalesce("label", "node").alias("label"))
    per = own.groupBy("band", "h", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = per.groupBy("band", "h").agg(
        F.max_by("label", F.struct("n", "label")).alias("largest"),
        F.count(F.lit(1)).alias("parts")).where("parts > 1").select("band", "h", "largest")
    mixed = stored(own.join(largest, ["band", "h"]), "open")
    open_ = vectors.join(mixed.select("node").distinct(), "node", "left_semi")
    rarity = sc.broadcast(summed_table(open_.select("sh"), RARITY, _rarity).astype(np.int32))
    prefixes = open_.mapInArrow(_prefix(idf, rarity, threshold), f"node {name}, weight double, "
                                 "common double, size long, shared long, plain array<int>, "
                                 "heavy array<int>, before array<double>")
    mixed = stored(mixed.join(nodes.select("node", "bands"), "node").join(prefixes, "node"),
                   "mixed")
    x, y = mixed.where("label != largest").alias("x"), mixed.alias("y")
    once = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) == F.col("x.band") + 1
    # Overlap / (sum of weights - overlap) >= threshold, with a little room for rounding.
    part = threshold / (1 + threshold)
    weight, size = part * (F.col("x.weight") + F.col("y.weight")), part * (F.col("x.size") + F.col("y.size"))
    room_w = F.least("x.common", "y.common") * (1 + 1e-6) >= weight
    room_p = F.least("x.shared", "y.shared") * (1 + 1e-6) >= size

    # The first shingle both have, in the order of rarity, is followed by all the others: in each text
    # it lies so far ahead that the overlap these two texts need still fits behind it.
    def ahead(side):
        n = F.col(f"{side}.size") - F.ceil(size * (1 - 1e-6)) + 1
        return F.slice(f"{side}.plain", 1, F.greatest(n, F.lit(0)).cast("int"))

    def light(side):
        most = F.col(f"{side}.weight") * (1 + 1e-6) - weight * (1 - 1e-6)
        n = F.size(F.filter(f"{side}.before", lambda c: c <= most))
        return F.slice(f"{side}.heavy", 1, n)

    near = (room_p & F.arrays_overlap(ahead("x"), ahead("y"))) | (room_w & F.arrays_overlap(light("x"), light("y")))
    pairs = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h"))
                   & (F.col("x.label") != F.col("y.label"))
                   & ((F.col("y.label") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node")))
                   & (room_w | room_p) & once & near)
    pairs = pairs.select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v"))
    more = links(pairs.distinct().join(first, ["u", "v"], "left_anti"))
    if not more.isEmpty():
        labels = components(found.union(more))

    member = signed_rows.select("doc", "tag", "d1", "d2").join(
        nodes.select("node.d1", "node.d2", "node", "at"), ["d1", "d2"]).join(labels, "node", "left")
    label = F.coalesce("label", "node")
    kept = ((label == F.col("node")) & F.col("doc").eqNullSafe(F.col("at.doc"))
            & (F.col("tag") == F.col("at.tag")))
    member = member.select("doc", "tag", label["k"].alias("class"), kept.alias("kept"))
    wordless = src.where(~F.coalesce(F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"), F.lit(False)))
    alone = wordless.select("doc", "tag", F.col("doc").alias("class"), F.lit(True).alias("kept"))
    return member.unionByName(alone).select(
        F.col("doc").alias(key), F.col("tag.h").alias("text_hash"), F.col("tag.id").alias("text_id"),
        F.col("class").alias("class_" + key.removeprefix("doc_")), "kept")
