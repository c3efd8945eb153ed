"""SimHash near-dedup: fingerprints linked at 3 or fewer differing bits, by vantage-point trees.

1. A fingerprint bit is 1 if it is set in over half of the XXH64 values (seed
   42) of a text's 3-word shingles, repeats included. Equal fingerprints are
   one node, so a group of copies is one row from here on.
2. Of two fingerprints at 3 or fewer bits, one half differs in at most 1 bit.
   So there is one tree over each half: an inner node holds a vantage point,
   and its branches are the rings of equal Hamming distance to it. The tree's
   shape is fitted on a hashed sample of the nodes (at most ``SAMPLE`` expected,
   and never more than a quarter of them); every node is then routed, and the
   leaves are the shards.
3. By the triangle inequality a partner whose half is equal lies in the same
   ring, and one whose half differs in 1 bit in the ring just inside or just
   outside. Only these branches are followed, all others are pruned. Where a
   ring holds one half only, the node's vantage point and distance are those of
   the other half, where partners are at most 3 rings apart.
4. A node is compared in its own shard and visits the shards of a higher
   number that the bounds leave open, so each pair meets once. A shard of many
   nodes is searched by a tree of its own inside the task. Comparisons are of
   whole fingerprints and exact: no link is lost.
5. A shard returns a spanning forest of its links, at most one link a row,
   however dense a group is; classes are the connected components.

Rules: a null or blank text has the fingerprint 0, which links like any other.
Rows of one key are taken each on its own. ``component_id`` is the smallest
key of the component; null keys are passed over, and it is null if all are.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.llm.components import components
from mailcase.llm.tables import stored
from mailcase.llm.wordhash import LOWER, NON_SPACE, Words, pieces

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints a shard should hold, and the most a comparison takes without a tree.
LEAF = 512
#: Expected size of the sample that shapes the trees.
SAMPLE = 1 << 17
#: Shingles hashed at a time, and the rows one packed counter can add up.
BLOCK, LANES = 1 << 15, 255

_U = np.uint64
_HALVES = ((_U(0xFFFFFFFF00000000), _U(0x00000000FFFFFFFF)),
           (_U(0x00000000FFFFFFFF), _U(0xFFFFFFFF00000000)))
#: Byte -> its 8 bits as 8 one-byte counters.
_SPREAD = np.ascontiguousarray(
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)).view(_U).ravel()


# --- fingerprints -------------------------------------------------------------------------

def _shingle_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray,
                    first: int, last: int, width: int) -> np.ndarray:
    """Big-endian hash bytes, one row of 8 for each shingle that begins at words first..last-1."""
    digest = xxhash.xxh64_digest
    s, e = starts[first:last].tolist(), ends[first + width - 1:last + width - 1].tolist()
    found = [digest(raw[a:b], SEED) for a, b in zip(s, e)]
    joined = np.ones(last - first, dtype=bool)      # words one blank apart: the text's own bytes
    for j in range(width - 1):
        joined &= plain[first + j:last + j]
    for i in np.flatnonzero(~joined).tolist():
        words = [raw[starts[first + i + j]:ends[first + i + j]] for j in range(width)]
        found[i] = digest(b" ".join(words), SEED)
    return np.frombuffer(b"".join(found), dtype=np.uint8).reshape(-1, 8)


def _add_bits(counts: np.ndarray, doc: np.ndarray, hashes: np.ndarray) -> None:
    """Adds the bits of each hash to the 64 counts of its document (``doc`` is sorted)."""
    change = np.flatnonzero(np.diff(doc)) + 1
    cut = np.unique(np.concatenate([[0], change, np.arange(0, len(doc), LANES)]))
    lanes = np.add.reduceat(_SPREAD[hashes], cut, axis=0)        # at most 255 rows each
    np.add.at(counts, doc[cut], lanes.view(np.uint8).reshape(len(cut), 64))


def text_prints(col: pa.Array) -> np.ndarray:
    """64-bit fingerprint of each text of an Arrow column."""
    out = np.zeros(len(col), dtype=_U)
    for lo, hi, buf, off in pieces(col):
        base = int(off[0])
        raw = LOWER[buf[base:int(off[-1])]].tobytes()
        w = Words(buf, off, NON_SPACE)
        if not len(w.starts):
            continue
        starts, ends = w.starts - base, w.ends - base
        plain = np.zeros(len(starts), dtype=bool)
        plain[:-1] = (starts[1:] - ends[:-1] == 1) & (buf[w.ends[:-1]] == 0x20)
        n_words = w.counts
        counts = np.zeros((hi - lo, 64), dtype=np.int64)
        total = np.where(n_words < SHINGLE, n_words > 0, n_words - SHINGLE + 1)
        for short in range(1, SHINGLE):                          # the whole sequence
            for d in np.flatnonzero(n_words == short).tolist():
                k = int(w.first[d])
                _add_bits(counts, np.array([d]),
                          _shingle_hashes(raw, starts, ends, plain, k, k + 1, short))
        doc = w.doc_of()
        begin = np.flatnonzero(np.arange(len(doc)) + SHINGLE <= w.doc_end())
        # Shingles of neighbouring documents are hashed together, in runs of consecutive words.
        for i in range(0, len(begin), BLOCK):
            part = begin[i:i + BLOCK]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part) != 1) + 1, [len(part)]])
            hashed = [_shingle_hashes(raw, starts, ends, plain, int(part[a]), int(part[b - 1]) + 1, SHINGLE)
                      for a, b in zip(edges[:-1], edges[1:])]
            _add_bits(counts, doc[part], np.concatenate(hashed))
        bits = np.packbits(2 * counts > total[:, None], axis=1)
        out[lo:hi] = bits.view(">u8").ravel().astype(_U)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, ``fp`` as a signed long of the same bits."""
    def scan(batches):
        for b in batches:
            fp = text_prints(b.column(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(scan, "doc_id long, fp long")


# --- vantage-point trees ------------------------------------------------------------------

class Tree:
    """A vantage-point tree over fingerprints.

    Inner node i compares the bits of ``mask[i]`` with the vantage point
    ``point[i]``; ``child[i, d]`` is the branch of distance d, a leaf if
    negative (its number is ``~child``). ``spread[i]``: rings a partner may be
    apart there, 1 on the tree's own half, 3 on the other.
    """

    def __init__(self, sample: np.ndarray, half: int, leaf: int):
        own, other = _HALVES[half]
        points, masks, spreads, children = [], [], [], []
        self.leaves = 0
        todo = [(np.unique(sample), None, [])]
        while todo:
            part, parent, rings = todo.pop()
            chosen = None
            if len(part) > leaf:
                chosen = self._vantage(part, own, 1) or self._vantage(part, other, RADIUS)
            if chosen is None:
                at = ~self.leaves
                self.leaves += 1
            else:
                at = len(points)
                point, mask, spread, d = chosen
                points.append(point)
                masks.append(mask)
                spreads.append(spread)
                children.append(np.zeros(33, dtype=np.int32))
                present = np.unique(d)
                nearest = present[np.abs(present[None, :] - np.arange(33)[:, None]).argmin(axis=1)]
                for ring in present.tolist():                    # a distance no sample has: the nearest ring
                    todo.append((part[d == ring], at, np.flatnonzero(nearest == ring)))
            if parent is not None:
                children[parent][rings] = at
        self.point = np.array(points, dtype=_U)
        self.mask = np.array(masks, dtype=_U)
        self.spread = np.array(spreads, dtype=np.int64)
        self.child = np.array(children, dtype=np.int32).reshape(-1, 33)

    @staticmethod
    def _vantage(part: np.ndarray, mask: np.uint64, spread: int):
        """Of a few members, the one whose rings are the most even; None if all lie in one ring."""
        seen = part[np.linspace(0, len(part) - 1, min(len(part), 1024)).astype(int)] & mask
        best = None
        for c in np.linspace(0, len(part) - 1, min(len(part), 8)).astype(int).tolist():
            sizes = np.bincount(np.bitwise_count(seen ^ (part[c] & mask)), minlength=33)
            if best is None or (sizes ** 2).sum() < best[0]:
                best = ((sizes ** 2).sum(), c)
        point = part[best[1]]
        d = np.bitwise_count((part ^ point) & mask)
        return (point, mask, spread, d) if (d != d[0]).any() else None

    def _distance(self, fps: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.bitwise_count((fps ^ self.point[node]) & self.mask[node]).astype(np.int64)

    def home(self, fps: np.ndarray) -> np.ndarray:
        """The leaf of each fingerprint."""
        at = np.full(len(fps), 0 if len(self.point) else -1, dtype=np.int32)
        rows = np.flatnonzero(at >= 0)
        while len(rows):
            node = at[rows]
            at[rows] = self.child[node, self._distance(fps[rows], node)]
            rows = rows[at[rows] >= 0]
        return ~at

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that may hold a partner, the home leaf among them at most once.

        A visit is for partners with an equal half (state 0) or with one that
        differs in exactly 1 bit (state 1): then every distance to a vantage
        point on this half differs by exactly 1 too.
        """
        n = len(fps)
        if not len(self.point):
            return np.arange(n), np.zeros(n, dtype=np.int32)
        row, node = np.tile(np.arange(n), 2), np.zeros(2 * n, dtype=np.int32)
        state = np.repeat(np.array([0, 1], dtype=np.int8), n)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            d, spread = self._distance(fps[row], node), self.spread[node]
            step = [(row, self.child[node, d], state, (spread == 1) & (state == 0) | (spread > 1))]
            for k in (-3, -2, -1, 1, 2, 3):
                ring = d + k
                open_ = (ring >= 0) & (ring <= 32) & ((spread > 1) | (state == 1) & (abs(k) == 1))
                step.append((row, self.child[node, np.clip(ring, 0, 32)], state, open_))
            row, node, state = (np.concatenate([s[i][s[3]] for s in step]) for i in range(3))
            end = node < 0
            done.append((row[end], ~node[end]))
            row, node, state = row[~end], node[~end], state[~end]
            key = np.unique((row << 34) | (node.astype(np.int64) << 1) | state)   # merged rings: once
            row, node, state = key >> 34, ((key >> 1) & 0xFFFFFFFF).astype(np.int32), (key & 1).astype(np.int8)
        key = np.unique(np.concatenate([(r << 32) | leaf.astype(np.int64) for r, leaf in done]))
        return key >> 32, (key & 0xFFFFFFFF).astype(np.int32)


# --- comparison inside a shard ------------------------------------------------------------

def _near(x: np.ndarray, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (x, h) at ``RADIUS`` or fewer differing bits, in blocks of bounded size."""
    wide = 1 << 14
    for j in range(0, len(h), wide):
        part = h[j:j + wide]
        rows = max(1, (1 << 21) // len(part))
        for i in range(0, len(x), rows):
            a, b = np.nonzero(np.bitwise_count(x[i:i + rows, None] ^ part[None, :]) <= RADIUS)
            if len(a):
                yield a + i, b + j


def merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Unites the classes of u[i] and v[i]; ``label`` holds the smallest member of each class."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


class Shard:
    """The fingerprints at home in a shard, and the forest of the links found there."""

    def __init__(self, homes: np.ndarray, half: int, leaf: int = LEAF):
        self.homes = np.sort(homes)
        self.label = np.arange(len(homes))
        self.tree, self.members = None, None
        if len(homes) > 2 * leaf:
            self.tree = Tree(self.homes[::max(1, len(homes) >> 14)], half, leaf // 2)
            own = self.tree.home(self.homes)
            order = np.argsort(own, kind="stable")
            self.members = np.split(order, np.searchsorted(own[order], np.arange(1, self.tree.leaves)))

    def _pairs(self, x: np.ndarray):
        if self.tree is None:
            yield from _near(x, self.homes)
            return
        row, leaf = self.tree.visits(x)
        order = np.argsort(leaf, kind="stable")
        row, leaf = row[order], leaf[order]
        for k in np.unique(leaf).tolist():
            at = self.members[k]
            mine = row[np.searchsorted(leaf, k):np.searchsorted(leaf, k, "right")]
            for a, b in _near(x[mine], self.homes[at]):
                yield mine[a], at[b]

    def within(self) -> tuple[np.ndarray, np.ndarray]:
        """Forest links among the shard's own fingerprints."""
        for a, b in self._pairs(self.homes):
            apart = self.label[a] != self.label[b]
            merge(self.label, a[apart], b[apart])
        u = np.flatnonzero(self.label != np.arange(len(self.homes)))
        return self.homes[u], self.homes[self.label[u]]

    def visit(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forest links that the visitors ``x`` add."""
        n = len(self.homes)
        everyone = np.concatenate([self.homes, x])
        label = np.concatenate([self.label, np.arange(n, n + len(x))])
        before = label.copy()
        for a, b in self._pairs(x):
            apart = label[a + n] != label[b]
            merge(label, a[apart] + n, b[apart])
        # A class changes hands once, at its old head.
        u = np.flatnonzero((label != before) & (before == np.arange(len(before))))
        self.label = label[:n]
        return everyone[u], everyone[label[u]]


def _routes(trees: list[Tree]):
    def route(batches):
        for b in batches:
            fps = b.column(0).to_numpy().view(_U)
            for i in range(0, len(fps), 4096):
                part = fps[i:i + 4096]
                for half, tree in enumerate(trees):
                    own = tree.home(part)
                    row, leaf = tree.visits(part)
                    up = leaf > own[row]
                    row, leaf = row[up], leaf[up]
                    n, m = len(part), len(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n + m, half, dtype=np.int32)),
                         pa.array(np.concatenate([own, leaf]).astype(np.int32)),
                         pa.array(np.concatenate([np.zeros(n, dtype=np.int32), np.ones(m, dtype=np.int32)])),
                         pa.array(np.concatenate([part, part[row]]).view(np.int64))],
                        ["half", "leaf", "visitor", "fp"])
    return route


def _search(leaf_size: int):
    """Links of each shard; a shard's own rows come first, then its visitors in batches."""
    def links(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def search(batches):
        at, shard, homes = None, None, []
        for b in batches:
            half, leaf, visitor, fp = (b.column(i).to_numpy() for i in range(4))
            fp = fp.view(_U)
            key = (half.astype(np.int64) << 33) | (leaf.astype(np.int64) << 1) | visitor
            edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if i == j:
                    continue
                if (half[i], leaf[i]) != at:
                    if homes:
                        yield links(*Shard(np.concatenate(homes), at[0], leaf_size).within())
                    at, shard, homes = (half[i], leaf[i]), None, []
                if not visitor[i]:
                    homes.append(fp[i:j])
                    continue
                if shard is None and homes:
                    shard, homes = Shard(np.concatenate(homes), at[0], leaf_size), []
                    yield links(*shard.within())
                if shard is not None:
                    for k in range(i, j, 1 << 14):
                        yield links(*shard.visit(fp[k:min(j, k + (1 << 14))]))
        if homes:
            yield links(*Shard(np.concatenate(homes), at[0], leaf_size).within())

    return search


def near_links(nodes: DataFrame, n: int, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(u, v): links that connect exactly the distinct fingerprints ``nodes.fp`` at 3 or fewer bits.

    ``n``: their number. Of each dense group a spanning forest is returned.
    """
    share = max(4, -(-n // sample))
    taken = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).select("fp").toArrow()
    shape = taken.column("fp").to_numpy().view(_U)
    trees = [Tree(shape, half, max(8, leaf // share)) for half in (0, 1)]
    routed = nodes.select("fp").mapInArrow(_routes(trees), "half int, leaf int, visitor int, fp long")
    dealt = routed.repartition("half", "leaf").sortWithinPartitions("half", "leaf", "visitor")
    return dealt.mapInArrow(_search(leaf), "u long, v long")


def simhash_dedup(docs: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``."""
    prints = stored(fingerprints(docs), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(near_links(nodes, nodes.count(), leaf, sample))
    linked = stored(labels.join(nodes, labels["node"] == nodes["fp"]).select("fp", "label", "least"), "linked")
    heads = linked.groupBy("label").agg(F.min("least").alias("head"))
    of = linked.join(heads, "label").select(F.col("fp").alias("_fp"), "head")
    ids = nodes.join(of, nodes["fp"] == of["_fp"], "left").select(
        F.col("fp").alias("_node"), F.when(F.col("_fp").isNotNull(), F.col("head")).otherwise(
            F.col("least")).alias("component_id"))
    return prints.join(ids, prints["fp"] == ids["_node"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
