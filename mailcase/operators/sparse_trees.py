"""Boosting rounds over sparse rows: histograms of stored entries only (M4, M5).

MLlib bins every row densely, 4 bytes a feature, and visits each of them in
each level of each tree. Here the binned rows keep their stored entries, by
feature, in blocks; a level of a tree is one job that sums the histograms of
the blocks, and the zeros of a feature are what its entries leave of the
node's total. Candidate splits, gains and leaves are those of MLlib's variance
trees, so a round without sampling is the one MLlib would fit; row and feature
samples are drawn by block and node from the seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.operators.features import vector_entries
from mailcase.session import written

#: Bins of a feature, rows that shape them (as MLlib samples), and stored entries of a block.
MAX_BINS = 32
SHAPING = 10_000
BLOCK_ENTRIES = 1 << 20
#: Rounds after which the margins are summed up and held.
HELD = 10


@dataclass
class Tree:
    """A tree as a heap (children of k: 2k+1, 2k+2): split feature (-1: leaf) and last
    bin to the left, and per node (weight, sum, sum of squares) and the gain."""
    depth: int
    feature: np.ndarray = field(init=False)
    last: np.ndarray = field(init=False)
    stats: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.feature, self.last = np.full(n, -1), np.zeros(n, dtype=np.int64)
        self.stats, self.gain = np.zeros((n, 3)), np.zeros(n)

    @property
    def values(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1.0)


def cut_points(values: np.ndarray, n_samples: float, max_bins: int = MAX_BINS) -> list[float]:
    """Candidate thresholds of a feature as MLlib finds them, from its sampled non-zero values."""
    v, c = np.unique(values, return_counts=True)
    c = c.astype(float)
    zeros = n_samples - c.sum()
    if zeros > 2.0 ** -52 * len(values) ** 2:
        at = np.searchsorted(v, 0.0)
        v, c = np.insert(v, at, 0.0), np.insert(c, at, zeros)
    middle = (v[:-1] + v[1:]) / 2.0
    if len(middle) <= max_bins - 1:
        return middle.tolist()
    stride, found = n_samples / max_bins, []
    target, seen = stride, np.cumsum(c)
    for i in range(1, len(v)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            found.append(float(middle[i - 1]))
            target += stride
    return found


def thresholds(rows: DataFrame, n_features: int, seed: int) -> list[np.ndarray]:
    """Candidate thresholds of every feature, from at most about ``SHAPING`` rows."""
    n = rows.count()
    share = min(1.0, max(MAX_BINS ** 2, SHAPING) / max(n, 1))
    shaping = rows if share == 1.0 else rows.sample(False, share, seed)
    bins, samples = min(MAX_BINS, max(n, 1)), share * n

    def cuts(key, values):
        return pd.DataFrame({"i": [key[0]], "cuts": [cut_points(values["x"].to_numpy(), samples, bins)]})

    entries = shaping.select(F.inline(vector_entries("features")))
    found = {r["i"]: r["cuts"] for r in entries.groupBy("i").applyInPandas(
        cuts, "i int, cuts array<double>").collect()}
    return [np.array(found.get(i, []), dtype=float) for i in range(n_features)]


def _packed(entries: int, n: int) -> int:
    return max(1, int(n * BLOCK_ENTRIES / max(entries, 1)))


def blocks(rows: DataFrame, cuts: Sequence[np.ndarray]) -> RDD:
    """Binned rows (features, _y, _eval, _m) as blocks of entries ordered by feature.

    A block: its number, labels, evaluation flags, margins, where the entries of each
    feature begin, and row and bin of every entry. Written once, so that numbers stay.
    """
    n_features = len(cuts)
    sent = rows.sparkSession.sparkContext.broadcast(list(cuts))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            step = _packed(len(batch.column("i").flatten()), len(batch))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                own = part.column("i")
                size = np.diff(own.offsets.to_numpy())
                feature, x = own.flatten().to_numpy(), part.column("x").flatten().to_numpy()
                row = np.repeat(np.arange(len(part), dtype=np.int32), size)
                order = np.argsort(feature, kind="stable")
                feature, x, row = feature[order], x[order], row[order]
                begin = np.searchsorted(feature, np.arange(n_features + 1)).astype(np.int64)
                bins = np.zeros(len(x), dtype=np.uint8)
                for f in np.unique(feature):
                    held = slice(begin[f], begin[f + 1])
                    bins[held] = np.searchsorted(sent.value[f], x[held])
                numbers = [part.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (
                    ("_y", np.float64), ("_eval", np.bool_), ("_m", np.float64))]
                packed = [a.tobytes() for a in (*numbers, begin, row, bins)]
                yield pa.RecordBatch.from_pydict({"id": [task << 32 | made], **{
                    f"b{k}": [b] for k, b in enumerate(packed)}})
                made += 1

    e = rows.select(vector_entries("features").alias("e"), "_y", "_eval", "_m")
    flat = e.select(F.col("e.i").alias("i"), F.col("e.x").alias("x"), "_y", "_eval", "_m")
    kept = written(flat.mapInArrow(pack, "id long, " + ", ".join(f"b{k} binary" for k in range(6))), "blocks")
    kinds = (np.float64, np.bool_, np.float64, np.int64, np.int32, np.uint8)
    return kept.rdd.map(lambda r: (r[0], *(np.frombuffer(bytes(b), t) for b, t in zip(r[1:], kinds))))


def leaf_of(tree: Tree, zero: np.ndarray, begin: np.ndarray, row: np.ndarray, bins: np.ndarray, n: int) -> np.ndarray:
    """The node of the tree (so far) that each row of a block ends in."""
    at = np.zeros(n, dtype=np.int64)
    for k in np.flatnonzero(tree.feature >= 0):
        f, last = tree.feature[k], tree.last[k]
        right = np.full(n, zero[f] > last)
        held = slice(begin[f], begin[f + 1])
        right[row[held]] = bins[held] > last
        here = at == k
        at[here] = 2 * k + 1 + right[here]
    return at


def best_split(sums: np.ndarray, total: np.ndarray, cuts: Sequence[np.ndarray], zero: np.ndarray,
               allowed: np.ndarray) -> tuple[float, int, int, np.ndarray]:
    """(gain, feature, last bin to the left, stats to the left) of the best split of a node.

    ``sums``: (feature, bin, 3) of the stored entries; the zeros are what the total leaves.
    """
    whole = sums.copy()
    whole[np.arange(len(zero)), zero] += total - sums.sum(axis=1)
    left = np.cumsum(whole, axis=1)[:, :-1]
    right = total - left
    n_l, n_r = np.round(left[..., 0]), np.round(right[..., 0])
    ok = (n_l >= 1) & (n_r >= 1) & (np.arange(left.shape[1]) < np.array([len(c) for c in cuts])[:, None])
    ok &= allowed[:, None]
    gain = left[..., 1] ** 2 / np.maximum(n_l, 1) + right[..., 1] ** 2 / np.maximum(n_r, 1)
    gain = np.where(ok, (gain - total[1] ** 2 / total[0]) / total[0], -math.inf)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    return float(gain[f, b]), int(f), int(b), left[f, b]


def _subset(strategy: str, n: int) -> int:
    if strategy in ("all", "auto"):
        return n
    return max(1, min(n, math.ceil(float(strategy) * n)))


class Rounds:
    """Boosting rounds over blocks: ``losses`` after each, ``trees`` in order."""

    def __init__(self, rows: DataFrame, n_features: int, *, params: dict, offset: int = 0):
        # ``offset``: rounds of the ensemble that the margins of the rows come from.
        self.params, self.n_features, self.offset = params, n_features, offset
        self.cuts = thresholds(rows.where(~F.col("_eval")), n_features, params["seed"])
        self.zero = np.array([np.searchsorted(c, 0.0) for c in self.cuts], dtype=np.int64)
        # Where the bins of each feature begin in a histogram; most have few.
        self.cells = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])]).astype(np.int64)
        self.base = blocks(rows, self.cuts)
        self.held = self.base.persist(StorageLevel.MEMORY_AND_DISK)
        self.trees: list[tuple[Tree, float]] = []
        self.pending: list[tuple[Tree, float]] = []

    def _level(self, tree: Tree, nodes: Sequence[int], number: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """((loss sum, evaluation rows), (node, feature, bin, 3) sums and node totals as one array)."""
        zero, pending, share, seed = self.zero, self.pending, self.params["subsamplingRate"], self.params["seed"]
        n_features, n_nodes, first_cell, width = self.n_features, len(nodes), self.cells[:-1], int(self.cells[-1])
        place = np.full(len(tree.feature), -1, dtype=np.int64)
        place[list(nodes)] = np.arange(n_nodes)

        def sums(part):
            acc = None
            for id_, y, ev, m, begin, row, bins in part:
                n = len(y)
                m = m + sum((w * t.values[leaf_of(t, zero, begin, row, bins, n)] for t, w in pending), np.zeros(n))
                if acc is None:
                    acc = np.zeros(2 + n_nodes * 3 * (width + 1))
                z = -2.0 * y[ev] * m[ev]
                acc[:2] += 2.0 * np.logaddexp(0.0, z).sum(), len(z)
                node = place[leaf_of(tree, zero, begin, row, bins, n)]
                drawn = np.random.default_rng([seed, number, id_]).random(n) < share if share < 1.0 else True
                node = np.where(ev | ~np.broadcast_to(drawn, n), -1, node)
                target = y if first else 4.0 * y / (1.0 + np.exp(2.0 * y * m))
                cell = np.repeat(first_cell, np.diff(begin)) + bins
                of = node[row]
                kept = of >= 0
                cell, rows_in = (of * width + cell)[kept], row[kept]
                size = n_nodes * width
                inside = node >= 0
                for k, w in enumerate((None, target, target * target)):
                    at = 2 + k * size
                    acc[at:at + size] += np.bincount(cell, None if w is None else w[rows_in], size)
                    at = 2 + 3 * size + k * n_nodes
                    acc[at:at + n_nodes] += np.bincount(node[inside], None if w is None else w[inside], n_nodes)
            if acc is not None:
                yield acc

        got = self.held.mapPartitions(sums).treeReduce(np.add)
        size = n_nodes * width
        cells = np.zeros((n_nodes, n_features, MAX_BINS, 3))
        of = np.repeat(np.arange(n_features), np.diff(self.cells))
        cells[:, of, np.arange(width) - first_cell[of]] = np.moveaxis(got[2:2 + 3 * size].reshape(3, n_nodes, width), 0, -1)
        return got[:2], (cells, got[2 + 3 * size:].reshape(3, n_nodes).T)

    def next(self) -> float | None:
        """Fits one more tree; returns the evaluation loss before it (None: no evaluation rows)."""
        params, number, first = self.params, self.offset + len(self.trees), self.offset + len(self.trees) == 0
        tree, nodes, loss = Tree(params["maxDepth"]), [0], None
        for level in range(params["maxDepth"]):
            (lost, n), (cells, totals) = self._level(tree, nodes, number, first)
            if level == 0:
                loss, tree.stats[0] = (float(lost / n) if n else None), totals[0]
            after = []
            for k, total, sums in zip(nodes, totals, cells):
                allowed = np.zeros(self.n_features, dtype=bool)
                own = _subset(params["featureSubsetStrategy"], self.n_features)
                allowed[np.random.default_rng([params["seed"], number, k]).choice(
                    self.n_features, own, replace=False)] = True
                if total[0] < 2:
                    continue
                gain, f, b, left = best_split(sums, total, self.cuts, self.zero, allowed)
                if not gain > 1e-15:
                    continue
                tree.feature[k], tree.last[k], tree.gain[k] = f, b, gain
                tree.stats[2 * k + 1], tree.stats[2 * k + 2] = left, total - left
                after += [2 * k + 1, 2 * k + 2]
            nodes = after
            if not nodes:
                break
        weight = 1.0 if first else params["stepSize"]
        self.trees.append((tree, weight))
        self.pending.append((tree, weight))
        if len(self.pending) == HELD:
            self._hold()
        return loss

    def loss(self) -> float:
        """Evaluation loss of all trees so far."""
        got, _ = self._level(Tree(0), [], 0, True)
        return float(got[0] / got[1])

    def _hold(self) -> None:
        """Margins of all trees are held with the blocks; they follow from the blocks as written."""
        trees, zero = list(self.trees), self.zero

        def added(b):
            id_, y, ev, m, begin, row, bins = b
            m = m + sum((w * t.values[leaf_of(t, zero, begin, row, bins, len(y))] for t, w in trees), np.zeros(len(y)))
            return id_, y, ev, m, begin, row, bins

        before, self.held = self.held, self.base.map(added).persist(StorageLevel.MEMORY_AND_DISK)
        self.held.count()
        self.pending = []
        if before is not self.base:
            before.unpersist()

    def close(self) -> None:
        for r in (self.held, self.base):
            r.unpersist()

    def jvm(self, tree: Tree):
        """The tree as an MLlib regression tree (of the JVM)."""
        from pyspark import SparkContext

        sc = SparkContext._active_spark_context
        ml, old = sc._jvm.org.apache.spark.ml, sc._jvm.org.apache.spark.mllib

        def node(k: int):
            n, s, q = (float(v) for v in tree.stats[k])
            stats = sc._gateway.new_array(sc._jvm.double, 3)
            stats[0], stats[1], stats[2] = n, s, q
            held = old.tree.impurity.VarianceCalculator(stats, int(round(n)))
            value, impurity = s / max(n, 1.0), max(0.0, q / max(n, 1.0) - (s / max(n, 1.0)) ** 2)
            if tree.feature[k] < 0:
                return ml.tree.LeafNode(value, impurity, held)
            f = int(tree.feature[k])
            split = ml.tree.ContinuousSplit(f, float(self.cuts[f][tree.last[k]]))
            return ml.tree.InternalNode(value, impurity, float(tree.gain[k]), node(2 * k + 1), node(2 * k + 2),
                                        split, held)

        uid = sc._jvm.org.apache.spark.ml.util.Identifiable.randomUID("dtr")
        return ml.regression.DecisionTreeRegressionModel(uid, node(0), self.n_features)
