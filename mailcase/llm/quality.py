"""Quality classifier: random-indexing word vectors, pooled, then a small network.

Tokens are runs of letters, digits or symbols. Each has a form (its folded
spelling) and a shape (kind, case, length, repetition of its left neighbour).
Random indexing gives every form and shape a sparse random index vector; the
context vector of a form (shape) is the sum of its neighbours' index vectors
over all documents. A token's vector is its index vector plus its normalised
context vector, a document's is the mean over its tokens.

The context vectors are one table of fixed size (hashed vocabulary), summed
over all documents. The two-layer network is trained by numpy on a bounded
sample of labelled rows; a temperature fitted on rows that training did not
see calibrates its probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.llm.samples import held_out, training_labels
from mailcase.llm.tables import TAG, stored, summed_table, text_tag
from mailcase.llm.wordhash import LOWER, Words, mix, pieces

DIMS = 32
FORMS = 1 << 13
SHAPES = 1 << 12
NONZERO = 2
#: Largest number of labelled rows the network is trained on.
MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.7
_BLOCK = 1 << 17
_SPACE, _LETTER, _DIGIT, _SYMBOL = range(4)
_CLASS = np.array([
    _SPACE if b <= 0x20 or b == 0x7F else _DIGIT if 0x30 <= b <= 0x39 else
    _LETTER if b >= 0x80 or 0x41 <= (b & 0xDF) <= 0x5A else _SYMBOL for b in range(256)],
    dtype=np.uint8)
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])


def _tokens(buf: np.ndarray, off: np.ndarray):
    """(words, form ids, shape ids) of a run of documents; ids index one table."""
    w = Words(buf, off, _CLASS)
    h = w.hashes(LOWER)
    n = len(h)
    form = (h % np.uint64(FORMS)).astype(np.int64)
    lo, hi = int(off[0]), int(off[-1])
    upper = np.concatenate(([0], np.cumsum(_UPPER[buf[lo:hi]])))
    size = w.ends - w.starts
    up = upper[w.ends - lo] - upper[w.starts - lo]
    kind = _CLASS[buf[w.starts]].astype(np.int64)
    case = np.where(up == 0, 0, np.where((up == size) & (size > 1), 1,
                                         np.where(up == 1, 2, 3)))
    same = np.zeros(n, dtype=np.int64)
    if n > 1:
        same[1:] = (h[1:] == h[:-1])
        inner = w.first[(w.first > 0) & (w.first < n)]
        same[inner] = 0
    symbol = np.where(kind == _SYMBOL, buf[w.starts], 0).astype(np.int64)
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 5)
    code = (((kind * 4 + case) * 8 + length) * 2 + same) * 256 + symbol
    shape = (mix(code.astype(np.uint64) + np.uint64(1)) % np.uint64(SHAPES)).astype(np.int64)
    return w, form, shape + FORMS


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, signs) of the nonzero entries of every id's index vector."""
    ids = np.arange((FORMS + SHAPES) * NONZERO, dtype=np.uint64)
    h = mix(ids + np.uint64(0x51ED270B))
    dims = (h % np.uint64(DIMS)).astype(np.int64).reshape(-1, NONZERO)
    signs = np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).reshape(-1, NONZERO)
    return dims, signs


def _count_contexts(batches, table):
    dims, signs = _index_vectors()
    for b in batches:
        for _, _, buf, off in pieces(b.column(0)):
            w, form, shape = _tokens(buf, off)
            doc = w.doc_of()
            for lo in range(0, len(doc), _BLOCK):
                hi = min(len(doc), lo + _BLOCK + 1)
                near = np.flatnonzero(doc[lo:hi - 1] == doc[lo + 1:hi]) + lo
                for ids in (form, shape):
                    left, right = ids[near], ids[near + 1]
                    for k in range(NONZERO):
                        cell = np.concatenate((left * DIMS + dims[right, k],
                                               right * DIMS + dims[left, k]))
                        sign = np.concatenate((signs[right, k], signs[left, k]))
                        table += np.bincount(cell, sign, len(table)).astype(np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Index vector plus normalised context vector of every form and shape."""
    n = FORMS + SHAPES
    c = summed_table(docs.select(text), n * DIMS, _count_contexts).reshape(n, DIMS).astype(float)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1.0)
    dims, signs = _index_vectors()
    np.add.at(c, (np.arange(n)[:, None], dims), signs / np.sqrt(NONZERO))
    return c.astype(np.float32)


def _pool(vectors):
    """Mean token vectors (forms, shapes) and log of the token count of each document."""
    def run(batches):
        v = vectors.value
        for b in batches:
            for i, j, buf, off in pieces(b.column("text")):
                w, form, shape = _tokens(buf, off)
                doc, n = w.doc_of(), w.counts
                out = np.zeros((j - i, 2 * DIMS + 1), dtype=np.float64)
                for lo in range(0, len(doc), _BLOCK):
                    d = doc[lo:lo + _BLOCK]
                    at = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
                    for k, ids in enumerate((form, shape)):
                        out[d[at], k * DIMS:(k + 1) * DIMS] += np.add.reduceat(
                            v[ids[lo:lo + _BLOCK]], at, axis=0)
                out[:, :-1] /= np.maximum(n, 1)[:, None]
                out[:, -1] = np.log1p(n)
                rows = pa.FixedSizeListArray.from_arrays(
                    pa.array(out.astype(np.float32).ravel()), out.shape[1])
                yield pa.RecordBatch.from_pydict({
                    "doc": b.column("doc").slice(i, j - i), "tag": b.column("tag").slice(i, j - i),
                    "x": rows.cast(pa.list_(pa.float32()))})
    return run


def document_vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, x): the pooled vector of every whole text; tag: hash of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text))
    src = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    src = src.select("doc", text_tag("text").alias("tag"), "text")
    kind = src.schema["doc"].dataType.simpleString()
    return src.mapInArrow(_pool(sent), f"doc {kind}, tag {TAG}, x array<float>")


class Network:
    """Two-layer network with one hidden layer, standardised inputs and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 16, epochs: int = 60,
                 rate: float = 0.01, decay: float = 1e-4, seed: int = 5):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            # One class only (or nothing) to learn from: the smoothed share of label 1.
            self.constant = float((y.sum() + 1) / (len(y) + 2))
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = self._scaled(x)
        order = rng.permutation(len(y))
        n_val = max(1, len(y) // 5)
        val, fit = order[:n_val], order[n_val:] if len(y) > 5 else order
        self.p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
        m, v = ([np.zeros_like(a) for a in self.p] for _ in range(2))
        best, best_p, t = np.inf, None, 0
        for _ in range(epochs):
            for k in np.array_split(rng.permutation(fit), max(1, len(fit) // 256)):
                t += 1
                for i, g in enumerate(self._gradients(x[k], y[k], decay)):
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
            loss = self._loss(self._logit(x[val]), y[val])
            if loss < best:
                best, best_p = loss, [a.copy() for a in self.p]
        self.p = best_p
        z = self._logit(x[val])
        temperatures = np.geomspace(0.25, 8, 60)
        self.temperature = float(min(temperatures, key=lambda s: self._loss(z / s, y[val])))

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x):
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def _gradients(self, x, y, decay):
        h = np.maximum(x @ self.p[0] + self.p[1], 0)
        d = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -30, 30))) - y) / len(y)
        back = np.outer(d, self.p[2]) * (h > 0)
        return (x.T @ back + decay * self.p[0], back.sum(0), h.T @ d + decay * self.p[2],
                np.array([d.sum()]))

    @staticmethod
    def _loss(z, y):
        return float(np.mean(np.logaddexp(0, z) - y * z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._logit(self._scaled(x)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _score(network):
    def run(batches):
        net = network.value
        for b in batches:
            if not len(b):
                continue
            x = b.column("x").flatten().to_numpy().reshape(len(b), -1).astype(float)
            yield pa.RecordBatch.from_pydict({"doc": b.column("doc"), "tag": b.column("tag"),
                                              "score": pa.array(net.predict(x))})
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "quality", *, folds: int = 4, fold: int = 2,
                   bound: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted, text_hash, text_id) of every row.

    The network learns from at most ``bound`` labelled rows outside the
    held-out fold; only the text goes into a score. Null and empty texts have
    no tokens and score like an all-zero vector. Without usable labels, or
    with one class only, the score is the smoothed share of label 1. Rows are
    scored one by one, so equal rows get equal scores and null keys are kept
    (never held out); an empty table gives an empty result.
    """
    x = stored(document_vectors(docs, key, text), "vectors")
    sample = training_labels(labels, key, label, folds, fold, bound)
    # The sample is bounded, so it can be broadcast and its vectors collected.
    # Of the texts of one key, the one with the smallest hash: the same in every run.
    rows = x.join(F.broadcast(sample), x["doc"] == sample["_id"]).groupBy("_id").agg(
        F.min_by(F.struct("_label", "x"), F.coalesce("tag.id", F.unhex(F.lit("")))).alias("r"))
    got = rows.select("_id", "r._label", "r.x").orderBy("_id").toArrow()
    y = got.column("_label").to_numpy().astype(float)
    vectors = np.array(got.column("x").to_pylist(), dtype=float).reshape(len(y), 2 * DIMS + 1)
    net = docs.sparkSession.sparkContext.broadcast(Network(vectors, y))
    out = x.mapInArrow(_score(net), T.StructType([x.schema["doc"], x.schema["tag"],
                                               T.StructField("score", T.DoubleType())]))
    return out.select(F.col("doc").alias(key), held_out(F.col("doc"), folds, fold).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                      F.col("tag.h").alias("text_hash"), F.col("tag.id").alias("text_id"))
