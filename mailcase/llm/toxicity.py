"""Toxicity: boosted trees over dense features, isotonic calibration.

Features of a whole text: densities of a lexicon of words and of word stems,
their nearness to second-person pronouns, capitals, punctuation and signs of
obfuscation. Lexicon words are compared after undoing common disguises
(digits and symbols for letters, separators inside a word).

The lexicon is learned from one half of a bounded labelled sample (words and
stems whose share among toxic texts is many times that among the others),
trees and calibration from the other half, so the densities the trees see are
those of unseen texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.llm.samples import held_out, training_labels
from mailcase.llm.tables import stored, text_id
from mailcase.llm.wordhash import (_BYTE_VALUES, LOWER, NON_SPACE, Words, mix, pieces, range_hashes,
                                   signed)

#: Largest number of labelled rows used, half for the lexicon, half for the trees.
MAX_TRAINING_ROWS = 24_000
MAX_LEXICON = 2_000
LEAST_ODDS = np.log(8.0)
STEM_BYTES = 5
THRESHOLD = 0.5
NEAR = 3
#: Second-person pronouns (fixed values).
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta tes "
                 "vous votre vos ti tus usted ustedes vosotros").split()
_LEET = LOWER.copy()
for _a, _b in zip(b"013457@$", b"oieastas"):
    _LEET[_a] = _b
_is = lambda s: np.array([b in s for b in range(256)])
_UPPER, _DIGIT = _is(range(0x41, 0x5B)), _is(range(0x30, 0x3A))
_LETTER = np.array([b >= 0x80 or 0x41 <= (b & 0xDF) <= 0x5A for b in range(256)])
_PUNCT = np.array([0x20 < b < 0x7F and not _LETTER[b] and not _DIGIT[b] for b in range(256)])
_KEPT = _LETTER | _DIGIT | ~NON_SPACE | _is(b"@$")


def _plain(buf: np.ndarray, off: np.ndarray) -> Words:
    """Words with disguises undone: letters only, other signs dropped."""
    lo, hi = int(off[0]), int(off[-1])
    kept = _KEPT[buf[lo:hi]]
    place = np.concatenate(([0], np.cumsum(kept)))
    return Words(_LEET[buf[lo:hi][kept]], place[off - lo], NON_SPACE)


def _stems(w: Words) -> np.ndarray:
    """Hash of the first bytes of each word that is longer (0: no stem)."""
    long_ = np.flatnonzero(w.ends - w.starts > STEM_BYTES)
    out = np.zeros(len(w.starts), dtype=np.uint64)
    for lo in range(0, len(long_), 1 << 16):
        k = long_[lo:lo + (1 << 16)]
        s = w.starts[k]
        out[k] = range_hashes(_BYTE_VALUES[w.buf[s[0]:s[-1] + STEM_BYTES]], s - s[0],
                              s - s[0] + STEM_BYTES)
    return np.where(out == 0, out, mix(out + np.uint64(7)))


def _terms(batches):
    """(term, label) for each distinct word and stem of each document."""
    for b in batches:
        label = b.column("label").to_numpy()
        for i, _, buf, off in pieces(b.column("text")):
            w = _plain(buf, off)
            h, doc, stem = w.hashes(), w.doc_of(), _stems(w)
            doc, h = np.concatenate((doc, doc[stem != 0])), np.concatenate((h, stem[stem != 0]))
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            if not len(h):
                continue
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(signed(h[new])),
                "label": pa.array(label[doc[new] + i].astype(np.int32))})


def learn_lexicon(rows: DataFrame, most: int = MAX_LEXICON) -> np.ndarray:
    """Sorted hashes of the terms that mark label 1 in (text, label) rows (a bounded sample)."""
    n = rows.agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = int(n["t"] or 0), int(n["n"]) - int(n["t"] or 0)
    per = rows.select("text", "label").mapInArrow(_terms, "term long, label int").groupBy("term").agg(
        F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    odds = (F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0))
            - F.log((F.col("n") - F.col("t") + 0.5) / F.lit(clean + 1.0)))
    least = max(3.0, 0.005 * toxic)
    top = (per.where((F.col("t") >= least) & (odds >= float(LEAST_ODDS)))
           .orderBy((odds * F.col("t")).desc(), "term").limit(most))
    found = np.array([r["term"] for r in top.select("term").collect()], dtype=np.int64)
    return np.sort(found.view(np.uint64))


def _in(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(keys), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)] == keys


def _pronouns() -> np.ndarray:
    data = " ".join(SECOND_PERSON).encode()
    return np.sort(Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]),
                         NON_SPACE).hashes(LOWER))


FEATURES = ("words words_lexicon stems_lexicon hits near_hits second_person capitals capital_words "
            "exclamation question punctuation digits mixed_words inner_signs word_length").split()


def features(buf: np.ndarray, off: np.ndarray, lexicon: np.ndarray,
             pronouns: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each document of a piece."""
    raw, plain = Words(buf, off, NON_SPACE), _plain(buf, off)
    lo, hi = int(off[0]), int(off[-1])
    text = buf[lo:hi]

    def per_doc(marks, first):
        """Sum of marks over each document's range."""
        c = np.concatenate(([0], np.cumsum(marks)))
        return np.diff(c[first]).astype(float)

    def bytes_of(marks):
        return per_doc(marks, off - lo)

    def in_word(marks):
        """Count of marked bytes in each raw word."""
        c = np.concatenate(([0], np.cumsum(marks)))
        return c[raw.ends - lo] - c[raw.starts - lo]

    word_hit = _in(plain.hashes(), lexicon)
    stem_hit = _in(_stems(plain), lexicon)
    hit = word_hit | stem_hit
    second = _in(plain.hashes(), pronouns)
    near = np.zeros(len(hit) + 1)
    at = np.flatnonzero(second)
    doc_first, doc_end = np.repeat(plain.first[:-1], plain.counts), plain.doc_end()
    np.add.at(near, np.maximum(at - NEAR, doc_first[at]), 1)
    np.add.at(near, np.minimum(at + NEAR + 1, doc_end[at]), -1)
    near = np.cumsum(near[:-1]) > 0
    letters, upper, digits, signs = _LETTER[text], _UPPER[text], _DIGIT[text], _PUNCT[text]
    size = raw.ends - raw.starts
    n_letters, n_upper = in_word(letters), in_word(upper)
    mixed = (in_word(digits) > 0) & (n_letters > 1)
    inner = np.zeros(len(text), dtype=bool)
    inner[1:-1] = signs[1:-1] & letters[:-2] & letters[2:]
    words, chars = np.maximum(raw.counts, 1), np.maximum(np.diff(off), 1)
    n_plain = np.maximum(plain.counts, 1)
    return np.column_stack((
        np.log1p(raw.counts), per_doc(word_hit, plain.first) / n_plain,
        per_doc(stem_hit, plain.first) / n_plain, np.log1p(per_doc(hit, plain.first)),
        np.log1p(per_doc(hit & near, plain.first)), per_doc(second, plain.first) / n_plain,
        bytes_of(upper) / np.maximum(bytes_of(letters), 1),
        per_doc((n_upper == n_letters) & (n_letters > 1), raw.first) / words,
        bytes_of(text == 0x21) / chars, bytes_of(text == 0x3F) / chars, bytes_of(signs) / chars,
        bytes_of(digits) / chars, per_doc(mixed, raw.first) / words, bytes_of(inner) / words,
        per_doc(size, raw.first) / words))


class BoostedTrees:
    """Binary gradient-boosted trees on binned features, calibrated by isotonic regression."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3,
                 rate: float = 0.15, bins: int = 32, ridge: float = 1.0, seed: int = 3):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float((y.sum() + 1) / (len(y) + 2))
            return
        order = np.random.default_rng(seed).permutation(len(y))
        n_cal = len(y) // 5
        fit, cal = order[n_cal:], order[:n_cal]
        if y[fit].min() == y[fit].max() or n_cal < 20:
            fit = cal = order
        self.edges = [np.unique(np.quantile(x[fit, f], np.linspace(0, 1, bins + 1)[1:-1]))
                      for f in range(x.shape[1])]
        b = self._binned(x)
        p = np.clip(y[fit].mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees = float(np.log(p / (1 - p))), []
        z = np.full(len(fit), self.start)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-z))
            tree = self._grow(b[fit], q - y[fit], q * (1 - q), depth, bins, ridge)
            tree[2] *= rate
            self.trees.append(tree)
            z += tree[2][self._leaf(tree, b[fit])]
        self._isotonic(self._raw(b[cal]), y[cal])

    def _binned(self, x):
        return np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)])

    @staticmethod
    def _grow(b, g, h, depth, bins, ridge):
        """[feature, bin, leaf values]; node k has children 2k + 1 and 2k + 2, right if bin > cut."""
        feature = np.zeros(2 ** depth - 1, dtype=np.int64)
        cut = np.full(2 ** depth - 1, bins, dtype=np.int64)
        node = np.zeros(len(g), dtype=np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            local, best = node - first, np.full(width, 1e-9)
            for f in range(b.shape[1]):
                cell = local * (bins + 1) + b[:, f]
                gl = np.bincount(cell, g, width * (bins + 1)).reshape(width, -1).cumsum(1)
                hl = np.bincount(cell, h, width * (bins + 1)).reshape(width, -1).cumsum(1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = (gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge)
                        - gl[:, -1:] ** 2 / (hl[:, -1:] + ridge))
                gain[(hl < 1) | (hr < 1)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best[better] = gain[np.arange(width), k][better]
                feature[first:first + width][better] = f
                cut[first:first + width][better] = k[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - (2 ** depth - 1)
        value = -np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + ridge)
        return [feature, cut, value]

    @staticmethod
    def _leaf(tree, b):
        feature, cut, value = tree
        node = np.zeros(len(b), dtype=np.int64)
        while len(node) and node[0] < len(feature):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return node - len(feature)

    def _raw(self, b):
        z = np.full(len(b), self.start)
        for t in self.trees:
            z += t[2][self._leaf(t, b)]
        return z

    def _isotonic(self, z, y):
        """Pool adjacent violators: a nondecreasing step function from raw score to share."""
        order = np.argsort(z, kind="stable")
        at, first = np.unique(z[order], return_index=True)
        blocks = []                        # [weight, sum, first raw score]
        for s, n, lo in zip(np.add.reduceat(y[order], first), np.diff(np.append(first, len(z))), at):
            blocks.append([float(n), float(s), lo])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                n2, s2, _ = blocks.pop()
                blocks[-1][0] += n2
                blocks[-1][1] += s2
        self.steps = np.array([b[2] for b in blocks])
        self.share = np.array([(b[1] + 0.5 * p) / (b[0] + p) for p in (1.0,) for b in blocks])
        self.share = np.maximum.accumulate(self.share)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._raw(self._binned(x))
        step = self.share[np.maximum(np.searchsorted(self.steps, z, "right") - 1, 0)]
        # A thousandth of the raw probability keeps the order inside a step.
        return 0.999 * step + 0.001 / (1 + np.exp(-np.clip(z, -30, 30)))


def _featurise(lexicon):
    def run(batches):
        words, pronouns = lexicon.value, _pronouns()
        for b in batches:
            for i, j, buf, off in pieces(b.column("text")):
                x = features(buf, off, words, pronouns)
                yield pa.RecordBatch.from_pydict({
                    "_id": b.column("_id").slice(i, j - i), "label": b.column("label").slice(i, j - i),
                    "x": pa.array(list(x), pa.list_(pa.float64()))})
    return run


def _score(lexicon, model):
    def run(batches):
        words, pronouns, trees = lexicon.value, _pronouns(), model.value
        for b in batches:
            for i, j, buf, off in pieces(b.column("text")):
                yield pa.RecordBatch.from_pydict({
                    "doc": b.column("doc").slice(i, j - i),
                    "score": pa.array(trees.predict(features(buf, off, words, pronouns)))})
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", *, folds: int = 5, fold: int = 0,
                    bound: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) of every row.

    At most ``bound`` labelled rows outside the held-out fold are learned
    from; only the text goes into a score. Null and empty texts have features
    of zero and a score like any text. Without usable labels, or with one
    class only, the score is the smoothed share of label 1. Rows are scored
    one by one, so equal rows get equal scores and null keys are kept (never
    held out); an empty table gives an empty result. Of the rows of a labelled
    key, one with the smallest text hash is learned from, so a key that many
    rows share weighs no more than another; besides these texts, at most one a
    key and task, no text is shuffled.
    """
    sc = docs.sparkSession.sparkContext
    sample = F.broadcast(training_labels(labels, key, label, folds, fold, bound))
    src = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    one = F.min_by(F.struct("text", F.col("_label").alias("label")), F.coalesce(text_id("text"), F.unhex(F.lit(""))))
    rows = stored(src.join(sample, src["doc"] == sample["_id"]).groupBy("_id").agg(one.alias("r")).select(
        "_id", "r.text", "r.label"), "sample")
    half = F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2))
    lexicon = sc.broadcast(learn_lexicon(rows.where(half == 0)))
    kind = src.schema["doc"].dataType.simpleString()
    got = (rows.where(half == 1).mapInArrow(_featurise(lexicon), f"_id {kind}, label int, x array<double>")
           .orderBy("_id", "x").toArrow())
    y = got.column("label").to_numpy().astype(float)
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(len(y), len(FEATURES))
    model = sc.broadcast(BoostedTrees(x, y))
    out = src.mapInArrow(_score(lexicon, model), T.StructType([
        src.schema["doc"], T.StructField("score", T.DoubleType())]))
    return out.select(F.col("doc").alias(key), held_out(F.col("doc"), folds, fold).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
