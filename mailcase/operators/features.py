"""TF-IDF features: vocabulary fit, long-form TF-IDF, MLlib featurizer (M1-M3).

Definitions (fixed so results match the reference's vectorizer):
terms are lower-cased word tokens of 2+ characters plus their bigrams;
``tf`` is the raw count; ``idf = ln((1 + n) / (1 + df)) + 1``; each
document vector is L2-normalised. The vocabulary keeps terms with
``df >= min_df`` and ``df <= max_df`` (a share of n when fractional), then
the ``max_features`` most frequent by corpus count (ties by term).

Texts are lower-cased by Spark, then cut and counted inside Arrow batches: the
characters of a token are those of Spark's own regex, and a term is a pair of
numbers of a slice's dictionary.

Plan of a capped fit: a mergeable sketch (term occurrences per hash bucket)
bounds the count of every term, and a second scan counts only the terms of the
fullest buckets. Its result is proven: the last term kept must be above the
bound of all others; if not, all terms are counted. So the shuffles carry
sketches and candidates, not every bigram of the corpus.
A transform with a capped vocabulary is row-local: no shuffle.

Without a cap nearly every term of every document is joined. ``PackedTerms``
keeps documents as slices: only the distinct terms of a slice are shuffled, once
for the fit and the join, and the numbers that come back have no text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                SQLTransformer)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailcase.functions.tokens import TOKEN_CHAR, TOKEN_PATTERN, ngrams, uni_bi_grams, word_tokens
from mailcase.operators.packing import lean, lines, numbers_of, packed, packed_terms, terms_of, unpacked, words_of
from mailcase.session import written

MIN_DF = 2
MAX_DF = 0.95
MAX_FEATURES = 3000

#: Sketches a fit keeps, buckets each of them counts, and candidates per term of the vocabulary.
SHARDS = 32
TRACKED = 1 << 15
CANDIDATES = 4

#: Bytes and rows of a slice of an Arrow batch that are counted at once (or one row).
SLICE_BYTES = 1 << 22
SLICE_ROWS = 1 << 16

#: Packed terms: bytes of text of a slice, tokens of all documents a bucket of terms,
#: and the words of a slice that are looked at for common ones.
PACKED_BYTES = 1 << 22
BUCKET_TOKENS = 1 << 20
COMMON = 1024


def _with_terms(docs: DataFrame, text: str, bigrams: bool, *keep: str) -> DataFrame:
    """(keep..., _t): the terms of a row as an array."""
    # Tokens are projected once; the n-gram expression then reads the column.
    d = docs.select(*keep, word_tokens(F.col(text)).alias("_tok"))
    return d.select(*keep, (uni_bi_grams("_tok") if bigrams else F.col("_tok")).alias("_t"))


def term_rows(docs: DataFrame, text: str = "text", bigrams: bool = True) -> DataFrame:
    """(term): one row per occurrence. Neighbouring tokens are paired by position
    and joined after the explode, so no lambda runs per token."""
    d = docs.select(word_tokens(F.col(text)).alias("_tok"))
    if not bigrams:
        return d.select(F.explode("_tok").alias("term"))
    after = F.slice("_tok", 2, F.greatest(F.size("_tok") - 1, F.lit(0)))
    pairs = d.select(F.inline(F.arrays_zip(F.col("_tok").alias("a"), after.alias("b"))))
    both = F.explode(F.array("a", F.concat("a", F.lit(" "), "b")))
    return pairs.select(both.alias("term")).where(F.col("term").isNotNull())


#: Whether a code point is part of a token, of each session that asked.
_CLASSES: dict[str, np.ndarray] = {}


def _word_chars(spark) -> np.ndarray:
    """Whether each code point is part of a token, as Spark's own regex has it (one small job a session)."""
    at = spark.sparkContext.applicationId
    if at not in _CLASSES:
        blocks = [("".join(map(chr, range(i, i + 4096))),) for i in range(0, 0x110000, 4096)
                  if not 0xD800 <= i < 0xE000]
        blocks += [("".join(map(chr, range(0xD000, 0xD800))),)]
        found = spark.createDataFrame(blocks, "s string").select(
            F.array_join(F.regexp_extract_all("s", F.lit(TOKEN_CHAR), 0), "").alias("s")).collect()
        known = np.zeros(1 << 21, dtype=bool)
        known[[ord(c) for r in found for c in r["s"]]] = True
        _CLASSES[at] = known
    return _CLASSES[at]


def _split(buf: np.ndarray, off: np.ndarray, known: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(tokens, number of each row's) of lower-cased UTF-8 texts: runs of 2+ word characters."""
    own = known[buf]                                  # right for ASCII
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        own &= buf < 0x80
        first = buf[lead].astype(np.int64)
        n = 2 + (first >= 0xE0) + (first >= 0xF0)
        char = first & (0x7F >> n)
        for k in range(1, 4):
            char = np.where(k < n, char << 6 | buf[np.minimum(lead + k, len(buf) - 1)] & 0x3F, char)
        lead, n = lead[known[char]], n[known[char]]
        for k in range(4):
            own[np.minimum(lead + k, len(buf) - 1)[k < n]] = True
    edge = np.zeros(len(buf) + 1, dtype=bool)         # a row's first byte begins a token
    edge[off] = True
    own = np.append(own, False)
    begin = own & edge
    begin[1:] |= own[1:] & ~own[:-1]
    begin[:1] = own[:1]
    end = ~own & False
    end[1:] = own[:-1] & (~own[1:] | edge[1:])
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    chars = np.append(0, np.cumsum(buf & 0xC0 != 0x80))
    two = chars[ends] - chars[starts] >= 2
    starts, ends = starts[two], ends[two]
    step = np.zeros(len(buf) + 1, dtype=np.int8)
    step[starts] += 1
    step[ends] -= 1
    kept = buf[np.cumsum(step[:-1], dtype=np.int8) > 0]
    places = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    tokens = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(kept)])
    return tokens, np.diff(np.searchsorted(starts, off))


def _cut(texts: pa.Array, known: np.ndarray, most: int = SLICE_BYTES):
    """(first row, tokens of each row, number of each token's word, words) of the slices
    of a column of lower-cased texts. ``words`` are the slice's distinct tokens."""
    _, off, data = texts.buffers()
    wide = pa.types.is_large_string(texts.type)
    at = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(at, at[i] + most, "right")) - 1
        j = max(i + 1, min(j, i + SLICE_ROWS, n))
        tokens, counts = _split(buf[at[i]:at[j]], at[i:j + 1] - at[i], known)
        tokens = tokens.dictionary_encode()
        yield i, counts, tokens.indices.to_numpy().astype(np.int64), tokens.dictionary.cast(pa.string())
        i = j


def _paired(counts: np.ndarray, token: np.ndarray, step: int, bigrams: bool) -> tuple[np.ndarray, np.ndarray]:
    """(documents, codes): a document (row of the slice) and a code for each occurrence of a term.

    A code is exact: first * step, for a pair plus second + 1, where step is the number of words + 1.
    """
    doc = np.repeat(np.arange(len(counts)), counts)
    code = token * step
    if bigrams:
        inside = doc[1:] == doc[:-1]
        code = np.concatenate((code, (code[:-1] + token[1:] + 1)[inside]))
        doc = np.concatenate((doc, doc[:-1][inside]))
    return doc, code


def _coded(texts: pa.Array, bigrams: bool, known: np.ndarray, most: int = SLICE_BYTES):
    """(first row, documents, codes, words) of the slices of a column of lower-cased texts."""
    for i, counts, token, words in _cut(texts, known, most):
        yield i, *_paired(counts, token, len(words) + 1, bigrams), words


def _spelled(code: np.ndarray, words: pa.Array) -> pa.Array:
    """The terms of codes."""
    first, second = np.divmod(code, len(words) + 1)
    after = words.take(pa.array(second - 1, mask=second == 0))
    return pc.binary_join_element_wise(words.take(pa.array(first)), after, " ", null_handling="skip")


def _cells(doc: np.ndarray, code: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, code, occurrences) of the distinct terms of each document."""
    cell, tf = np.unique(doc * (step * step) + code, return_counts=True)
    return *np.divmod(cell, step * step), tf


def _postings(doc: np.ndarray, code: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
    """(codes in order, each cell's place there, document, occurrences): a cell is a distinct term of a document."""
    cell, tf = np.unique(code * docs + doc, return_counts=True)
    code, doc = np.divmod(cell, docs)
    new = np.append(True, code[1:] != code[:-1])[:len(code)]
    return code[new], np.cumsum(new) - 1, doc, tf


def _counted(doc: np.ndarray, code: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    """(term, df, cf) of a slice."""
    _, of, tf = _cells(doc, code, len(words) + 1)
    term, df = np.unique(of, return_counts=True)
    cf = np.bincount(np.searchsorted(term, of), weights=tf, minlength=len(term)).astype(np.int64)
    return pa.RecordBatch.from_arrays([_spelled(term, words), pa.array(df, pa.int64()), pa.array(cf, pa.int64())],
                                      names=["term", "df", "cf"])


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _buckets(code: np.ndarray, words: pa.Array, size: int) -> np.ndarray:
    """The hash bucket, below ``size``, of each code's term."""
    h = _hashes(words)
    first, second = np.divmod(code, len(words) + 1)
    x = h[first] ^ (np.append(h, np.uint64(0))[second - 1] * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


def _lowered(docs: DataFrame, text: str, *keep: str) -> tuple[DataFrame, Broadcast]:
    """(keep..., lower-cased text), and the word characters for the tasks."""
    spark = docs.sparkSession
    low = docs.select(*keep, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    return low, spark.sparkContext.broadcast(_word_chars(spark))


class PackedTerms:
    """The terms of documents, packed: what ``doc_terms`` lists as rows.

    ``slices`` (slice, keys, blob) is written once: a slice is some 4 MB of text
    as the numbers of its words. ``blocks`` (bucket, slice, blob) has the distinct
    terms of each slice with df and cf; a bucket holds all slices' terms
    that begin with some words, or a share of a very common word's. Slices and buckets are
    of bounded size, whatever the input.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, bigrams: bool):
        d, known = _lowered(docs, text, key)
        self.key, self.bigrams = key, bigrams
        self.key_type = d.schema[key].dataType.simpleString()

        def row(keys, counts, token, words):
            seen = np.bincount(token, minlength=len(words))
            order = np.argsort(-seen, kind="stable")                 # small numbers for common words
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            words, seen = words.take(pa.array(order)), seen[order]
            common = pa.StructArray.from_arrays([words[:COMMON], pa.array(seen[:COMMON], pa.int64())], ["word", "n"])
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), keys),
                 pa.array([len(counts)], pa.int64()), pa.array([len(token)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(common)], pa.int32()), common),
                 pa.array([packed(counts, rank[token], lines(words, np.arange(len(words)))[0])], pa.binary())],
                names=["keys", "docs", "tokens", "common", "blob"])

        def write(batches):
            for b in batches:
                for i, counts, token, words in _cut(b.column(1), known.value, PACKED_BYTES):
                    yield lean(row, b.column(0)[i:i + len(counts)], counts, token, words)

        rows = d.mapInArrow(write, f"keys array<{self.key_type}>, docs long, tokens long, "
                                   "common array<struct<word: string, n: long>>, blob binary")
        rows = written(rows.withColumn("slice", F.monotonically_increasing_id()), "terms")
        self.slices = rows.select("slice", "keys", "blob")
        total = rows.agg(F.count(F.lit(1)).alias("slices"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"),
                         F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
        self.docs, self.size = total["docs"], max(1, -(-total["tokens"] // BUCKET_TOKENS))
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.bucket_tasks, self.slice_tasks = max(self.size, least), max(total["slices"], least)
        keys = rows.select(F.explode("keys").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        self.repeated = not keys.where(F.col("n") > 1).isEmpty()
        # At most 4 words a bucket are so common; each is dealt over some buckets.
        share = total["tokens"] / (4 * self.size)
        common = rows.select(F.inline("common")).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > share)
        common = common.collect() if self.size > 1 else []
        self.common = pa.array([r["word"] for r in common], pa.string())
        self.parts = np.array([-(-r["n"] // max(1, int(share))) for r in common], dtype=np.uint64)

        read, deal = self._reader(), self._dealer()

        def terms(at, blob):
            doc, code, docs, words = read(blob)
            term, of, _, tf = _postings(doc, code, docs)
            df = np.bincount(of, minlength=len(term))
            cf = np.bincount(of, weights=tf, minlength=len(term)).astype(np.int64)
            found = [*zip(*packed_terms(term, words, deal(term, words), df, cf))] or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int32()), pa.array([at] * len(found[0]), pa.int64()),
                                               pa.array(found[1], pa.binary())], names=["bucket", "slice", "blob"])

        def cut(batches):
            for b in batches:
                for at, blob in zip(b.column(0), b.column(1)):
                    yield lean(terms, at.as_py(), blob.as_py())

        # One exchange for the fit and the join. A task has about one bucket, or one slice, so its rows are sorted in memory.
        blocks = rows.select("slice", "blob").mapInArrow(cut, "bucket int, slice long, blob binary")
        self.blocks = blocks.repartition(self.bucket_tasks, "bucket")

    def _reader(self):
        """The function of a slice's bytes to its (documents, codes, number of documents, words)."""
        bigrams = self.bigrams

        def read(blob: bytes):
            counts, token, text = unpacked(blob)
            words = words_of(text).cast(pa.string())
            return *_paired(counts, token.astype(np.int64), len(words) + 1, bigrams), len(counts), words

        return read

    def _dealer(self):
        """The function of codes and their words to buckets: by the first word, of a common one also by the second."""
        common, parts, size = self.common, self.parts, self.size

        def deal(code: np.ndarray, words: pa.Array) -> np.ndarray:
            h = _hashes(words)
            first, second = np.divmod(code, len(words) + 1)
            of = np.ones(len(words), dtype=np.uint64)
            if len(common):
                at = pc.index_in(words, value_set=common).fill_null(-1).to_numpy()
                of[at >= 0] = parts[at[at >= 0]]
            x = h[first] ^ ((np.append(h, np.uint64(0))[second - 1] % of[first]) * np.uint64(0x9E3779B97F4A7C15))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return ((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)

        return deal

    def counts(self) -> DataFrame:
        """(term, df, cf) of every term."""
        def count(block: pa.Table) -> pa.Table:
            parts = [unpacked(x) for x in block["blob"].to_pylist()]
            code, words, _ = terms_of(parts)
            term, at = np.unique(code, return_inverse=True)
            df, cf = (np.bincount(at, weights=numbers_of(parts, k), minlength=len(term)).astype(np.int64) for k in (0, 1))
            return pa.table({"term": _spelled(term, words), "df": df, "cf": cf})

        return self.blocks.groupBy("bucket").applyInArrow(lambda x: lean(count, x), "term string, df long, cf long")

    def _asked(self, vocab: DataFrame) -> DataFrame:
        """(bucket, blob): terms of a vocabulary and their idf."""
        deal = self._dealer()

        def terms(held):
            t = pa.Table.from_batches(held).combine_chunks()
            pair = pc.split_pattern(t["term"].combine_chunks(), " ", max_splits=1)
            flat = pair.flatten().dictionary_encode()
            many, at = pc.list_value_length(pair).to_numpy(), flat.indices.to_numpy().astype(np.int64)
            begin = np.cumsum(many) - many
            code = at[begin] * (len(flat.dictionary) + 1)
            code[many == 2] += at[begin[many == 2] + 1] + 1
            order = np.argsort(code)
            words, code = flat.dictionary, code[order]
            idf = t["idf"].to_numpy()[order].astype(np.float64)
            found = [*zip(*packed_terms(code, words, deal(code, words), idf))]
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int32()), pa.array(found[1], pa.binary())],
                                              names=["bucket", "blob"])

        def pack(batches):
            held, n = [], 0
            for b in batches:
                held, n = [*held, b], n + b.num_rows
                if n >= BUCKET_TOKENS >> 2:
                    yield lean(terms, held)
                    held, n = [], 0
            if n:
                yield lean(terms, held)

        return vocab.select("term", "idf").mapInArrow(pack, "bucket int, blob binary")

    def tfidf(self, vocab: DataFrame) -> DataFrame:
        """(key, term, tfidf), see the function ``tfidf``.

        Each block's terms are looked up in its bucket of the vocabulary, and
        each slice gets back the idf of its terms, by bucket in order of the terms.
        """
        read, deal, key = self._reader(), self._dealer(), self.key

        def weights(x: pa.Table):
            """(keys, documents, places of their terms, weights, codes of the terms, words) of a slice and its answers."""
            order = np.argsort(x["bucket"].to_numpy())
            blobs = x["blob"].take(pa.array(order)).to_pylist()
            doc, code, docs, words = read(blobs[0])
            term, of, doc, tf = _postings(doc, code, docs)
            idf = np.empty(len(term))
            idf[np.argsort(deal(term, words), kind="stable")] = np.concatenate(
                [np.zeros(0), *(values[at] for at, values in map(unpacked, blobs[1:]))])
            known = ~np.isnan(idf)
            has = known[of]
            of, doc = of[has], doc[has]
            return x["keys"][int(order[0])].values, doc, (np.cumsum(known) - 1)[of], tf[has] * idf[of], term[known], words

        def answer(block: pa.Table, asked: pa.Table) -> pa.Table:
            wanted = [unpacked(x) for x in asked["blob"].to_pylist()]
            code, _, many = terms_of(wanted + [unpacked(x) for x in block["blob"].to_pylist()])
            many = many[len(wanted):]
            n = len(code) - many.sum()
            order = np.argsort(code[:n])
            want, code = np.append(code[:n][order], -1), code[n:]
            at = np.searchsorted(want[:n], code)
            values, place = np.unique(np.append(numbers_of(wanted, 0)[order], np.nan), return_inverse=True)
            at = np.where(want[at] == code, place[at], place[n])
            blobs = []
            for part in np.split(at, np.cumsum(many)[:-1])[:len(many)]:
                few, of = np.unique(part, return_inverse=True)
                blobs.append(packed(of, values[few]))
            return pa.table({"slice": block["slice"], "bucket": block["bucket"], "blob": pa.array(blobs, pa.binary())})

        def squares(x: pa.Table) -> pa.Table:
            keys, doc, _, w, _, _ = weights(x)
            own = np.unique(doc)
            return pa.table({"slice": pa.array(np.full(len(own), x["slice"][0].as_py())), "doc": pa.array(own, pa.int32()),
                             "k": keys.take(pa.array(own)), "s": np.bincount(doc, weights=w * w)[own].astype(np.float64)})

        def weigh(x: pa.Table, sums: pa.Table | None = None) -> pa.Table:
            keys, doc, of, w, term, words = weights(x)
            s = np.bincount(doc, weights=w * w, minlength=len(keys)).astype(np.float64)
            if sums is not None:
                s[sums["doc"].to_numpy()] = sums["s"].to_numpy()
            t = pa.table({key: keys.take(pa.array(doc)), "term": _spelled(term, words).take(pa.array(of)),
                          "tfidf": w / np.sqrt(s[doc])})
            return pa.Table.from_batches(t.to_batches(max_chunksize=SLICE_ROWS), t.schema)

        asked = self._asked(vocab).repartition(self.bucket_tasks, "bucket")
        answers = self.blocks.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(
            lambda x, y: lean(answer, x, y), "slice long, bucket int, blob binary")
        both = self.slices.select("slice", F.lit(-1).alias("bucket"), "blob", "keys").unionByName(
            answers, allowMissingColumns=True).repartition(self.slice_tasks, "slice")
        schema = f"`{key}` {self.key_type}, term string, tfidf double"
        if not self.repeated:
            return both.groupBy("slice").applyInArrow(lambda x: lean(weigh, x), schema)
        # A key's norm is of all its documents: sums of those of several come back to their slices.
        own = both.groupBy("slice").applyInArrow(lambda x: lean(squares, x), f"slice long, doc int, k {self.key_type}, s double")
        of = Window.partitionBy("k")
        sums = own.select("slice", "doc", F.sum("s").over(of).alias("s"), F.count(F.lit(1)).over(of).alias("n"))
        sums = sums.where(F.col("n") > 1).select("slice", "doc", "s").repartition(self.slice_tasks, "slice")
        return both.groupBy("slice").cogroup(sums.groupBy("slice")).applyInArrow(
            lambda x, y: lean(weigh, x, y), schema)


def doc_terms(docs: DataFrame, key: str = "doc_id", text: str = "text",
              bigrams: bool = True, *, pack: bool = False) -> DataFrame | PackedTerms:
    """(key, term, tf) for every distinct term of every document (whole texts).

    With ``pack`` they are written as ``PackedTerms``, for a fit and a join of all terms.
    """
    if pack:
        return PackedTerms(docs, key, text, bigrams)
    d, known = _lowered(docs, text, key)

    def run(batches):
        for b in batches:
            for i, doc, code, words in _coded(b.column(1), bigrams, known.value, SLICE_BYTES >> 2):
                doc, code, tf = _cells(doc, code, len(words) + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc + i)), _spelled(code, words), pa.array(tf, pa.int64())],
                    names=[key, "term", "tf"])

    return d.mapInArrow(run, f"`{key}` {d.schema[key].dataType.simpleString()}, term string, tf long")


def term_counts(docs: DataFrame | PackedTerms, text: str = "text", bigrams: bool = True) -> DataFrame:
    """(term, df, cf) of every term: one shuffle on ``term`` of the counts of slices."""
    if isinstance(docs, PackedTerms):
        return docs.counts()
    d, known = _lowered(docs, text)

    def run(batches):
        for b in batches:
            for _, doc, code, words in _coded(b.column(0), bigrams, known.value):
                yield _counted(doc, code, words)

    rows = d.mapInArrow(run, "term string, df long, cf long")
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def term_sketches(docs: DataFrame, text: str = "text", bigrams: bool = True, *,
                  shards: int = SHARDS, tracked: int = TRACKED) -> DataFrame:
    """(shard, state): term occurrences per hash bucket, ``tracked`` buckets a shard.

    ``state`` holds the shard's counts as 64-bit numbers. A task counts into one
    table, which is shuffled and added up by shard, so a reducer holds one
    sketch at a time whatever the input. A bucket's count bounds that of each of its terms.
    """
    size = shards * tracked
    d, known = _lowered(docs, text)

    def fill(batches):
        table = np.zeros(size, dtype=np.int64)
        for b in batches:
            for _, _, code, words in _coded(b.column(0), bigrams, known.value):
                table += np.bincount(_buckets(code, words, size), minlength=size)
        for k, part in enumerate(table.reshape(shards, tracked)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"shard": pa.array([k], pa.int32()),
                                                  "state": pa.array([part.tobytes()], pa.binary())})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, state in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(state.as_buffer(), dtype=np.int64)
                sums[k] = sums[k] + part if k in sums else part.copy()
        for k, part in sums.items():
            yield pa.RecordBatch.from_pydict({"shard": pa.array([k], pa.int32()),
                                              "state": pa.array([part.tobytes()], pa.binary())})

    parts = d.mapInArrow(fill, "shard int, state binary")
    return parts.repartition(min(shards, 16), "shard").mapInArrow(add, "shard int, state binary")


def bucket_terms(docs: DataFrame, full: np.ndarray, text: str = "text", bigrams: bool = True) -> DataFrame:
    """(term, df, cf) of the terms of the buckets that ``full`` marks."""
    d, known = _lowered(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast(full)

    def run(batches):
        for b in batches:
            for _, doc, code, words in _coded(b.column(0), bigrams, known.value):
                mine = sent.value[_buckets(code, words, len(sent.value))]
                yield _counted(doc[mine], code[mine], words)

    rows = d.mapInArrow(run, "term string, df long, cf long")
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _heaviest(docs: DataFrame, k: int, text: str, bigrams: bool, shards: int, tracked: int
              ) -> tuple[list[tuple], int]:
    """(rows, bound): (term, df, cf) of at most ``k`` terms, the most frequent first;
    no other term occurs more than ``bound`` times.

    At most one count per bucket and ``k`` + 1 rows reach the driver.
    """
    table = np.zeros((shards, tracked), dtype=np.int64)
    for r in term_sketches(docs, text, bigrams, shards=shards, tracked=tracked).collect():
        table[r["shard"]] = np.frombuffer(bytes(r["state"]), dtype=np.int64)
    table = table.ravel()
    least = max(1, int(np.partition(table, -k)[-k])) if k < len(table) else 1
    full = table >= least
    top = bucket_terms(docs, full, text, bigrams).orderBy(F.col("cf").desc(), F.col("term").asc()).limit(k + 1)
    rows = [tuple(r) for r in top.collect()]
    return rows[:k], max([int(table[~full].max(initial=0)), *(r[2] for r in rows[k:])])


def heavy_terms(docs: DataFrame, k: int, text: str = "text", bigrams: bool = True, *,
                shards: int = SHARDS, tracked: int = TRACKED) -> tuple[list[str], int]:
    """(candidates, bound): at most ``k`` terms, the most frequent of the fullest
    buckets; no other term occurs more than ``bound`` times."""
    rows, bound = _heaviest(docs, k, text, bigrams, shards, tracked)
    return [r[0] for r in rows], bound


def candidate_counts(docs: DataFrame, candidates: list[str], text: str = "text",
                     bigrams: bool = True) -> DataFrame:
    """(term, df, cf) of the candidates: they are counted inside the row, and
    the shuffle carries one partial count per candidate and task."""
    model = CountVectorizerModel.from_vocabulary(candidates, inputCol="_t", outputCol="_v")
    d = model.transform(_with_terms(docs, text, bigrams))
    v = d.select(F.unwrap_udt("_v").alias("v"))
    cells = v.select(F.inline(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x"))))
    counts = cells.groupBy("i").agg(F.count(F.lit(1)).alias("df"), F.sum("x").cast("long").alias("cf"))
    return counts.select(_term_of(candidates, F.col("i")).alias("term"), "df", "cf")


def _term_of(terms: list[str], index: Column) -> Column:
    """Term of a 0-based index: one array literal (no term holds a line end)."""
    return F.element_at(F.split(F.lit("\n".join(terms)), "\n"), index + 1)


def _limits(n: int, min_df: float, max_df: float) -> tuple[float, float]:
    lo = min_df if float(min_df).is_integer() and min_df >= 1 else min_df * n
    hi = max_df if float(max_df).is_integer() and max_df > 1 else max_df * n
    return lo, hi


def fit_vocabulary(docs: DataFrame | PackedTerms, key: str = "doc_id", text: str = "text", *,
                   min_df: float = MIN_DF, max_df: float = MAX_DF,
                   max_features: int | None = MAX_FEATURES, bigrams: bool = True,
                   shards: int = SHARDS, tracked: int = TRACKED) -> DataFrame:
    """M1: (term, df, cf, idf) of the fitted vocabulary.

    With ``max_features`` the terms are found by sketches and proven, see
    ``proven_vocabulary``; without, of packed terms, or if its proof fails, all are counted.
    """
    known = isinstance(docs, PackedTerms)
    n = docs.docs if known else docs.select(key).count()
    lo, hi = _limits(n, min_df, max_df)
    rows = None
    if not known and max_features is not None and CANDIDATES * max_features <= shards * tracked:
        rows = proven_vocabulary(docs, max_features, lo, hi, text, bigrams, shards=shards, tracked=tracked)
    if rows is not None:
        v = docs.sparkSession.createDataFrame(rows, "term string, df long, cf long")
    else:
        v = term_counts(docs, text, bigrams).where(F.col("df").between(lo, hi))
        if max_features is not None:
            v = v.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
    idf = F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return v.select("term", "df", "cf", idf.alias("idf"))


def proven_vocabulary(docs: DataFrame, max_features: int, lo: float, hi: float, text: str = "text",
                      bigrams: bool = True, *, shards: int = SHARDS, tracked: int = TRACKED
                      ) -> list[tuple] | None:
    """The vocabulary's (term, df, cf), at most ``max_features`` rows, or None if unproven.

    Every term outside the candidates occurs at most ``bound`` times. So the
    candidates' best are the vocabulary if the last of them occurs more often
    than that, or if so rare a term can't reach the smallest ``df`` anyway.
    """
    found, bound = _heaviest(docs, CANDIDATES * max_features, text, bigrams, shards, tracked)
    rows = [r for r in found if lo <= r[1] <= hi][:max_features]
    full = rows and len(rows) == max_features and rows[-1][2] > bound
    return rows if full or bound < max(lo, 1) else None


def tfidf(terms: DataFrame | PackedTerms, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """M2 (+ J6) for a vocabulary of any size: (key, term, tfidf), L2-normalised
    per document; unseen terms dropped. The join and the norm shuffle the
    weights; with a capped vocabulary use ``tfidf_rows``, with one of all terms ``PackedTerms``."""
    if isinstance(terms, PackedTerms):
        return terms.tfidf(vocab)
    w = terms.join(vocab.select("term", "idf"), "term").select(
        key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("tfidf"))


def tfidf_rows(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text",
               bigrams: bool = True) -> DataFrame:
    """M2 (+ J6) for a capped vocabulary: (key, term, tfidf), L2-normalised per document.

    Row-local: terms are matched to the vocabulary, weighted and normalised as
    one sparse vector inside the row, so nothing is shuffled.
    """
    model = featurizer(vocab, text, "_v", bigrams)
    terms = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    v = model.transform(docs.select(key, text)).select(key, vector_struct("_v").alias("v"))
    cells = v.select(key, F.inline(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x"))))
    return cells.select(key, _term_of(terms, F.col("i")).alias("term"), F.col("x").alias("tfidf"))


# ------------------------------------------------------------ MLlib featurizer

def _terms_sql(text: str, bigrams: bool) -> str:
    toks = f"regexp_extract_all(lower(coalesce(`{text}`, '')), r'{TOKEN_PATTERN}', 0)"
    if not bigrams:
        return f"SELECT *, {toks} AS _terms FROM __THIS__"
    return f"SELECT *, {toks} AS _tokens FROM __THIS__"


def _bigram_sql() -> str:
    # Same definition as functions.tokens.uni_bi_grams, in SQL text so the
    # stage can be saved inside a PipelineModel.
    t = "_tokens"
    k = f"(size({t}) - 1)"
    return (f"SELECT *, CASE WHEN {k} > 0 THEN concat({t}, zip_with("
            f"slice({t}, 1, greatest({k}, 0)), slice({t}, 2, greatest({k}, 0)), "
            f"(a, b) -> concat(a, ' ', b))) ELSE {t} END AS _terms FROM __THIS__")


def featurizer(vocab: DataFrame, text: str = "text", output: str = "features",
               bigrams: bool = True) -> PipelineModel:
    """M3: a saveable PipelineModel (terms -> counts -> idf -> L2) built from a
    fitted vocabulary. The vocabulary is collected to the driver in
    one action: it is bounded by the ``max_features`` it was fit with (use the
    long form ``tfidf`` for one fit without).
    """
    rows = vocab.select("term", "idf").orderBy("term").collect()
    terms = [r["term"] for r in rows]
    if not terms:
        raise ValueError("the vocabulary is empty: no term meets its document frequencies")
    idf = Vectors.dense([r["idf"] for r in rows])
    stages = [SQLTransformer(statement=_terms_sql(text, bigrams))]
    if bigrams:
        stages.append(SQLTransformer(statement=_bigram_sql()))
    stages += [
        CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_tf"),
        ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf"),
        Normalizer(p=2.0, inputCol="_tfidf", outputCol=output),
        SQLTransformer(statement="SELECT * EXCEPT (_tokens, _terms, _tf, _tfidf) FROM __THIS__"
                       if bigrams else
                       "SELECT * EXCEPT (_terms, _tf, _tfidf) FROM __THIS__"),
    ]
    return PipelineModel(stages)


def vector_struct(vec) -> Column:
    """An MLlib vector as struct<type, size, indices, values>, its stored form."""
    return F.unwrap_udt(F.col(vec) if isinstance(vec, str) else vec)


def vector_entries(vec, parsed: bool = False) -> Column:
    """array<struct<i, x>> of the stored non-zero entries of an MLlib vector.

    The struct form keeps the sparse layout, so a sparse vector is not
    expanded to a dense array; a dense vector gets indices 0..n-1. Pass a
    column already projected with ``vector_struct`` as ``parsed=True`` so the
    conversion runs once per row.
    """
    s = (F.col(vec) if isinstance(vec, str) else vec) if parsed else vector_struct(vec)
    idx = F.when(s["type"] == 0, s["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(s["values"]) - 1))
    pairs = F.arrays_zip(idx.alias("i"), s["values"].alias("x"))
    return F.filter(pairs, lambda e: e["x"] != 0.0)


def fit_featurizer(docs: DataFrame, key: str, text: str, *, output: str = "features",
                   min_df: float = MIN_DF, max_df: float = MAX_DF,
                   max_features: int = MAX_FEATURES, bigrams: bool = True
                   ) -> tuple[PipelineModel, DataFrame]:
    """Fit the vocabulary on ``docs`` with Spark and wrap it as a featurizer."""
    vocab = fit_vocabulary(docs, key, text, min_df=min_df, max_df=max_df,
                           max_features=max_features, bigrams=bigrams)
    return featurizer(vocab, text, output, bigrams), vocab


__all__ = ["doc_terms", "fit_vocabulary", "heavy_terms", "proven_vocabulary", "term_counts", "term_sketches",
           "tfidf", "tfidf_rows", "featurizer", "fit_featurizer", "ngrams", "vector_entries", "vector_struct"]
