"""Language detection and language filtering.

A character-trigram Naive Bayes model whose profiles are learned by a
Spark job from labelled texts:

* normalise: lower-case, every run of non-letters -> one space, pad with a
  space on both sides;
* features: all overlapping character trigrams of the whole text;
* profile: ``c(lang, trigram)``; ``N_lang`` = trigrams seen for the
  language, ``V`` = distinct trigrams over all languages;
* score: ``sum_t n_t * log((c(lang, t) + 1) / (N_lang + V))``, which is
  ``sum over trigram occurrences of log(c + 1) - T * log(N_lang + V)`` with
  ``T`` the text's trigram count; the top score wins (first language in
  name order on ties). Texts without a trigram get ``unknown``.

Plan. Fit: trigram occurrences are counted inside Arrow batches, so one
partial count per (batch, language, trigram) leaves a task (no shuffle of text,
no join back to the labels); the profile (one row per trigram, one count column
per language) is checkpointed to the shared checkpoint folder, so its row count
``V`` and the language totals are read from that small table and the lineage is
cut. Detect: because the score is a sum over occurrences, no per-(text,
trigram) count is needed. When the profile takes at most ``row_max_bytes`` the
sums of a text are made inside its row; when at most ``broadcast_max_bytes`` it
is broadcast and the plan is scan -> explode -> broadcast join -> partial sum
per text. Either shuffle carries one small row per text (and partition).
Otherwise occurrences are pre-aggregated per (text, trigram) and joined on the
trigram by a shuffle join (AQE splits hot trigrams).
Sentences of a text (F17, F18) are scored inside their row where the profile
takes at most ``row_max_bytes``: an Arrow-batched function looks the trigrams
up, splitting and filtering stay column expressions, and nothing is shuffled.
With a larger profile the sentences go through ``detect``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailcase.functions.text import split_sentences

UNKNOWN = "unknown"
NON_LETTERS = r"[^\p{L}]+"
TRIGRAM = r"(?s)(?=(.{3}))"
# Profiles up to this size in memory are broadcast.
BROADCAST_MAX_BYTES = 256 << 20
# Profiles up to this size are sent to the Python workers, for scoring in the row.
ROW_MAX_BYTES = 64 << 20
#: More distinct labels than this are taken for a dirty column.
MAX_LANGUAGES = 256


def normalized(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    core = F.trim(F.regexp_replace(F.lower(t), NON_LETTERS, " "))
    return F.when(F.length(core) > 0, F.concat(F.lit(" "), core, F.lit(" ")))


def trigrams(text) -> Column:
    """Every overlapping trigram of the normalised text (null for no letters).

    A zero-width lookahead yields them in one linear scan (a substring per
    position would rescan the UTF-8 text each time).
    """
    return F.regexp_extract_all(normalized(text), F.lit(TRIGRAM), 1)


@dataclass
class LanguageModel:
    languages: list[str]
    profile: DataFrame          # trigram, one log(c + 1) column per language
    log_norm: dict[str, float]  # language -> log(N_lang + V)
    n_trigrams: int             # V: rows of the profile
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES
    row_max_bytes: int = ROW_MAX_BYTES

    @property
    def n_bytes(self) -> int:
        """Size of the profile as a hash relation: key and row overhead, one double a language."""
        return self.n_trigrams * (64 + 8 * len(self.languages))

    def detect(self, df: DataFrame, keys: Sequence[str], text: str,
               output: str = "detected") -> DataFrame:
        """F16: (keys..., detected) for every row of ``df``; ``keys`` must be unique."""
        keys = list(keys)
        names = [f"_s{i}" for i in range(len(self.languages))]
        if self.n_bytes <= self.row_max_bytes and self.languages:
            d = df.select(*keys, self._row_sums(normalized(text)).alias("_v"))
            s = d.groupBy(*keys).agg(*[F.sum(F.element_at("_v", i + 1)).alias(c) for i, c in enumerate(["_T", *names])])
            return self._best(s, keys, output)
        occ = df.select(*keys, F.explode_outer(trigrams(text)).alias("trigram"))
        lcols = [f"_l{i}" for i in range(len(self.languages))]
        if self.n_bytes <= self.broadcast_max_bytes:
            j = occ.join(F.broadcast(self.profile), "trigram", "left")
            n = F.when(F.col("trigram").isNotNull(), F.lit(1)).otherwise(F.lit(0))
        else:
            pre = occ.groupBy(*keys, "trigram").agg(F.count("trigram").alias("_n"))
            j = pre.join(self.profile, "trigram", "left")
            n = F.col("_n")
        aggs = [F.sum(n).alias("_T")] + [
            F.sum(n * F.coalesce(F.col(c), F.lit(0.0))).alias(f"_s{i}")
            for i, c in enumerate(lcols)]
        return self._best(j.groupBy(*keys).agg(*aggs), keys, output)

    def _best(self, s: DataFrame, keys: list[str], output: str) -> DataFrame:
        """The best language of each text from its trigram count ``_T`` and sums ``_s0``, ..."""
        cand = F.array(*[
            F.struct((F.col(f"_s{i}") - F.col("_T") * F.lit(self.log_norm[lg])).alias("score"),
                     F.lit(-i).alias("neg_rank"), F.lit(lg).alias("lang"))
            for i, lg in enumerate(self.languages)])
        return s.select(*keys, F.when(F.col("_T") > 0, F.array_max(cand)["lang"])
                        .otherwise(F.lit(UNKNOWN)).alias(output))


    def detect_each(self, texts: Column) -> Column:
        """F16 for every element of an array column, inside the row.

        The profile is collected (at most ``row_max_bytes``, checked by the
        caller) and sent to the tasks once. A null array gives null.
        """
        names = self.languages
        sent = self._sent()

        @F.pandas_udf("array<string>")
        def languages(arrays: pd.Series) -> pd.Series:
            whole = [[] if a is None else list(a) for a in arrays]
            best = iter(best_languages([s for a in whole for s in a], *sent.value))
            found = [[UNKNOWN if k < 0 else names[k] for _, k in zip(a, best)] for a in whole]
            return pd.Series([None if a is None else f for a, f in zip(arrays, found)], dtype=object)

        return languages(F.transform(texts, normalized))

    def _row_sums(self, text: Column) -> Column:
        """(trigrams, sum of log(c + 1) per language) of a normalised text, as an array of doubles."""
        sent = self._sent()

        @F.pandas_udf("array<double>")
        def sums(texts: pd.Series) -> pd.Series:
            n, found = trigram_sums([t if isinstance(t, str) else None for t in texts], *sent.value[:2])
            return pd.Series(list(np.concatenate([n[:, None], found], axis=1)), dtype=object)

        return sums(text)

    def _sent(self):
        """(sorted trigram keys, their logs, log norms) as sent to the tasks."""
        names = self.languages
        table = self.profile.toArrow()
        keys = trigram_keys("".join(table.column("trigram").to_pylist()))[::3]
        order = np.argsort(keys)
        logs = np.stack([table.column(f"_l{i}").to_numpy() for i in range(len(names))], axis=1)[order]
        # The last row, of zeros, stands for trigrams outside the profile.
        logs = np.concatenate([logs, np.zeros((1, len(names)))])
        return self.profile.sparkSession.sparkContext.broadcast(
            (keys[order], logs, np.array([self.log_norm[lg] for lg in names])))


def trigram_keys(text: str) -> np.ndarray:
    """The trigram at each position of a text as one number: three code points of 21 bits."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:] if len(c) > 2 else np.zeros(0, dtype=np.int64)


def best_languages(texts: Sequence[str | None], keys: np.ndarray, logs: np.ndarray, norm: np.ndarray,
                   piece: int = 1 << 18) -> list[int]:
    """Number of the best language of each normalised text, -1 for null."""
    n, sums = trigram_sums(texts, keys, logs, piece)
    return np.where(n > 0, np.argmax(sums - n[:, None] * norm, axis=1), -1).tolist()


def trigram_sums(texts: Sequence[str | None], keys: np.ndarray, logs: np.ndarray, piece: int = 1 << 18
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams of each normalised text, 0 for null; sums of their rows of ``logs``).

    The texts of about ``piece`` characters are scored at once, a longer one
    by pieces: their trigrams are looked up in the sorted ``keys``, and the rows
    of ``logs`` (the last one for trigrams that are not there) are summed up.
    """
    n, out = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), logs.shape[1]))

    def rows_of(grams: np.ndarray) -> np.ndarray:
        if not len(keys):
            return logs[np.zeros(len(grams), dtype=np.int64)]
        row = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        return logs[np.where(keys[row] == grams, row, len(keys))]

    some = [i for i, s in enumerate(texts) if s is not None and len(s) > 2]
    at = 0
    while at < len(some):
        end, held = at, 0
        while end < len(some) and (end == at or held + len(texts[some[end]]) <= piece):
            held += len(texts[some[end]])
            end += 1
        part = some[at:end]
        size = np.array([len(texts[i]) for i in part], dtype=np.int64)
        n[part] = size - 2
        if held > piece:
            whole = texts[part[0]]
            for a in range(0, len(whole) - 2, piece):
                out[part[0]] += rows_of(trigram_keys(whole[a:a + piece + 2])).sum(axis=0)
        else:
            begin = np.cumsum(size) - size
            grams = trigram_keys("".join([texts[i] for i in part]))
            # Positions whose trigram lies inside one text.
            own = np.repeat(begin + size - 2, size)[:len(grams)] > np.arange(len(grams))
            first = np.cumsum(size - 2) - (size - 2)
            out[part] = np.add.reduceat(rows_of(grams[own]), first, axis=0)
        at = end
    return n, out


def _count_trigrams(batches):
    """(language, trigram, occurrences) of normalised texts, counted by pieces of a batch."""
    piece = 1 << 20

    def counted(lang, texts):
        found, n = np.unique(np.concatenate([trigram_keys(t) for t in texts]), return_counts=True)
        chars = np.stack([found >> 42, found >> 21 & 0x1FFFFF, found & 0x1FFFFF], axis=1).astype("<u4")
        whole = chars.tobytes().decode("utf-32-le")
        grams = [whole[i:i + 3] for i in range(0, len(whole), 3)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams, pa.string()),
                                           pa.array(n.astype(np.int64))], names=["lang", "trigram", "n"])

    for batch in batches:
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        for lang, t in zip(batch.column("_lang").to_pylist(), batch.column("_text")):
            t = t.as_py()
            for a in range(0, len(t or "") - 2, piece):
                held.setdefault(lang, []).append(t[a:a + piece + 2])
                size[lang] = size.get(lang, 0) + min(piece, len(t) - a)
                if size[lang] >= piece:
                    yield counted(lang, held.pop(lang))
                    size[lang] = 0
        for lang, texts in held.items():
            yield counted(lang, texts)


def fit_language_model(train: DataFrame, key: str, text: str, lang: str, *,
                       languages: Sequence[str] | None = None,
                       broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> LanguageModel:
    """Learn trigram profiles from labelled texts (``key`` kept for the API).

    ``languages`` is the label set; texts with other labels are not learnt from.
    Without it the labels of the column are used, at most ``MAX_LANGUAGES``.
    """
    from mailcase.session import ensure_checkpoint_dir

    if languages is None:
        found = train.select(lang).where(F.col(lang).isNotNull()).distinct().limit(MAX_LANGUAGES + 1)
        languages = [r[0] for r in found.collect()]
        if len(languages) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} values in {lang!r}: give the languages")
    languages = sorted(set(languages))
    known = train.where(F.col(lang).isin(languages)).select(
        F.col(lang).alias("_lang"), normalized(text).alias("_text"))
    part = known.mapInArrow(_count_trigrams, f"`{lang}` string, trigram string, n long")
    counts = part.groupBy(lang, "trigram").agg(F.sum("n").alias("c"))
    wide = counts.groupBy("trigram").pivot(lang, languages).agg(F.first("c"))
    ensure_checkpoint_dir(train.sparkSession)
    wide = wide.select("trigram", *[F.coalesce(F.col(f"`{lg}`"), F.lit(0)).alias(f"_c{i}")
                                    for i, lg in enumerate(languages)]).checkpoint()
    row = wide.agg(F.count(F.lit(1)).alias("V"),
                   *[F.sum(f"_c{i}").alias(f"N{i}") for i in range(len(languages))]).first()
    v = row["V"]
    log_norm = {lg: math.log(row[f"N{i}"] + v) for i, lg in enumerate(languages)}
    profile = wide.select("trigram", *[F.log1p(f"_c{i}").alias(f"_l{i}")
                                       for i in range(len(languages))])
    return LanguageModel(languages, profile, log_norm, v, broadcast_max_bytes)


def sentence_languages(df: DataFrame, key: str, text: str, model: LanguageModel, *,
                       distinct: bool = False) -> DataFrame:
    """(key, pos, sentence, lang) for every sentence of every text; with
    ``distinct`` for the first occurrence of each sentence of a text."""
    s = df.select(key, F.posexplode(split_sentences(text)).alias("pos", "sentence"))
    if model.n_bytes <= model.row_max_bytes:
        parts = df.select(key, split_sentences(text).alias("s"))
        parts = parts.select(key, "s", model.detect_each(F.col("s")).alias("lang"))
        out = parts.select(key, F.posexplode(F.arrays_zip("s", "lang")).alias("pos", "e")).select(
            key, "pos", F.col("e.s").alias("sentence"), F.col("e.lang").alias("lang"))
    else:
        out = s.join(model.detect(s, [key, "pos"], "sentence", "lang"), [key, "pos"])
    if not distinct:
        return out
    return out.groupBy(key, "sentence").agg(F.min("pos").alias("pos"), F.first("lang").alias("lang")
                                            ).select(key, "pos", "sentence", "lang")


def keep_language(df: DataFrame, key: str, text: str, model: LanguageModel,
                  language: str, output: str = "kept") -> DataFrame:
    """keep the sentences detected as ``language``, rejoined by ``'. '`` in order.

    Sentences are detected and filtered inside the row. With a profile too
    large for that only positions travel: the kept positions of a text (small
    ints, one text per group) are joined to the text, which is split again and
    filtered by position. Texts with no kept sentence give ``''``; null texts
    stay null.
    """
    if model.n_bytes <= model.row_max_bytes:
        parts = df.select(key, split_sentences(text).alias("s"))
        zipped = parts.select(key, F.arrays_zip(
            "s", model.detect_each(F.col("s")).alias("lang")).alias("e"))
        chosen = F.filter("e", lambda e: e["lang"] == language)
        return zipped.select(key, F.when(F.col("e").isNotNull(), F.concat_ws(". ", chosen["s"])).alias(output))
    s = df.select(key, F.posexplode(split_sentences(text)).alias("pos", "sentence"))
    det = model.detect(s, [key, "pos"], "sentence", "_lang")
    kept = det.where(F.col("_lang") == language).groupBy(key).agg(
        F.collect_list("pos").alias("_pos"))
    parts = F.transform(split_sentences(text), lambda x, i: F.struct(i.alias("i"), x.alias("s")))
    chosen = F.filter(parts, lambda e: F.array_contains(
        F.coalesce(F.col("_pos"), F.array().cast("array<int>")), e["i"]))
    return df.select(key, text).join(kept, key, "left").select(
        key, F.when(F.col(text).isNotNull(), F.concat_ws(". ", chosen["s"])).alias(output))
