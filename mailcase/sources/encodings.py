"""Encodings of files of any size.

A file is read in byte ranges, each by a task of its own, so no row or task
holds a whole file. A range gives counts that add up: bytes above ASCII, UTF-8
sequences and bytes that fit none, C1 bytes, NULs at even and odd places. A
sequence that crosses a border belongs to the range of its first byte; for
that a range is read with the three bytes before and after it.

The counts of a file give a likelihood for each encoding. Under UTF-8 the bytes
that must continue a sequence do so, but for one fault in a thousand. In a
single-byte encoding such a byte has a chance of a quarter (64 of 256 values).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
#: Bytes beyond a range that decide about its first and last sequence.
MARGIN = 3
FAULT = 0.001
CHANCE = 0.25
COUNTS = ("n_high", "n_sequences", "n_continued", "n_expected", "n_faults", "n_c1", "n_unused",
          "n_nul_even", "n_nul_odd")
#: Bytes that Windows-1252 leaves undefined (fixed values).
UNUSED_1252 = (0x81, 0x8D, 0x8F, 0x90, 0x9D)


def byte_counts(data: bytes, lo: int, hi: int, start: int = 0) -> dict[str, int]:
    """``COUNTS`` of data[lo:hi], which stands at place ``start`` of its file;
    the bytes around it are only looked at for sequences that cross a border."""
    b = np.frombuffer(data, dtype=np.uint8)
    x = np.concatenate((b, np.zeros(MARGIN, dtype=np.uint8)))
    size = np.zeros(len(b), dtype=np.int64)
    size[(b >= 0xC2) & (b <= 0xDF)] = 2
    size[(b >= 0xE0) & (b <= 0xEF)] = 3
    size[(b >= 0xF0) & (b <= 0xF4)] = 4
    at = np.flatnonzero(size)
    lead, n, second = b[at], size[at], x[at + 1]
    follows = [(x[at + i] & 0xC0) == 0x80 for i in (1, 2, 3)]
    # Overlong forms, surrogates and values past U+10FFFF have a second byte out of range.
    follows[0] &= ~(((lead == 0xE0) & (second < 0xA0)) | ((lead == 0xED) & (second > 0x9F))
                    | ((lead == 0xF0) & (second < 0x90)) | ((lead == 0xF4) & (second > 0x8F)))
    follows[1] &= follows[0] & (n > 2)
    follows[2] &= follows[1] & (n > 3)
    met = sum(f.astype(np.int64) for f in follows)
    whole = met == n - 1
    covered = np.zeros(len(x) + 1, dtype=bool)
    for i in range(4):
        covered[at[whole & (n > i)] + i] = True
    own, mine = b[lo:hi], (at >= lo) & (at < hi)
    nul = np.flatnonzero(own == 0) + start
    return {"n_high": int((own >= 0x80).sum()), "n_sequences": int((whole & mine).sum()),
            "n_continued": int(met[mine].sum()), "n_expected": int((n[mine] - 1).sum()),
            "n_faults": int(((own >= 0x80) & ~covered[lo:hi]).sum()),
            "n_c1": int(((own >= 0x80) & (own < 0xA0)).sum()),
            "n_unused": int(np.isin(own, UNUSED_1252).sum()),
            "n_nul_even": int((nul % 2 == 0).sum()), "n_nul_odd": int((nul % 2 == 1).sum())}


def _open(path: str):
    """A file of the local or a remote file system, opened for reading at any place."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    where, name = fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def _count(range_bytes: int):
    def run(batches):
        for batch in batches:
            for path, length, start in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start"))):
                end = min(start + range_bytes, length)
                first = max(0, start - MARGIN)
                with _open(path) as f:
                    f.seek(first)
                    data = f.read(min(end + MARGIN, length) - first)
                counts = byte_counts(data, start - first, end - first, start)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([path]), "length": pa.array([length], pa.int64()),
                    "head": pa.array([data[:4] if start == 0 else None], pa.binary()),
                    **{c: pa.array([counts[c]], pa.int64()) for c in COUNTS}})
    return run


def _utf8_share() -> Column:
    """Probability of UTF-8 against a single-byte encoding, both as likely before."""
    missed = F.col("n_expected") - F.col("n_continued")
    stray = F.col("n_faults") - missed
    odds = (F.col("n_continued") * F.lit(math.log((1 - FAULT) / CHANCE))
            + (missed + F.greatest(stray, F.lit(0))) * F.lit(math.log(FAULT / (1 - CHANCE))))
    return F.lit(1.0) / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -odds))))


def encoding_report(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, encoding, length, confidence, counts) of each file of ``files`` (path, length).

    ``encoding`` is one that decodes the whole file: ``utf-16`` (a byte order
    mark), ``utf-16-le`` / ``utf-16-be`` (NULs on one side only, for a fifth of
    the places there), ``utf-8-sig`` (a mark), ``utf-8``, ``cp1252`` (C1 bytes,
    none of them undefined) or ``latin-1``. ``confidence`` is its probability:
    a file that is UTF-8 but for a few bytes is ``latin-1`` with a confidence
    near zero. ASCII files are ``utf-8`` with confidence 1. Spark lists no empty
    files; an empty row (length 0) counts as ASCII.
    """
    if range_bytes < 1:
        raise ValueError("range_bytes must be positive")
    # Ranges are dealt over the tasks: one file's ranges are read in parallel.
    ranges = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
        .alias("start")).repartition("path", "start")
    schema = "path string, length long, head binary, " + ", ".join(f"{c} long" for c in COUNTS)
    per = ranges.mapInArrow(_count(range_bytes), schema).groupBy("path").agg(
        F.first("length").alias("length"), F.max("head").alias("head"), *[F.sum(c).alias(c) for c in COUNTS])

    def marked(mark: str) -> Column:
        return F.coalesce(F.startswith("head", F.unhex(F.lit(mark))), F.lit(False))

    places, even_length = F.col("length") / F.lit(10.0), F.col("length") % 2 == 0
    wide = F.when(even_length & (F.col("n_nul_even") == 0) & (F.col("n_nul_odd") > places), "utf-16-le").when(
        even_length & (F.col("n_nul_odd") == 0) & (F.col("n_nul_even") > places), "utf-16-be")
    valid = F.col("n_faults") == 0
    encoding = (F.when(even_length & (marked("FFFE") | marked("FEFF")), "utf-16").when(wide.isNotNull(), wide)
                .when(valid & marked("EFBBBF"), "utf-8-sig").when(valid, "utf-8")
                .when((F.col("n_c1") > 0) & (F.col("n_unused") == 0), "cp1252").otherwise("latin-1"))
    share = _utf8_share()
    # Text in UTF-16 has NULs on one side; a mark and no NUL could also be two letters of a single-byte encoding.
    sided = F.greatest("n_nul_even", "n_nul_odd") / F.greatest(F.lit(1), F.col("n_nul_even") + F.col("n_nul_odd"))
    confidence = (F.when(encoding == "utf-16", F.greatest(F.lit(0.5), sided))
                  .when(F.startswith(encoding, F.lit("utf-16")), sided)
                  .when(encoding == "utf-8-sig", 1.0)
                  .when(F.col("n_high") == 0, 1.0).when(encoding == "utf-8", share).otherwise(1.0 - share))
    return per.select("path", encoding.alias("encoding"), "length", confidence.alias("confidence"), *COUNTS)
