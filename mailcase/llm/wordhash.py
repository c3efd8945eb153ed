"""Vectorised words and word hashes of Arrow text columns (runs inside Spark tasks).

A text column is handled in pieces of about ``PIECE`` bytes, so the working
arrays of a task stay a few MB whatever the batch size; one document is never
cut. Words are maximal runs of the bytes a 256-entry table marks, which is
exact for UTF-8 because every byte of a non-ASCII character is above 0x7F.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
#: Bytes hashed at a time: each takes 8 in three arrays and in the tables of powers.
SPAN = 1 << 17

_U = np.uint64


def byte_table(kept: Iterator[int]) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(kept)] = True
    return t


#: Words between ASCII white space: [^\x20\x09-\x0D]+
NON_SPACE = byte_table(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: ASCII letters and digits, and every non-ASCII character.
ALNUM = byte_table(b for b in range(256) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A
                   or 0x61 <= b <= 0x7A or b >= 0x80)
#: Byte -> byte, A-Z to a-z only.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    p = _powers.get(name)
    if p is None or len(p) < n:
        size = max(1 << 16, 1 << (int(n) - 1).bit_length())
        p = np.ones(size, dtype=_U)
        p[1:] = _U(base)
        np.multiply.accumulate(p, out=p)
        _powers[name] = p
    return p[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 limit: int = PIECE) -> np.ndarray:
    """Hash of values[s:e] for each sorted range; ranges go in groups that
    span at most ``limit`` values (or one range), so memory stays bounded."""
    out = np.empty(len(starts), dtype=_U)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + limit, "right")))
        hi = int(ends[i:j].max())
        c = np.zeros(hi - lo + 1, dtype=_U)
        np.cumsum(values[lo:hi] * _power("b", _BASE, hi - lo), out=c[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (c[e] - c[s]) * _power("i", _BASE_INV, hi - lo + 1)[s]
        i = j
    return mix(out + (ends - starts).astype(_U))


def byte_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                fold: np.ndarray | None = None) -> np.ndarray:
    """Hash of buf[s:e] for each of sorted ranges that do not overlap; about ``SPAN`` bytes
    (or one range) at a time, so the 8-byte values of a whole piece are never held."""
    values = _BYTE_VALUES if fold is None else _BYTE_VALUES[fold]
    out = np.empty(len(starts), dtype=_U)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + SPAN, "right")))
        hi = int(ends[j - 1])
        out[i:j] = range_hashes(values[buf[lo:hi]], starts[i:j] - lo, ends[i:j] - lo, hi - lo)
        i = j
    return out


class Words:
    """The words of a run of documents.

    ``table`` gives each byte a class, 0 outside words; a word is a maximal
    run of one class inside a document. ``starts``/``ends``: byte ranges in
    ``buf``; ``first``: index of each document's first word (one entry more
    than documents).
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf, self.offsets = buf, offsets
        lo, hi = int(offsets[0]), int(offsets[-1])
        m = np.zeros(hi - lo + 2, dtype=np.uint8)
        m[1:-1] = table.view(np.uint8)[buf[lo:hi]]
        own = m[1:-1] != 0
        cut = offsets[1:-1] - lo          # a document's first byte begins a word
        cut = cut[cut < hi - lo]
        begin = own & (m[1:-1] != m[:-2])
        begin[cut] = own[cut]
        last = own & (m[1:-1] != m[2:])
        before = cut[cut > 0] - 1
        last[before] = own[before]
        self.starts = np.flatnonzero(begin) + lo
        self.ends = np.flatnonzero(last) + lo + 1
        self.first = np.searchsorted(self.starts, offsets, "left")

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, fold: np.ndarray | None = None) -> np.ndarray:
        return byte_hashes(self.buf, self.starts, self.ends, fold)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def doc_end(self) -> np.ndarray:
        """For each word, the index after its document's last word."""
        return np.repeat(self.first[1:], self.counts)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is an empty text."""
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else \
        np.zeros(0, dtype=np.uint8)
    return buf, offsets


def pieces(col: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of these rows) in runs of about ``size`` bytes."""
    if not len(col):
        return
    buf, off = text_buffers(col)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, buf, off[i:j + 1]
        i = j


def gram_hashes(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of h[i:i+n] for each i; len(h) - n + 1 entries (none if shorter)."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=_U)
    mult = _U((0xD6E8FEB86659FD93 + 2 * 0x9E3779B97F4A7C15 * salt) % (1 << 64) | 1)
    acc = h[:size].copy()
    for j in range(1, n):
        acc *= mult
        acc += h[j:j + size]
    return mix(acc)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as Spark's signed longs (same bits)."""
    return x.view(np.int64)
