"""Numbers and words as compressed bytes, for shuffles of many short lists.

A Spark row costs a term its whole text and its numbers 8 bytes each. Here a
list of terms in order is stored as the first words, each once with the number
of terms it begins, and the second words; numbers take their least type.
"""

from __future__ import annotations

import ctypes
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CODEC = "zstd"


def lean(f, *args):
    """``f(*args)``, after which this Python worker gives back the memory it no longer uses.

    Workers outlive their tasks, and an executor may keep those of several stages.
    """
    try:
        return f(*args)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only glibc has it
        if trim is not None:
            trim(0)


def _least(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == np.float64 else x.astype(np.min_scalar_type(int(x.max(initial=0))))


def packed(*parts: np.ndarray) -> bytes:
    """Arrays of doubles or of numbers from 0 as bytes: by byte planes, compressed."""
    parts = [_least(x) for x in parts]
    head = b"".join(struct.pack("<BI", x.itemsize if x.dtype.kind == "u" else 0, len(x)) for x in parts)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in parts]
    data = b"".join((struct.pack("<B", len(parts)), head, *planes))
    return struct.pack("<I", len(data)) + pa.compress(data, _CODEC, asbytes=True)


def unpacked(value: bytes) -> list[np.ndarray]:
    """The arrays that ``packed`` was given, in their least types."""
    data = pa.decompress(memoryview(value)[4:], struct.unpack_from("<I", value)[0], _CODEC, asbytes=True)
    at, out = 1 + 5 * data[0], []
    for k in range(data[0]):
        wide, n = struct.unpack_from("<BI", data, 1 + 5 * k)
        kind = np.dtype(f"u{wide}" if wide else np.float64)
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def lines(words: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the words at ``at``, each with a line end, -1 for none; where each begins, and the end)."""
    words = pa.concat_arrays([words.cast(pa.large_string()), pa.array([""], pa.large_string())])
    ended = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    ended = ended.take(pa.array(np.where(at < 0, len(words) - 1, at)))
    if not len(ended):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, off, data = ended.buffers()
    off = np.frombuffer(off, dtype=np.int64)[ended.offset:ended.offset + len(ended) + 1]
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def words_of(text: np.ndarray) -> pa.Array:
    """The words of ``lines``."""
    end = np.flatnonzero(text == 10)
    off = np.append(0, end - np.arange(len(end))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(end),
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(text[text != 10]))])


def packed_terms(code: np.ndarray, words: pa.Array, bucket: np.ndarray, *values: np.ndarray):
    """(bucket, bytes) of the terms of each bucket, in order, with their values.

    ``code`` is in order: first * (len(words) + 1), for a pair plus second + 1.
    """
    order = np.argsort(bucket, kind="stable")
    code, bucket, values = code[order], bucket[order], [v[order] for v in values]
    first, second = np.divmod(code, len(words) + 1)
    other = bucket[1:] != bucket[:-1]
    start = np.flatnonzero(np.append(True, other | (first[1:] != first[:-1])))[:len(code)]
    runs = np.diff(np.append(start, len(code)))
    one, at_one = lines(words, first[start])
    two, at_two = lines(words, second - 1)
    edges = np.append(np.flatnonzero(np.append(True, other))[:len(code)], len(code))
    for i, j in zip(edges[:-1], edges[1:]):
        a, b = np.searchsorted(start, (i, j))
        yield int(bucket[i]), packed(runs[a:b], one[at_one[a]:at_one[b]], two[at_two[i]:at_two[j]],
                                     *(v[i:j] for v in values))


def terms_of(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, words, number of each one's terms) of what ``packed_terms`` gave, unpacked, one after the other.

    The codes are of the words here, and in no order.
    """
    if not parts:
        return np.zeros(0, dtype=np.int64), pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    runs, one, two = (np.concatenate(x) for x in zip(*(p[:3] for p in parts)))
    words = pa.concat_arrays([words_of(one), words_of(two), pa.array([""], pa.large_string())]).dictionary_encode()
    at, words = words.indices.to_numpy().astype(np.int64), words.dictionary
    first, second, none = np.repeat(at[:len(runs)], runs), at[len(runs):-1], at[-1]
    code = first * (len(words) + 1) + np.where(second == none, 0, second + 1)
    return code, words.cast(pa.string()), np.array([int(p[0].sum(dtype=np.int64)) for p in parts])


def numbers_of(parts: list[list[np.ndarray]], k: int) -> np.ndarray:
    """The k-th values of the terms of ``terms_of``."""
    return np.concatenate([np.zeros(0), *(p[3 + k] for p in parts)])
