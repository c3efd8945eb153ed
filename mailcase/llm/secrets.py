"""Secret scan with structural confirmation.

Candidates are found by pattern in the UTF-8 bytes (a case-insensitive
keyword search first, so clean texts cost a few fast substring scans). Then
strings that look like base64 or hex are decoded and parsed: a signed token
needs a JSON header that names its algorithm, an encoded key needs a DER
sequence whose nested lengths fit, or an SSH key file whose fields do. Confirmed
structures add spans of kinds ``jwt``, ``der`` and ``pem``; the pattern matches stay.
An encoded key may be glued to a name ("key=MII...") or wrapped in lines, hex may have
either case, and a PEM body escaped line ends and header lines.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailcase.llm.wordhash import pieces

# Fixed patterns; on bytes, re.IGNORECASE folds ASCII letters only.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    rb"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: Base kinds in their order, then the confirmed ones.
KINDS = ("assign", "access", "hex", "jwt", "der", "pem")

#: How the base64 of "{" begins before a quote, a space or a line end.
JSON_STARTS = (b"eyA", b"eyI", b"eyJ", b"eyL", b"ewk", b"ewo", b"ew0")
# A token starts where a run of its characters does, which keeps the scan linear.
JWT = re.compile(rb"(?<![A-Za-z0-9_-])(?:" + b"|".join(JSON_STARTS) + rb")[A-Za-z0-9_-]{5,}+\."
                 rb"[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+")
PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]{1,60})-----((?:(?!-----).)*+)-----END \1-----", re.DOTALL)
#: Line ends in a PEM body (escaped ones too), header lines, and that of an encrypted body.
PEM_END = re.compile(rb"(?:\\r|\\n|[\r\n])+")
PEM_HEADER = re.compile(rb"\s*[A-Za-z][A-Za-z0-9-]*:")
PEM_CIPHER = re.compile(rb"DEK-Info:\s*[A-Z0-9-]+,[0-9A-Fa-f]{16,}")
#: A line end inside wrapped base64, with the indent of the next line.
WRAP = re.compile(rb"[\x20\t]*(?:\r?\n|\\r\\n|\\n)[\x20\t]*")
CHAIN = re.compile(rb"[A-Za-z0-9+/_-]++(?:" + WRAP.pattern + rb"[A-Za-z0-9+/_-]++)*+")
#: How the base64 and the hex of a sequence tag and its length begin.
DER_B64 = re.compile(rb"M(?:[A-H]|I[E-T])")
DER_HEX = re.compile(rb"(?=30(?:[0-7]|8[1-4]))")
SSH_MAGIC = b"openssh-key-v1\0"
MIN_ENCODED = 40
MAX_DEPTH = 8
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
HEX_RUN = re.compile(rb"[0-9A-Fa-f]{80,}+")
_B64 = np.zeros(256, dtype=bool)
_B64[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-")] = True


def _runs(marks: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` marked bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    s, e = edge[::2], edge[1::2]
    ok = e - s >= least
    return list(zip(s[ok].tolist(), e[ok].tolist()))


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """(tag, content start, content end) of the element at ``at``; ValueError if it doesn't fit."""
    if at + 2 > end:
        raise ValueError("no room for a length")
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            raise ValueError("length of a length")
        n, at = int.from_bytes(data[at:at + k], "big"), at + k
    if at + n > end:
        raise ValueError("longer than its parent")
    return tag, at, at + n


def _holds_key(data: bytes, at: int, end: int, depth: int) -> bool:
    """Whether the members of a sequence, all of which must fit, include an
    integer, bit string, octet string or object identifier at any depth."""
    found = False
    while at < end:
        tag, lo, hi = _element(data, at, end)
        if tag == 0x30 and depth < MAX_DEPTH:
            found |= _holds_key(data, lo, hi, depth + 1)
        found |= tag in (0x02, 0x03, 0x04, 0x06)
        at = hi
    return found


def der_ok(data: bytes) -> bool:
    """A DER sequence that fills ``data``, nested lengths included, like an encoded key."""
    try:
        tag, lo, hi = _element(data, 0, len(data))
        return tag == 0x30 and hi == len(data) and _holds_key(data, lo, hi, 1)
    except ValueError:
        return False


def ssh_ok(data: bytes) -> bool:
    """An SSH private key file: after its magic the cipher, the key derivation
    and its options, a number of public keys, each starting with the name of
    its type, and the private part, all as lengths with contents that fit."""
    at = len(SSH_MAGIC)

    def field(src: bytes, at: int) -> tuple[bytes, int]:
        end = at + 4 + int.from_bytes(src[at:at + 4], "big")
        if at + 4 > len(src) or end > len(src):
            raise ValueError("longer than its parent")
        return src[at + 4:end], end

    if not data.startswith(SSH_MAGIC):
        return False
    try:
        for _ in range(3):
            _, at = field(data, at)
        n, at = int.from_bytes(data[at:at + 4], "big"), at + 4
        for _ in range(n):
            public, at = field(data, at)
            if not field(public, 0)[0]:
                return False
        private, at = field(data, at)
        return n > 0 and len(private) > 0
    except ValueError:
        return False


def _b64(s: bytes) -> bytes | None:
    s = s.replace(b"-", b"+").replace(b"_", b"/").rstrip(b"=")
    try:
        return base64.b64decode(s + b"=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def jwt_ok(header: bytes) -> bool:
    """The first part of a signed token: a JSON object that names an algorithm."""
    raw = _b64(header)
    if not raw or raw[:1] != b"{":
        return False
    try:
        h = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(h, dict) and isinstance(h.get("alg"), str)


def _der_size(head: bytes) -> int:
    """Bytes of a sequence, tag and length included, by its first six; 0 if it is none."""
    n, k = head[1], head[1] & 0x7F
    if head[0] != 0x30 or n == 0x80 or (n > 0x80 and k > 4):
        return 0
    return 2 + n if n < 0x80 else 2 + k + int.from_bytes(head[2:2 + k], "big")


def _der_base64(raw: bytes):
    """(start, end) of encoded keys in base64, wherever in a run they start; lines
    that follow each other are read as one, and a key ends where a line or run does."""
    for m in CHAIN.finditer(raw):
        if m.end() - m.start() < MIN_ENCODED or not DER_B64.search(raw, m.start(), m.end()):
            continue
        begins, ends, parts = [], [], []   # of each line: place in raw, end in the joined text
        at, total = m.start(), 0
        for w in [*WRAP.finditer(raw, m.start(), m.end()), None]:
            stop = w.start() if w else m.end()
            parts.append(raw[at:stop])
            total += stop - at
            begins.append(at)
            ends.append(total)
            at = w.end() if w else stop
        joined = b"".join(parts)

        for d in DER_B64.finditer(joined):
            head = _b64(joined[d.start():d.start() + 8])
            size = _der_size(head) if head and len(head) == 6 else 0
            need = -(-4 * size // 3)
            stop = d.start() + need
            k = bisect_left(ends, stop)
            if need < MIN_ENCODED - 2 or k == len(ends) or ends[k] != stop:
                continue
            data = _b64(joined[d.start():stop])
            if data and der_ok(data):
                first = bisect_right(ends, d.start())
                start = begins[first] + d.start() - (ends[first] - len(parts[first]))
                end = begins[k] + len(parts[k])
                end += len(raw[end:end + 2]) - len(raw[end:end + 2].lstrip(b"="))
                if end - start >= MIN_ENCODED:
                    yield start, end


def _der_hex(raw: bytes):
    """(start, end) of encoded keys in hex of either case that end with their run."""
    for m in HEX_RUN.finditer(raw):
        for d in DER_HEX.finditer(raw, m.start(), m.end() - 2 * MIN_ENCODED + 1):
            head = bytes.fromhex(raw[d.start():d.start() + 12].decode())
            if d.start() + 2 * _der_size(head) == m.end() and der_ok(
                    bytes.fromhex(raw[d.start():m.end()].decode())):
                yield d.start(), m.end()


def _pem_ok(body: bytes) -> bool:
    """Whether a PEM body, without header lines, is an encoded, SSH or enciphered key."""
    lines, more = [], False
    for line in PEM_END.split(body):
        if PEM_HEADER.match(line) or more:
            more = line.rstrip().endswith((b",", b"\\"))
        else:
            lines.append(line)
    data = _b64(re.sub(rb"\s", b"", b"".join(lines)).replace(b"\\/", b"/"))
    if not data:
        return False
    return der_ok(data) or ssh_ok(data) or (
        PEM_CIPHER.search(body) is not None and len(data) >= 16 and len(data) % 8 == 0)


def scan(raw: bytes, low: bytes, marks_hex: np.ndarray, marks_b64: np.ndarray
         ) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes of all spans of one text; ``low`` is
    the text with A-Z lower-cased."""
    spans = []
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw)
                  if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw)
                  if m.end() - m.start() >= MIN_ACCESS]
    spans += [(s, 2, e) for s, e in _runs(marks_hex, MIN_HEX)]
    spans += [(s, 4, e) for s, e in _der_hex(raw)]
    if any(w in raw for w in JSON_STARTS):
        spans += [(m.start(), 3, m.end()) for m in JWT.finditer(raw)
                  if jwt_ok(m.group().split(b".", 1)[0])]
    for s, e in _runs(marks_b64, MIN_ENCODED):
        if raw[s:s + 1] == b"M":           # base64 of a sequence tag
            data = _b64(raw[s:e])
            if data and der_ok(data):
                spans.append((s, 4, e))
    if DER_B64.search(raw):
        spans += [(s, 4, e) for s, e in _der_base64(raw)]
    if b"-----BEGIN " in raw:
        spans += [(m.start(), 5, m.end()) for m in PEM.finditer(raw) if _pem_ok(m.group(2))]
    return sorted(set(spans))


def _scan_batches(batches):
    for b in batches:
        rows = []
        for i, j, buf, off in pieces(b.column("text")):
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                part = buf[lo:hi]
                raw = part.tobytes()
                found = scan(raw, raw.lower(), _HEX[part], _B64[part])
                if found and not raw.isascii():
                    # Byte places to code points: skip continuation bytes.
                    point = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80))).tolist()
                    found = [(point[s], k, point[e]) for s, k, e in found]
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found])
        yield pa.RecordBatch.from_pydict({
            "doc": b.column("doc"), "spans": pa.array(rows, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))})


def secret_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of every row: array of (kind, start, end) in code points, end
    exclusive, by start and then kind in the order of ``KINDS``.

    A span is a whole match. Null and empty texts have none; rows are scanned
    one by one, so repeated rows and keys, null keys, extra columns and empty
    tables need no rule. Nothing is shuffled.
    """
    src = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                      T.StructField("start", T.IntegerType()),
                                      T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField("doc", src.schema["doc"].dataType),
                           T.StructField("spans", spans)])
    return src.mapInArrow(_scan_batches, schema).withColumnRenamed("doc", key)
