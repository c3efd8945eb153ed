"""Cross-tokenizer alignment: two tokenizations of a text, cut where both end a token.

1. A text with a leading space is encoded by a byte-level BPE (A) and by a
   piece model (B, which adds the space itself). Byte offsets where tokens of
   both end cut the tokens into groups. Tokens of A and B whose byte ranges
   overlap are linked: between two neighbouring ends of either there is exactly
   one token of each, so the links are the segments between all ends.
2. Fragments form a monoid. A byte range of a text yields the tokens that end
   in it: an open prefix up to the first common end, closed groups, and an open
   suffix behind the last one. Joining two neighbours closes one group, of the
   left one's suffix and the right one's prefix; a fragment without a common
   end only lengthens its neighbour. Joining is associative.
3. Texts of more than ``CHUNK`` bytes are cut into byte ranges, which any task
   may encode: a range is read from the space before it to the space after it
   where both tokenizers surely begin a new token, and keeps the tokens that
   end inside. Closed groups stay where they are; the open ends are joined in
   a tree, ``FAN`` neighbours at a time, and the pieces of a text are put in
   order by their byte offset. Shorter texts are one range, done in one batch.
4. A pair's count is the number of documents that hold it linked. Documents
   are stored with their distinct pairs and the number of their links. The
   most frequent pairs, at most ``HOT`` of them, go to every task; the others,
   which are rare, so no key of theirs is hot, are joined.

Rules: texts that are null, empty, or not given back byte by byte by both
tokenizers have no tokens: all counts are 0 and the group text is ''. Every
row is a document, equal rows too. Empty tables give an empty result. Special
tokens are never produced; their strings are plain text. The vocabulary files
are parameters; the driver reads them (2 MB) and sends them to the tasks.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mailcase.llm.tables import stored

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: GPT-2's published split pattern, which belongs to the byte-level vocabulary (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Bytes of a range of a long text, fragments joined at a time, pairs sent to every task.
CHUNK, FAN, HOT = 1 << 16, 16, 1 << 20
#: Bytes of texts aligned together.
BATCH = 1 << 20

_I = np.int64


# --- tokenizers ---------------------------------------------------------------------------

class Codec:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, vocabulary: bytes, model: bytes, pattern: str = PATTERN):
        import sentencepiece
        import tiktoken

        spec = json.loads(vocabulary)
        special = {t["content"] for t in spec["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]   # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = [b""] * (1 + max(ranks.values()))
        for t, i in ranks.items():
            self.bytes_a[i] = t
        n = self.b.get_piece_size()
        self.bytes_b = [b"" if self.b.is_unknown(i) or self.b.is_control(i)
                        else bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in
                        enumerate(self.b.id_to_piece(list(range(n))))]
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=_I)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=_I)
        most = max(len(self.bytes_a), n)
        #: Token number with what follows it: a comma, a bar, a semicolon, nothing.
        self.shown = [f"{i}{s}" for s in (",", "|", ";", "") for i in range(most)]
        self.most = most
        self.base = n

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; empty ones where the bytes are not given back."""
        out = []
        for t, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = self.a.encode_ordinary(" " + t)
            want = b" " + t.encode()
            if b"".join([self.bytes_a[i] for i in a]) != want or b"".join([self.bytes_b[i] for i in b]) != want:
                a, b = [], []
            out.append((np.array(a, dtype=_I), np.array(b, dtype=_I)))
        return out


_codecs: dict[bytes, Codec] = {}


def codec_of(sent) -> Codec:
    """The codec of a broadcast (vocabulary, model), built once per worker."""
    vocabulary, model = sent.value
    key = hashlib.sha256(vocabulary + model).digest()
    if key not in _codecs:
        _codecs[key] = Codec(vocabulary, model)
    return _codecs[key]


# --- alignment of closed token runs -------------------------------------------------------

class Aligned:
    """Groups and links of runs of tokens that end at a common offset.

    ``a``/``b``: token numbers of all runs; ``end_a``/``end_b``: their byte
    offsets, rising over all runs; ``bounds``: the last offset of each run.
    """

    def __init__(self, codec: Codec, a, end_a, b, end_b, bounds):
        self.codec, self.n = codec, len(bounds)
        self.a, self.b = a, b
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
        ia, ib = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        self.pair = a[ia] * codec.base + b[ib]
        self.run = np.searchsorted(bounds, ends)             # run of each link
        common = (end_a[ia] == ends) & (end_b[ib] == ends)
        self.cut = ends[common]
        self.cut_run = self.run[common]
        self.end_a, self.end_b, self.bounds = end_a, end_b, bounds

    def counts(self) -> dict[str, np.ndarray]:
        of = lambda x: np.bincount(np.searchsorted(self.bounds, x), minlength=self.n)
        return {"n_a": of(self.end_a), "n_b": of(self.end_b),
                "n_groups": np.bincount(self.cut_run, minlength=self.n),
                "n_links": np.bincount(self.run, minlength=self.n)}

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(run, pair, links) of the distinct pairs of each run."""
        if not len(self.pair):
            return self.run, self.pair, self.run
        order = np.lexsort((self.pair, self.run))
        run, pair = self.run[order], self.pair[order]
        first = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (pair[1:] != pair[:-1])))
        return run[first], pair[first], np.diff(np.append(first, len(run)))

    def groups(self) -> list[str]:
        """Each run's groups, `a1,a2|b1;a3|b2`."""
        ga, gb = np.searchsorted(self.cut, self.end_a), np.searchsorted(self.cut, self.end_b)
        last_a = np.append(ga[1:] != ga[:-1], True)
        last_b = np.append(gb[1:] != gb[:-1], True)
        final = np.isin(self.end_b, self.bounds)             # nothing follows the last token of a run
        most = self.codec.most
        show_a = self.a + most * last_a
        show_b = self.b + most * np.where(final, 3, 2 * last_b)
        at_a = np.arange(len(ga)) + np.searchsorted(gb, ga)              # after the B tokens of earlier groups
        at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")     # after the A tokens of its group
        both = np.empty(len(ga) + len(gb), dtype=_I)
        both[at_a], both[at_b] = show_a, show_b
        counts = self.counts()
        edges = np.cumsum(counts["n_a"] + counts["n_b"]).tolist()
        shown, ids, out, i = self.codec.shown, both.tolist(), [], 0
        for j in edges:
            out.append("".join([shown[x] for x in ids[i:j]]))
            i = j
        return out


def _runs(codec: Codec, encoded) -> Aligned:
    """Whole texts as runs, one behind the other."""
    a = np.concatenate([x for x, _ in encoded]) if encoded else np.zeros(0, dtype=_I)
    b = np.concatenate([y for _, y in encoded]) if encoded else np.zeros(0, dtype=_I)
    end_a, end_b = np.cumsum(codec.size_a[a]), np.cumsum(codec.size_b[b])
    # A text without tokens takes one offset more, so that its bound is its own.
    gaps = np.cumsum([not len(x) for x, _ in encoded]).astype(_I)
    shift_a = np.repeat(gaps, [len(x) for x, _ in encoded])
    shift_b = np.repeat(gaps, [len(y) for _, y in encoded])
    bounds = np.cumsum([int(codec.size_a[x].sum()) for x, _ in encoded]).astype(_I) + gaps
    return Aligned(codec, a, end_a + shift_a, b, end_b + shift_b, bounds)


# --- fragments ----------------------------------------------------------------------------

#: Open ends of a byte range: tokens and byte offsets of the prefix and the suffix, whether a
#: common end lies between them (then ``last`` is the last one), and whether all bytes came back.
OPEN = ("pre_a", "pre_ea", "pre_b", "pre_eb", "suf_a", "suf_ea", "suf_b", "suf_eb")


def fragment(a, end_a, b, end_b, ok: bool = True) -> tuple[dict, tuple | None]:
    """(open ends, closed tokens or None) of the tokens that end in one byte range."""
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    none = np.zeros(0, dtype=_I)
    if not len(common):
        return dict(zip(OPEN, (a, end_a, b, end_b, none, none, none, none)), cut=False, last=-1, ok=ok), None
    first, last = common[0], common[-1]
    fa, la = (np.searchsorted(end_a, x, "right") for x in (first, last))
    fb, lb = (np.searchsorted(end_b, x, "right") for x in (first, last))
    open_ = dict(zip(OPEN, (a[:fa], end_a[:fa], b[:fb], end_b[:fb], a[la:], end_a[la:], b[lb:], end_b[lb:])),
                 cut=True, last=int(last), ok=ok)
    return open_, (a[fa:la], end_a[fa:la], b[fb:lb], end_b[fb:lb], int(first))


def compose(f: dict, g: dict) -> tuple[dict, tuple | None]:
    """(fragment of both, the group closed between them or None): associative."""
    def both(x, y):
        return {k: np.concatenate([f[f"{x}_{k}"], g[f"{y}_{k}"]]) for k in ("a", "ea", "b", "eb")}

    ok = f["ok"] and g["ok"]
    if not f["cut"]:
        out = {f"pre_{k}": v for k, v in both("pre", "pre").items()}
        out |= {f"suf_{k}": g[f"suf_{k}"] for k in ("a", "ea", "b", "eb")}
        return out | {"cut": g["cut"], "last": g["last"], "ok": ok}, None
    middle = both("suf", "pre")
    out = {f"pre_{k}": f[f"pre_{k}"] for k in ("a", "ea", "b", "eb")}
    if not g["cut"]:
        return out | {f"suf_{k}": v for k, v in middle.items()} | {"cut": True, "last": f["last"], "ok": ok}, None
    out |= {f"suf_{k}": g[f"suf_{k}"] for k in ("a", "ea", "b", "eb")}
    return out | {"cut": True, "last": g["last"], "ok": ok}, \
        (middle["a"], middle["ea"], middle["b"], middle["eb"], f["last"])


def safe_cuts(text: np.ndarray) -> np.ndarray:
    """Offsets of spaces between two printable ASCII characters: both tokenizers begin a token there.

    The byte-level split never joins a printable character and a space behind
    it, and takes the space with what follows; no piece holds a space behind
    another character.
    """
    word = (text > 0x20) & (text < 0x7F)
    return np.flatnonzero((text[1:-1] == 0x20) & word[:-2] & word[2:]) + 1 if len(text) > 2 else \
        np.zeros(0, dtype=_I)


def ranges(full: bytes, chunk: int) -> list[tuple[int, int, int, int]]:
    """(from, to, lo, hi): the range lo..hi of ``full`` is read from ``from`` to ``to``.

    A range ends ``chunk`` bytes after the last one, or, where no safe cut
    follows within a further ``chunk``, at the next safe cut.
    """
    cuts = np.concatenate([[0], safe_cuts(np.frombuffer(full, dtype=np.uint8)), [len(full)]])
    out, lo = [], 0
    while lo < len(full):
        hi = min(lo + chunk, len(full))
        to = int(cuts[np.searchsorted(cuts, hi)])
        if to - hi > chunk:
            hi = to
        out.append((int(cuts[np.searchsorted(cuts, lo, "right") - 1]), to, lo, hi))
        lo = hi
    return out


# --- Spark --------------------------------------------------------------------------------

_SUMS = ("n_a", "n_b", "n_groups", "n_links")
_DOC = "doc_id long, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups string, pairs array<long>, links array<int>"
_OPEN_SQL = ", ".join(f"{c} array<long>" for c in OPEN)
_PIECE = "doc_id long, uid long, at long, ok boolean, " + ", ".join(f"{c} long" for c in _SUMS) + \
    ", groups string, pairs array<long>, links array<int>"
_FRAGMENT = f"{_PIECE}, k int, {_OPEN_SQL}, cut boolean, last long"


def _lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


def _digest(groups: list[str], whole: bool) -> list[str]:
    if whole:
        return groups
    return [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]


def _short(sent, whole: bool):
    def align(batches):
        codec = codec_of(sent)
        for b in batches:
            texts, i = [t or "" for t in b.column(1).to_pylist()], 0
            while i < len(texts):
                j, held = i, 0
                while j < len(texts) and (j == i or held < BATCH):
                    held += len(texts[j])
                    j += 1
                encoded = codec.encode(texts[i:j])
                none = np.zeros(0, dtype=_I)
                encoded = [e if t else (none, none) for t, e in zip(texts[i:j], encoded)]
                runs = _runs(codec, encoded)
                run, pair, n = runs.pairs()
                per = np.bincount(run, minlength=j - i)
                sums = runs.counts()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), *[pa.array(sums[c].astype(_I)) for c in _SUMS],
                     pa.array(_digest(runs.groups(), whole), pa.string()),
                     _lists(pair, per, pa.int64()), _lists(n, per, pa.int32())],
                    ["doc_id", *_SUMS, "groups", "pairs", "links"])
                i = j
    return align


def _cut(chunk: int):
    """Ranges of long texts: (doc_id, uid, k, start, lo, hi, text); ``uid`` names a row, once stored."""
    def cut(batches):
        rng = np.random.default_rng()
        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                full = b" " + text.as_py().encode()
                uid = int(rng.integers(0, 1 << 63))
                for k, (start, to, lo, hi) in enumerate(ranges(full, chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.int64()), pa.array([uid], pa.int64()), pa.array([k], pa.int32()),
                         *[pa.array([x], pa.int64()) for x in (start, lo, hi)],
                         pa.array([full[start + 1:to].decode()], pa.string())],
                        ["doc_id", "uid", "k", "start", "lo", "hi", "text"])
    return cut


def _piece(codec: Codec, doc_id, uid, ok, closed) -> dict:
    """Row of closed tokens (a, end_a, b, end_b, offset they begin at); no tokens: an empty row."""
    row = {"doc_id": doc_id, "uid": uid, "at": -1, "ok": ok, **dict.fromkeys(_SUMS, 0), "groups": "",
           "pairs": [], "links": []}
    if closed is None or not len(closed[0]):
        return row
    a, end_a, b, end_b, at = closed
    runs = Aligned(codec, a, end_a, b, end_b, end_a[-1:])
    _, pair, n = runs.pairs()
    return row | {"at": at, **{c: int(v[0]) for c, v in runs.counts().items()}, "groups": runs.groups()[0],
                  "pairs": pair, "links": n}


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _fragments(sent, schema):
    """Each range's row: its closed groups, and its open ends."""
    def encode(batches):
        codec = codec_of(sent)
        for b in batches:
            for r in b.to_pylist():
                a, t = codec.encode([r["text"]])[0]
                end_a = r["start"] + np.cumsum(codec.size_a[a])
                end_t = r["start"] + np.cumsum(codec.size_b[t])
                ok = len(a) > 0
                ina, int_ = ((e > r["lo"]) & (e <= r["hi"]) for e in (end_a, end_t))
                open_, closed = fragment(a[ina], end_a[ina], t[int_], end_t[int_], ok)
                yield _rows([_piece(codec, r["doc_id"], r["uid"], ok, closed) | open_ | {"k": r["k"]}], schema)
    return encode


def _joined(sent, schema, fan: int):
    """Joins the fragments of ``fan`` neighbours, in order; a closed group is a row without ``k``."""
    def join(batches):
        codec = codec_of(sent)
        held = None
        for b in batches:
            for r in b.to_pylist():
                r |= {c: np.array(r[c], dtype=_I) for c in OPEN}
                group = (r["uid"], r["k"] // fan)
                if held is not None and held[0] == group:
                    f, closed = compose(held[1], r)
                    held = (group, f, r["doc_id"])
                    if closed is not None:
                        yield _rows([_piece(codec, r["doc_id"], r["uid"], True, closed)], schema)
                    continue
                if held is not None:
                    yield _rows([_piece(codec, held[2], held[0][0], held[1]["ok"], None) | held[1] | {"k": held[0][1]}], schema)
                held = (group, {c: r[c] for c in (*OPEN, "cut", "last", "ok")}, r["doc_id"])
        if held is not None:
            yield _rows([_piece(codec, held[2], held[0][0], held[1]["ok"], None) | held[1] | {"k": held[0][1]}], schema)
    return join


def _roots(sent, schema):
    """The first group of a text: what is left open at the root, which ends at a common end."""
    def close(batches):
        codec = codec_of(sent)
        for b in batches:
            for r in b.to_pylist():
                tokens = [np.array(r[c], dtype=_I) for c in OPEN[:4]]
                whole = r["ok"] and r["cut"] and not r["suf_a"] and not r["suf_b"]
                yield _rows([_piece(codec, r["doc_id"], r["uid"], whole, (*tokens, 0) if whole else None)], schema)
    return close


def _ordered(schema, whole: bool):
    """One row per text of its pieces, read in the order of their offsets."""
    def finish(uid, key, ok, sums, digest, texts, pairs):
        if not ok:
            return {"doc_id": key, **dict.fromkeys(_SUMS, 0), "groups": "", "pairs": [], "links": []}
        pair, at = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True)
        links = np.bincount(at, weights=np.concatenate([n for _, n in pairs])).astype(np.int32)
        return {"doc_id": key, **sums, "groups": ";".join(texts) if whole else digest.hexdigest(),
                "pairs": pair, "links": links}

    def order(batches):
        held = None
        for b in batches:
            for r in b.to_pylist():
                if held is None or held[0] != r["uid"]:
                    if held is not None:
                        yield _rows([finish(*held)], schema)
                    held = [r["uid"], r["doc_id"], True, dict.fromkeys(_SUMS, 0), hashlib.sha256(), [],
                            [(np.zeros(0, dtype=_I), np.zeros(0, dtype=_I))]]
                held[2] = held[2] and r["ok"]
                if not r["groups"]:
                    continue
                if held[3]["n_groups"]:
                    held[4].update(b";")
                held[4].update(r["groups"].encode())
                if whole:
                    held[5].append(r["groups"])
                held[3] = {c: held[3][c] + r[c] for c in _SUMS}
                pairs, links = held[6][0]
                if len(held[6]) == 64:                       # distinct pairs only, now and then
                    pair, at = np.unique(np.concatenate([p for p, _ in held[6]]), return_inverse=True)
                    held[6] = [(pair, np.bincount(at, weights=np.concatenate([n for _, n in held[6]])).astype(_I))]
                held[6].append((np.array(r["pairs"], dtype=_I), np.array(r["links"], dtype=_I)))
        if held is not None:
            yield _rows([finish(*held)], schema)
    return order


def _long(docs: DataFrame, sent, chunk: int, fan: int, whole: bool) -> DataFrame | None:
    """Rows of the texts of more than ``chunk`` bytes, by fragments; None if there are none."""
    parts = stored(docs.mapInArrow(_cut(chunk), "doc_id long, uid long, k int, start long, lo long, hi long, text string"),
                   "ranges")
    most = parts.agg(F.max("k")).first()[0]
    if most is None:
        return None
    as_fragment, as_piece, as_doc = (_arrow(x) for x in (_FRAGMENT, _PIECE, _DOC))
    piece = [f.name for f in as_piece]
    now = stored(parts.repartition("uid", "k").mapInArrow(_fragments(sent, as_fragment), _FRAGMENT), "fragments")
    pieces = [now.select(*piece)]
    while most > 0:
        dealt = now.where("k IS NOT NULL").withColumn("_g", F.expr(f"k DIV {fan}")).repartition("uid", "_g").drop("_g")
        now = stored(dealt.sortWithinPartitions("uid", "k").mapInArrow(
            _joined(sent, as_fragment, fan), _FRAGMENT), "fragments")
        pieces.append(now.where("k IS NULL").select(*piece))
        most //= fan
    pieces.append(now.where("k IS NOT NULL").mapInArrow(_roots(sent, as_piece), _PIECE))
    return reduce(DataFrame.unionByName, pieces).repartition("uid").sortWithinPartitions("uid", "at").mapInArrow(
        _ordered(as_doc, whole), _DOC)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", *, vocabulary: str = BYTE_VOCABULARY,
          model: str = PIECE_MODEL, chunk: int = CHUNK, fan: int = FAN, whole: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, links): one row per row of ``docs``.

    ``pairs`` are the distinct linked pairs (A id times the number of B ids,
    plus B id) and ``links`` their numbers of links. ``groups`` is the text of
    the groups, or its SHA-256 in hex unless ``whole``; '' without tokens.
    """
    with open(vocabulary, "rb") as f, open(model, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    out = source.where(size <= chunk).mapInArrow(_short(sent, whole), _DOC)
    rest = _long(source.where(size > chunk), sent, chunk, fan, whole)
    return out if rest is None else out.unionByName(rest)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether no pair of its A id has more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("n")), "pair_counts").withColumn("_a", F.expr(f"pair DIV {n_b}"))
    most = counts.groupBy("_a").agg(F.max("n").alias("_most")).withColumnRenamed("_a", "_of")
    # One row per A id: at most the size of the vocabulary.
    return counts.join(F.broadcast(most), counts["_a"] == most["_of"]).select(
        "pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def _looked_up(sent, names):
    """Sums over the links of the pairs sent to every task; the other pairs are passed on."""
    def look(batches):
        pair, n, best = sent.value
        for b in batches:
            at = b.schema.get_field_index
            lists = b.column(at("pairs"))
            sizes = np.diff(lists.offsets.to_numpy())
            mine = lists.flatten().to_numpy()
            links = b.column(at("links")).flatten().to_numpy().astype(_I)
            row = np.repeat(np.arange(b.num_rows), sizes)
            where = np.minimum(np.searchsorted(pair, mine), max(0, len(pair) - 1))
            hit = pair[where] == mine if len(pair) else np.zeros(len(mine), dtype=bool)
            total, top = np.zeros(b.num_rows, dtype=_I), np.zeros(b.num_rows, dtype=_I)
            np.add.at(total, row[hit], links[hit] * n[where[hit]])
            np.add.at(top, row[hit], links[hit] * best[where[hit]])
            left = np.bincount(row[~hit], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(at(c)) for c in names], pa.array(top), pa.array(total),
                 _lists(mine[~hit], left, pa.int64()), _lists(links[~hit], left, pa.int32())],
                [*names, "n_best", "count_sum", "pairs", "links"])
    return look


def alignment_scores(docs: DataFrame, *, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL,
                     chunk: int = CHUNK, fan: int = FAN, hot: int = HOT, whole: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): one row per row of ``docs``.

    ``count_sum``: sum of the pairs' counts over all links; ``n_best``: links
    whose count is the highest of their A id, ties included.
    """
    import sentencepiece

    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()
    aligned = stored(align(docs, vocabulary=vocabulary, model=model, chunk=chunk, fan=fan, whole=whole).withColumn(
        "row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(aligned, n_b), "pairs")
    # Pairs by the bit length of their count: the lowest count of which all pairs still fit into ``hot``.
    sizes = {r["b"]: r["c"] for r in counts.groupBy(F.length(F.bin("n")).alias("b")).agg(
        F.count("*").alias("c")).collect()}
    least, total = 64, 0
    for b in range(63, 0, -1):
        total += sizes.get(b, 0)
        if total > hot:
            break
        least = b
    floor = 1 << (least - 1)
    sent = counts.where(F.col("n") >= floor).orderBy("pair").toArrow()
    table = tuple(sent.column(c).to_numpy().astype(_I) for c in ("pair", "n", "best"))
    names = ["row", "doc_id", *_SUMS, "groups"]
    kinds = "row long, doc_id long, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups string"
    found = aligned.select(*names, "pairs", "links").mapInArrow(
        _looked_up(spark.sparkContext.broadcast(table), names),
        f"{kinds}, n_best long, count_sum long, pairs array<long>, links array<int>")
    columns = ["doc_id", *_SUMS, "n_best", "count_sum", "groups"]
    if least == 1:                                           # every pair was sent
        return found.select(*columns)
    found = stored(found, "found")
    rare = counts.where(F.col("n") < floor).withColumnRenamed("pair", "_pair")
    single = found.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n_links"))
    more = single.join(rare, single["pair"] == rare["_pair"]).groupBy("row").agg(
        F.sum(F.col("n_links") * F.col("n")).alias("_sum"),
        F.sum(F.when(F.col("best"), F.col("n_links")).otherwise(0)).cast("long").alias("_best"))
    return found.join(more, "row", "left").withColumn(
        "n_best", F.col("n_best") + F.coalesce("_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0))).select(*columns)
