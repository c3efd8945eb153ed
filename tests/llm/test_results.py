"""Operators against brute-force versions, and classifiers on held-out rows."""
import base64
import hashlib
import itertools
import json
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_MED, SF_SMALL
from mailcase.llm import queries as Q
from mailcase.llm.components import components
from mailcase.llm.secrets import der_ok, secret_scan, ssh_ok
from mailcase.llm.tables import read_table
from mailcase.llm.token_counts import PATTERN, VOCABULARY

from .conftest import documents


def texts(spark):
    return {r.doc_id: r.text or "" for r in read_table(spark, SF_SMALL, "documents").collect()}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_secret_scan_matches_the_patterns(spark):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    got = {r.doc_id: r for r in Q.QUERIES["op8_secret_scan"](spark, SF_MED).collect()}
    for r in read_table(spark, SF_MED, "documents").collect():
        found = [(m.start(), 0, m.end()) for m in assign.finditer(r.text or "") if len(m[2]) >= 6]
        for k, (p, n) in enumerate((("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24)), 1):
            found += [(m.start(), k, m.end()) for m in re.finditer(p, r.text or "") if len(m[0]) >= n]
        found.sort()
        names = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)
        g = got[r.doc_id]
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(k == i for _, k, _ in found) for i in range(3))
        assert g.base_sha256 == sha(names)


def test_confirmed_structures(spark):
    part = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256'})}.{part({'sub': 'x'})}.abcDEF123"
    no_jwt = f"{part({'typ': 'none'})}.{part({'sub': 'x'})}.abcDEF123"
    body = b"\x02\x01\x00" + b"\x04\x28" + bytes(range(40))
    key = b"\x30" + bytes([len(body)]) + body
    assert der_ok(key) and not der_ok(key + b"x") and not der_ok(key[:-1]) and not der_ok(b"")
    b64 = base64.b64encode(key).decode()
    pem = f"-----BEGIN PRIVATE KEY-----\n{b64}\n-----END PRIVATE KEY-----"
    rows = [(1, f"é {jwt} x", "s"), (2, no_jwt, "s"), (3, pem, "s"), (4, f"k {key.hex()} z", "s"),
            (5, "x" + base64.b64encode(bytes(60)).decode(), "s")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans]
           for r in secret_scan(documents(spark, rows)).collect()}
    assert got[1] == [("jwt", 2, 2 + len(jwt))] and got[2] == [] and got[5] == []
    assert ("pem", 0, len(pem)) in got[3] and ("der", 28, 28 + len(b64)) in got[3]
    assert got[4] == [("hex", 2, 2 + 2 * len(key)), ("der", 2, 2 + 2 * len(key))]


def test_ssh_keys_spaced_headers_and_long_runs(spark):
    def field(b):
        return len(b).to_bytes(4, "big") + b

    public = field(b"ssh-ed25519") + field(bytes(32))
    key = (b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big")
           + field(public) + field(bytes(range(64))))
    assert ssh_ok(key) and not ssh_ok(key[:-1]) and not ssh_ok(b"openssh-key-v1\0") and not ssh_ok(b"")
    name = "OPENSSH PRIVATE KEY"
    pem = f"-----BEGIN {name}-----\n{base64.b64encode(key).decode()}\n-----END {name}-----"
    enc = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    spaced = [f"{enc(h)}.{enc(b'{}')}.sig" for h in (b'{ "alg": "RS256" }', b'{\n  "alg": "none"}',
                                                     b'{\r\n"alg": "ES256"}', b'{\t"alg": "x"}')]
    run = "eyJ" + "a" * 300_000                      # a quadratic scan of it would not end
    rows = [(1, pem, "s"), (2, " ".join(spaced), "s"), (3, run, "s"), (4, f"{run}.{run}", "s")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans]
           for r in secret_scan(documents(spark, rows)).collect()}
    assert [s for s in got[1] if s[0] != "hex"] == [("pem", 0, len(pem))]
    at = [sum(len(t) + 1 for t in spaced[:i]) for i in range(4)]
    assert got[2] == [("jwt", a, a + len(t)) for a, t in zip(at, spaced)]
    assert [s for s in got[3] + got[4] if s[0] == "jwt"] == []


def test_token_counts_against_all_lengths(spark):
    tiktoken = pytest.importorskip("tiktoken")
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    n = [len(enc.encode_ordinary(t)) for t in texts(spark).values()]
    got = sorted(tuple(r) for r in Q.QUERIES["op6_token_counts"](spark, SF_SMALL).collect())
    assert got == sorted((x, c, x * c, sum(y >= x for y in n), sum(y for y in n if y >= x),
                          sum(min(y, x) for y in n), sum(y <= x for y in n) / len(n))
                         for x, c in Counter(n).items())


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))


def test_near_dedup_against_all_pairs(spark):
    """Every pair of plain similarity 0.85 or more is in one class, and every class holds together."""
    grams = {}
    for i, t in texts(spark).items():
        w = words(t)
        grams[i] = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set()
    cls = {r.doc_id: r.class_id for r in Q.QUERIES["op9_near_dedup"](spark, SF_SMALL).collect()}
    assert cls.keys() == grams.keys()
    best = Counter()
    for a, b in itertools.combinations(sorted(grams), 2):
        if grams[a] and grams[b]:
            j = len(grams[a] & grams[b]) / len(grams[a] | grams[b])
            assert j < 0.85 or cls[a] == cls[b], (a, b, j)
            if cls[a] == cls[b]:
                best[a], best[b] = max(best[a], j), max(best[b], j)
    assert all(v > 0.6 for v in best.values())
    assert all(cls[c] == c for c in cls.values())


def test_near_copies_are_found_and_others_left(spark):
    rng = np.random.default_rng(1)
    base = [[f"w{rng.integers(50_000)}" for _ in range(300)] for _ in range(12)]
    rows = []
    for g, b in enumerate(base):
        for c in range(8):
            w = list(b)
            if c:
                w[int(rng.integers(300))] = f"edit{g}x{c}"
            rows.append((g * 100 + c, " ".join(w), "s"))
    got = {r.doc_id: r.class_id for r in
           __import__("mailcase.llm.near_dedup", fromlist=["x"]).near_dedup(documents(spark, rows)).collect()}
    assert got == {i: i // 100 * 100 for i, _, _ in rows}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 200)],
                                  "u long, v long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


@pytest.mark.parametrize("name, label, least", [("op4_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    truth = {r.doc_id: r[label] for r in read_table(spark, SF_MED, "labels").collect()}
    rows = [r for r in Q.QUERIES[name](spark, SF_MED).collect() if r.held_out and r.doc_id in truth]
    assert len(rows) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) >= least
    assert len({r.score for r in rows}) > 10
