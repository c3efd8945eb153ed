"""Ranked search against scoring every document by the definition."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from mailcase.llm import lexical as R

from .conftest import EDGE, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(key, Counter(terms(t))) for key, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for key, b in bags:
            size, score = sum(b.values()), 0
            for t in terms(text):
                if b[t]:
                    m = 100 - 25 + (25 * size * n) // total
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def corpus(rng, n):
    """Zipf words, ties (repeated texts) and a few long documents."""
    out = []
    for i in range(n):
        size = int(rng.integers(0, 60)) if i % 50 else 3_000
        text = " ".join(f"W{int(x)}" for x in rng.zipf(1.3, size) % 500)
        out.append((i, text, "s"))
    return out + [(n + i, out[i % 7 + 1][1].upper(), "s") for i in range(60)]


ITEMS = [(1, "w1 w2 w3"), (2, "W7-w7, w7 w400 zzz"), (3, None), (4, "never"), (5, " ".join(f"w{i}" for i in range(120))),
         (None, "w33"), (6, "w33"), (6, "w33"), (7, ""), (8, "é w9")]


@pytest.mark.parametrize("shard", [1 << 21, 300])
def test_against_brute_force(spark, shard):
    data = corpus(np.random.default_rng(2), 600)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = R.ranked_search(documents(spark, data).repartition(4), items, shard_postings=shard)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(got.dtypes)["rank"] == "int"
    assert rows(got) == brute([(i, t) for i, t, _ in data], ITEMS)


def test_edge_rows(spark, edge, empty):
    items = [(1, "w1 w2 tail"), (2, "other text"), (3, "é" * 200_000), (4, "a"), (5, "x1y1 W59")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert rows(R.ranked_search(edge, table)) == brute([(i, t) for i, t, _ in EDGE], items)
    assert R.ranked_search(empty, table).count() == 0
    assert R.ranked_search(edge, table.limit(0)).count() == 0


def test_blocks_of_items_give_the_same_rows(spark, monkeypatch):
    data = corpus(np.random.default_rng(4), 150)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(R, "BLOCK_ITEMS", 3)
    assert rows(R.ranked_search(documents(spark, data), items)) == brute([(i, t) for i, t, _ in data], ITEMS)


def test_search_stops_before_the_lists_end():
    """Few documents lead all lists: the bound falls strictly below the k-th score early."""
    rng = np.random.default_rng(8)
    n = 20_000
    doc = np.tile(np.arange(n), 3)
    term = np.repeat(np.arange(3), n)
    impact = rng.integers(1, 1000, 3 * n)
    impact[(doc < 30)] = 1_000_000 + doc[doc < 30]
    shard = R.Shard(np.arange(n), doc, term, impact, 3)
    found, score, read = shard.search(Counter({0: 1, 1: 2, 2: 1}), 20, [])
    assert found.tolist() == list(range(29, 9, -1)) and read < 3 * n // 20
    again, _, _ = shard.search(Counter({0: 1, 1: 2, 2: 1}), 20, [])
    assert again.tolist() == found.tolist()                      # nothing is left behind by a search
    none, _, read = shard.search(Counter({0: 1}), 20, [2_000_000] * 20)
    assert read <= R.STEP                                        # beaten by other shards at once


def test_best_positions_pass_the_last_read_position():
    """Direct accesses fill a list far beyond its sorted reads."""
    n = 4_000
    a = np.arange(n, 0, -1)                                      # both lists have the same order
    shard = R.Shard(np.arange(n), np.tile(np.arange(n), 2), np.repeat([0, 1], n), np.concatenate([a, a * 3]), 2)
    shard._direct(np.arange(1_000), np.array([0, 1]), np.array([1, 1]))
    assert shard.seen[:1_000].all() and not shard.seen[1_000]
