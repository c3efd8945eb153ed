"""SimHash near-dedup against brute force: fingerprints by definition, links by all pairs."""
import numpy as np
import pytest
import xxhash

from mailcase.llm import simhash as S

from .conftest import EDGE, documents


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(keys, prints):
    """Smallest key reachable over links of 3 or fewer bits, by all pairs of distinct fingerprints."""
    fps = np.array(sorted(set(prints)), dtype=np.uint64)
    label = np.arange(len(fps))
    u, v = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    S.merge(label, u, v)
    at = dict(zip(fps.tolist(), label.tolist()))
    least = {}
    for k, p in zip(keys, prints):
        if k is not None:
            least[at[p]] = min(least.get(at[p], k), k)
    return [least.get(at[p]) for p in prints]


def clusters(rng, groups, size, flips):
    """Random fingerprints and members up to ``flips`` bits from their centre."""
    out = []
    for _ in range(groups):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            x = centre
            for b in rng.choice(64, int(rng.integers(0, flips + 1)), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    return out


def found_links(spark, fps, **kw):
    fps = np.unique(np.array(fps, dtype=np.uint64))
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    t = S.near_links(nodes, len(fps), **kw).toArrow()
    u, v = (np.searchsorted(fps, t.column(c).to_numpy().view(np.uint64)) for c in "uv")
    return fps, u, v


@pytest.mark.parametrize("groups,size,flips,leaf,sample", [
    (400, 4, 4, 16, 1 << 17),        # many small groups, deep trees
    (3, 700, 6, 16, 1 << 17),        # dense groups
    (1, 1500, 3, 32, 64),            # one dense group, shards larger than the sample foresaw
    (200, 5, 8, 512, 1 << 17)])      # one shard
def test_trees_lose_and_invent_no_link(spark, groups, size, flips, leaf, sample):
    rng = np.random.default_rng(groups)
    fps, u, v = found_links(spark, clusters(rng, groups, size, flips), leaf=leaf, sample=sample)
    got, want = np.arange(len(fps)), np.arange(len(fps))
    S.merge(got, u, v)
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    S.merge(want, a, b)
    assert (got == want).all()
    assert len(u) <= 40 * len(fps)               # forests, not all pairs


def test_halves_that_are_equal_are_split_on_the_other_half(spark):
    """A third of all fingerprints share one half: their shards are told apart by the other one."""
    rng = np.random.default_rng(9)
    top = 0x1234ABCD << 32
    near = clusters(rng, 60, 8, 3)
    fps, u, v = found_links(spark, [top | x & 0xFFFFFFFF for x in near] + near, leaf=16)
    tree = S.Tree(fps, 0, 16)
    assert (tree.spread == 3).any() and tree.leaves > 10
    got, want = np.arange(len(fps)), np.arange(len(fps))
    S.merge(got, u, v)
    S.merge(want, *np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3))
    assert (got == want).all()


def test_visits_prune_branches():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    tree = S.Tree(fps[::4], 0, 32)
    row, leaf = tree.visits(fps[:2000])
    assert tree.leaves > 80 and len(row) < 0.25 * 2000 * tree.leaves
    own = tree.home(fps[:2000])
    pairs = set(zip(row.tolist(), leaf.tolist()))
    assert all((i, k) in pairs for i, k in enumerate(own.tolist()))
    for bit in range(32, 64):                    # a partner at 1 bit of the tree's half is always visited
        there = tree.home(fps[:2000] ^ np.uint64(1 << bit))
        assert all((i, k) in pairs for i, k in enumerate(there.tolist()))


def test_whole_operator(spark, edge):
    rng = np.random.default_rng(11)
    rows = [(i, t, s) for i, t, s in EDGE]
    for g in range(20):
        words = [f"g{g}w{i}" for i in range(150)]
        for c in range(6):
            w = list(words)
            for _ in range(c):
                w[int(rng.integers(0, len(w)))] = f"e{g}x{c}"
            rows.append((100 + 10 * g + c, " ".join(w), "s"))
    prints = [fingerprint(t) for _, t, _ in rows]
    want = sorted((str(k), f"{p:016x}", c) for (k, _, _), p, c in
                  zip(rows, prints, classes([k for k, _, _ in rows], prints)))
    got = S.simhash_dedup(documents(spark, rows).repartition(5), leaf=8)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == want
    assert len({c for *_, c in want}) < len({p for _, p, _ in want})      # some links exist


def test_empty(empty):
    assert S.simhash_dedup(empty).count() == 0
