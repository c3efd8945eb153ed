"""Links of the near-dedup that a cheaper candidate search would lose."""
import itertools

import numpy as np

from mailcase.llm.near_dedup import near_dedup

from .conftest import documents


def test_no_pair_of_a_shared_band_is_dropped_by_its_samples(spark):
    """Pairs of similarity 0.82 whose buckets mostly have another hub: all are linked,
    though often only one or two of their samples agree."""
    common = " ".join(f"c{i}" for i in range(604))
    rows = []
    for g in range(80):
        pair = " ".join(f"p{g}x{i}" for i in range(100))
        rows += [(2 * g + k, f"{common} {pair} " + " ".join(f"o{g}x{k}x{i}" for i in range(21)), "s")
                 for k in range(2)]
    got = {r.doc_id: r.class_id for r in near_dedup(documents(spark, rows), bands=4, rows=1).collect()}
    assert all(got[i] == got[i + 1] for i in range(0, 160, 2))


def grams(text):
    w = text.split()
    return set(zip(*[w[i:] for i in range(5)]))


def test_edited_copies_of_a_third_of_all_rows_against_all_pairs(spark):
    """Copies with edits at plain similarity 0.70-0.95 to the original, a third of the rows."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(400)]
    texts = {0: " ".join(base)}
    for i in range(1, 41):
        n = int(rng.integers(6, 70))
        at = int(rng.integers(0, 400 - n))
        texts[i] = " ".join(base[:at] + [f"e{i}x{k}" for k in range(n)] + base[at + n:])
    for i in range(41, 123):
        texts[i] = " ".join(f"u{i}x{k}" for k in range(300))
    sets = {i: grams(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    edge = [(a, b) for a, b in itertools.combinations(texts, 2)
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    plain = [len(sets[0] & sets[i]) / len(sets[0] | sets[i]) for i in range(1, 41)]
    assert sum(0.80 <= p < 0.93 for p in plain) >= 15 and sum(p < 0.78 for p in plain) >= 5
    for _ in texts:
        for a, b in edge:
            label[a] = label[b] = min(label[a], label[b])
    rows = [(i, t, "s") for i, t in texts.items()]
    got = {r.doc_id: r.class_id for r in near_dedup(documents(spark, rows)).collect()}
    assert got == label


def test_one_key_with_many_texts(spark):
    """Texts under one key are linked each on its own, and one of each class stays."""
    rng = np.random.default_rng(6)
    rows = []
    for g in range(30):
        base = [f"t{g}x{i}" for i in range(200)]
        edits = []
        for k in range(3):                 # two near copies under the hot key, one under its own
            w = list(base)
            w[int(rng.integers(10, 190))] = f"edit{g}x{k}"
            edits.append(" ".join(w))
        rows += [(6, edits[0], "s"), (6, edits[1], "s"), (100 + g, edits[2], "s")]
        rows += [(6, edits[0].upper(), "s"), (6, edits[0], "s")]
    text_of = {(i, h): t for i, t, h in documents(spark, rows).selectExpr(
        "doc_id", "text", "hash(text)").collect()}
    got = near_dedup(documents(spark, rows)).collect()
    assert {r.class_id for r in got} == {6} and len(got) == len(rows)
    stay = {text_of[r.doc_id, r.text_hash] for r in got if r.kept}
    assert sorted(int(t.lower().split("x")[0][1:]) for t in stay) == list(range(30))
    assert {r.doc_id for r in got if r.kept} == {6}
