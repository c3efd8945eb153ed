"""Substring dedup against all windows of small random texts, keys repeated."""
import random

import pyarrow as pa

from mailcase.llm.substring_dedup import _agreeing, substring_dedup

from .conftest import documents


def brute(texts, window):
    """Kept words of each text of an ordered list."""
    seen, out = set(), []
    for t in texts:
        w = t.split()
        gone = set()
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            if g in seen:
                gone.update(range(s, s + window))
            seen.add(g)
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_random_texts_with_a_hot_passage(spark):
    rng = random.Random(5)
    hot = " ".join(f"h{i}" for i in range(30))
    rows = []
    for i in range(120):
        w = [rng.choice("ab") + str(rng.randrange(3)) for _ in range(rng.randrange(60))]
        # Contents around the passage differ, so its anchors have many contents.
        w.insert(rng.randrange(len(w) + 1), hot if i % 3 == 0 else "own")
        rows.append((i - 60, " ".join(w), "s"))
    for window, gram in ((20, 5), (8, 3), (5, 5)):
        got = {r.doc_id: r.kept_text for r in
               substring_dedup(documents(spark, rows).repartition(4), window=window, gram=gram).collect()}
        assert [got[i] for i, _, _ in rows] == brute([t for _, t, _ in rows], window)


def test_rows_of_one_key_are_told_apart(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    texts = [f"{passage} tail{i}" for i in range(12)]
    got = substring_dedup(documents(spark, [(1, t, "s") for t in texts])).collect()
    # One row is first and keeps all; the others keep what follows the passage.
    assert sorted(r.n_removed for r in got) == [0] + [25] * 11
    assert sum(passage in r.kept_text for r in got) == 1


def test_factors_are_read_on_over_the_words_after_their_source(spark):
    base = [f"b{i}" for i in range(200)]
    # Copies that leave the base at each word, one that enters it late, and one that ends inside a block.
    rows = [(0, " ".join(base), "s"), (90, " ".join(base[:150]), "s"), (91, " ".join(["z", *base[77:133], "y"]), "s")]
    rows += [(i, " ".join(base[:40 + i] + [f"own{i}x{k}" for k in range(30)]), "s") for i in range(1, 60)]
    rows += [(None, " ".join(base[100:160] + ["n"]), "s")] * 2
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    got = sorted(substring_dedup(documents(spark, rows).repartition(3)).collect(),
                 key=lambda r: (r.doc_id is not None, r.doc_id))
    # Equal rows are one document.
    assert [r.kept_text for r in got[1:]] == brute([r[1] for r in rows[1:]], 20)
    assert got[0].kept_text == got[1].kept_text


def test_common_prefixes_of_word_lists():
    mine = pa.array([[1, 2, 3], [1, 2, 3], [4], None, [], [7, 8]], pa.list_(pa.int64()))
    theirs = pa.array([[1, 2, 9, 9], [1, 2, 3, 4], [5], [1], [1], None], pa.list_(pa.int64()))
    assert _agreeing(mine, theirs).tolist() == [2, 3, 0, 0, 0, 0]
    assert _agreeing(mine[1:2], theirs[1:2]).tolist() == [3]
