"""run() stage by stage on a small corpus, and texts that only 128 bits tell apart."""
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from mailcase.llm.decontamination import decontaminate
from mailcase.llm.line_dedup import line_dedup
from mailcase.llm.near_dedup import near_dedup
from mailcase.llm.quality import quality_scores
from mailcase.llm.tables import read_table, stored

from .conftest import documents

SF = "/root/testdata/sf0.001"
#: Two texts with the same 32-bit hash, found by trying numbers.
TWINS = ("text number 2654", "text number 91281")


def test_texts_of_one_key_with_equal_short_hashes(spark):
    rows = [(1, TWINS[0], "s"), (1, TWINS[1], "s"), (1, TWINS[1], "s"), (2, "other words here", "s")]
    docs = documents(spark, rows)
    assert docs.where("doc_id = 1").selectExpr("hash(text)").distinct().count() == 1
    items = spark.createDataFrame([(9, "number 2654"), (8, "no such item words")], "item_id long, text string")
    for blocks in (200_000, 1):
        found = decontaminate(docs, items, max_windows=blocks).collect()
        assert Counter((r.doc_id, r.n_hit) for r in found) == Counter({(1, 2): 1, (1, 0): 2, (2, 0): 1})
    assert sorted(r.row.text for r in line_dedup(docs).collect()) == sorted(t for _, t, _ in rows)
    near = near_dedup(docs).collect()
    assert len(near) == 4 and len({r.text_id for r in near}) == 3 and all(r.kept for r in near)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert len({r.text_id for r in quality_scores(docs, labels).collect()}) == 3
    bad = near_dedup(docs).where("text_id = unhex(md5('text number 2654'))")
    assert sorted(r.text for r in P._without(docs, bad).collect()) == sorted(t for _, t, _ in rows[1:])


def test_lines_of_colliding_texts_are_dropped_from_their_own_text(spark):
    line = "this line is long enough and found in several documents"
    found = defaultdict(list)
    for i in range(400):
        found[i] = f"{line}\nown {i}"
    rows = [(i, t, "s") for i, t in found.items()]
    got = {r.row.doc_id: r.kept_text for r in line_dedup(documents(spark, rows)).collect()}
    assert got[399] == found[399] and all(got[i] == f"own {i}" for i in range(399))


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, as run() chains them."""
    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        after = stored(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text").collect())


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_run_is_its_stages(spark, stages):
    assert [n for n, _, _ in stages] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert rows(P.run(spark, SF)) == rows(stages[-1][2])
    columns = read_table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_quality_drops_exactly_what_the_scores_reject(spark, stages):
    _, before, after = stages[0]
    scores = {r.doc_id: r.predicted for r in quality_scores(before, read_table(spark, SF, "labels")).collect()}
    assert rows(after) == Counter({k: v for k, v in rows(before).items() if scores[k[0]]})
    assert 0 < sum(rows(after).values()) < sum(rows(before).values())


def test_line_dedup_against_brute_force(stages):
    _, before, after = stages[1]
    docs = {k[0]: k[1] for k in rows(before)}
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        {c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, t in docs.items():
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    want = {i: t if t is None else "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i)
            for i, t in docs.items()}
    assert {k[0]: k[1] for k in rows(after)} == want
    assert any(want[i] != docs[i] for i in docs)


def test_near_dedup_keeps_one_of_each_class(stages):
    _, before, after = stages[2]
    texts = [(i, words(t)) for i, t in sorted(rows(before))]
    sets = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for i, w in texts if w}
    label = {i: i for i, _ in texts}

    def head(i):
        while label[i] != i:
            i = label[i]
        return i

    by = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            by[g].add(i)
    for a, s in sets.items():
        for b in {b for g in s for b in by[g] if b < a}:
            if len(s & sets[b]) >= 0.8 * len(s | sets[b]):
                x, y = sorted((head(a), head(b)))
                label[y] = x
    plain = {i for i in label if head(i) == i}
    kept = {i for i, _ in rows(after)}
    assert kept <= plain                        # one of each class by plain similarity at most; the weighted one may join more
    assert len(kept) >= 0.98 * len(plain) and len(plain) < len(label)
    assert all(v == 1 for v in rows(after).values())


def test_decontamination_against_brute_force(spark, stages):
    _, before, after = stages[3]
    windows = set()
    for r in read_table(spark, SF, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[j:j + 13]) for j in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}
    clean = {}
    for (i, t), n in rows(before).items():
        w, hit = words(t), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit |= set(range(j, j + k))
        if not hit or 20 * len(hit) < len(w):
            clean[i, t] = n
    assert rows(after) == Counter(clean) and len(clean) < sum(rows(before).values())


def test_mixing_repeats_whole_documents(stages):
    _, before, after = stages[4]
    had, has = rows(before), rows(after)
    assert set(has) <= set(had) and max(has.values()) <= 3
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    source = {(r.doc_id, r.text): r.source for r in before.collect()}
    by = defaultdict(int)
    for k in had:
        by[source[k]] += size(k[1])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by, key=lambda s: (s is None, s)))}
    target, open_, left = {}, set(by), sum(by.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * by[s]}
        if not full:
            target |= share
            break
        target |= {s: 3.0 * by[s] for s in full}
        left -= sum(3.0 * by[s] for s in full)
        open_ -= full
    most = max(size(k[1]) for k in had)
    for s in by:
        taken = sum(n * size(k[1]) for k, n in has.items() if source[k] == s)
        assert abs(taken - target[s]) <= 0.15 * target[s] + most


def test_texts_go_to_python_a_few_mb_at_a_time(spark):
    """Written steps and count tables bound the Arrow batches, and leave the session's setting as it was."""
    import pyarrow as pa

    from mailcase.llm.tables import BATCH_BYTES, BATCH_SETTING, stored, summed_table

    before = spark.conf.get(BATCH_SETTING, None)
    docs = spark.range(0, 3000, 1, 1).selectExpr("repeat('abcdefgh', 1000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    def largest(batches, table):
        for b in batches:
            table[0] = max(table[0], b.nbytes)

    got = [r["n"] for r in stored(docs.mapInArrow(sizes, "n long")).collect()]
    assert sum(got) > 20e6 and max(got) < 2 * BATCH_BYTES
    assert 0 < summed_table(docs, 1, largest)[0] < 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_SETTING, None) == before
