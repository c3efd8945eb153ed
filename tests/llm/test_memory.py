"""What an executor's JVM and Python workers hold at a time."""
import tracemalloc

import numpy as np
import pyarrow as pa

from mailcase.llm import line_dedup as L
from mailcase.llm.near_dedup import _sign
from mailcase.llm.wordhash import ALNUM, LOWER, PIECE, Words

from .conftest import documents


class Sent:
    def __init__(self, value):
        self.value = value


def test_words_are_hashed_without_the_values_of_a_whole_piece():
    """8 bytes for each byte of a piece, three times over, stayed with every worker."""
    text = b"some words of a text, " * (PIECE // 22)
    buf = np.frombuffer(text, dtype=np.uint8)
    words = Words(buf, np.array([0, len(buf)]), ALNUM)
    tracemalloc.start()
    h = words.hashes(LOWER)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * len(buf)
    # A word's hash depends neither on its place nor on what is hashed with it.
    assert len(set(h.tolist())) == 5 and (h[:-5] == h[5:]).all()
    alone = Words(buf[:21], np.array([0, 21]), ALNUM).hashes(LOWER)
    assert (h[:5] == alone).all()
    # One word of more than a span.
    long = np.frombuffer(b"ab" * 300_000 + b" ab", dtype=np.uint8)
    twice = np.concatenate((long, long))
    one, two = (Words(x, np.array([0, len(x)]), ALNUM).hashes() for x in (long, np.append(long, 32)))
    assert len(one) == 2 and (one == two).all() and one[0] != one[1]
    assert (Words(twice, np.array([0, len(long), len(twice)]), ALNUM).hashes() == np.tile(one, 2)).all()


def test_signatures_hold_a_small_part_of_a_batch():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(1200)]
    batch = pa.RecordBatch.from_pydict({"doc": pa.array(range(1200)), "tag": pa.array([0] * 1200),
                                        "text": pa.array(texts)})
    idf = Sent(np.ones(1 << 18, dtype=np.float32))
    got = list(_sign(idf, 5, 15, 4, 11)([batch]))
    assert sum(len(b) for b in got) == 1200 and max(len(b) for b in got) < 300
    few = pa.Table.from_batches(got)
    again = pa.Table.from_batches(list(_sign(idf, 5, 15, 4, 11)([batch.slice(500, 7)])))
    assert few.slice(500, 7).to_pylist() == again.to_pylist()


def test_lines_are_dropped_a_few_texts_at_a_time():
    texts = [f"line of text {i % 7} that may go\nown {i}\n" + "x" * 5000 for i in range(1000)]
    texts[5] = None
    row = pa.StructArray.from_arrays([pa.array(range(1000)), pa.array(texts)], ["id", "text"])
    drop = pa.array([["line of text 3 that may go"] if i % 2 else None for i in range(1000)])
    got = list(L._drop(20, 1)([pa.RecordBatch.from_pydict({"row": row, "drop": drop})]))
    assert len(got) > 3 and max(b.nbytes for b in got) < 3 * PIECE
    got = pa.Table.from_batches(got).to_pylist()
    assert [g["row"]["id"] for g in got] == list(range(1000))
    for i, g in enumerate(got):
        lines = (texts[i] or "").split("\n")
        left = [x for x in lines if not (i % 2 and x == "line of text 3 that may go")]
        assert (g["n_lines"], g["n_dropped"], g["kept_text"]) == (len(lines), len(lines) - len(left), "\n".join(left))


def test_a_task_of_line_dedup_has_one_python_worker(spark):
    """Workers stay with an executor, so two a task take the memory of two to the end."""
    line = "this line is long enough and found in several documents"
    found = {i: f"{line}\nown {i}\n" if i < 4 else f"own {i}\n\n" for i in range(9)}
    rows = [(i, t, "s") for i, t in found.items()] + [(9, None, "s"), (10, "", "s")]
    df = L.line_dedup(documents(spark, rows))
    above = []              # (depth, the Python nodes since the last exchange) of the nodes over a line
    for text in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(text) - len(text.lstrip(" :+-"))
        while above and above[-1][0] >= depth:
            above.pop()
        n = above[-1][1] if above else 0
        name = text.lstrip(" :+-*")
        n = 0 if "Exchange" in name.split(" ")[0] else n + ("MapInArrow" in name[:30] or "EvalPython" in name[:30])
        above.append((depth, n))
        assert n < 2, text
    got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()}
    assert got == {i: (3, 1, f"own {i}\n") if i < 3 else (t.count("\n") + 1, 0, t) for i, t in found.items()} | {
        9: (1, 0, ""), 10: (1, 0, "")}
