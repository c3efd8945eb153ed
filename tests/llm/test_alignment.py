"""Alignment against a direct computation with the tokenizers' own libraries."""
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from mailcase.llm import alignment as A

from .conftest import EDGE, documents

TEXTS = ["Hello world, it's 12345 o'clock.", "  two  blanks ", "tab\tand\nlines\r\n\r\nend", "ﬁne naïve café — €5",
         "日本語のテキスト mixed with English", "a▁b", "<s> <|endoftext|> </s> <unk> <0x41>", "🙂👍🏽 emoji", " ", "x",
         "\x00\x01 control", "a b c", "don't can't we'll", "é́ combining", "same text", "same text"]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A.BYTE_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=A.PIECE_MODEL)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in shown}
        self.byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def tokens(self, text):
        """[(id, start, end)] of both, or nothing."""
        if not text:
            return [], []
        want, out = (" " + text).encode(), []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        ta = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in ids]
        tb = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            tb.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        for t in (ta, tb):
            if b"".join(x for _, x in t) != want:
                return [], []
            at, spans = 0, []
            for i, x in t:
                spans.append((i, at, at + len(x)))
                at += len(x)
            out.append(spans)
        return out

    def document(self, text):
        ta, tb = self.tokens(text)
        ends = sorted({e for *_, e in ta} & {e for *_, e in tb})
        groups = ";".join(",".join(str(i) for i, _, e in ta if lo < e <= hi) + "|" +
                          ",".join(str(i) for i, _, e in tb if lo < e <= hi)
                          for lo, hi in zip([0, *ends], ends))
        links, j = Counter(), 0
        for i, s, e in ta:
            while j and tb[j - 1][2] > s:
                j -= 1
            while j < len(tb) and tb[j][1] < e:
                if tb[j][2] > s:
                    links[i, tb[j][0]] += 1
                j += 1
        return len(ta), len(tb), len(ends), links, groups

    def table(self, rows):
        docs = [(k, *self.document(t)) for k, t in rows]
        n = Counter(p for *_, links, _ in docs for p in links)
        most = defaultdict(int)
        for (a, _), c in n.items():
            most[a] = max(most[a], c)
        return [(k, na, nb, ng, sum(links.values()), sum(c for p, c in links.items() if n[p] == most[p[0]]),
                 sum(c * n[p] for p, c in links.items()), groups)
                for k, na, nb, ng, links, groups in docs]


@pytest.fixture(scope="module")
def brute():
    return Brute()


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def text_of(rng, n):
    words = ["the", "Straße", "naïve", "tokenization", "x9", "über-cool", "it's", "日本", "a", "running;", "\n", ""]
    return " ".join(words[int(i)] for i in rng.integers(0, len(words), n))


@pytest.mark.parametrize("chunk,fan,hot", [(1 << 16, 16, 1 << 20), (24, 2, 1 << 20), (40, 3, 30), (7, 16, 0)])
def test_against_brute_force(spark, brute, chunk, fan, hot):
    rng = np.random.default_rng(1)
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, text_of(rng, int(n))) for i, n in
                                                   enumerate(rng.integers(1, 60, 25))]
    data += [(None, "same text"), (3, "b" * 300), (4, "日本" * 60), (5, None), (6, ""), (7, " " * 90 + "end")]
    docs = documents(spark, [(k, t, "s") for k, t in data]).repartition(3)
    got = A.alignment_scores(docs, chunk=chunk, fan=fan, hot=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert rows(got) == sorted(brute.table(data), key=str)


def test_digest_is_that_of_the_groups(spark, brute):
    data = [(1, "One text of several words."), (2, "One text, " * 20), (3, None)]
    got = A.alignment_scores(documents(spark, [(k, t, "s") for k, t in data]), chunk=64, whole=False)
    want = [hashlib.sha256(g.encode()).hexdigest() if g else "" for *_, g in brute.table(data)]
    assert [r.groups for r in got.orderBy("doc_id").collect()] == want


def test_edge_rows(spark, edge, empty, brute):
    data = [(k, t) for k, t, _ in EDGE if k not in (8,)]       # the direct computation is quadratic in groups
    got = [r for r in rows(A.alignment_scores(edge.where("doc_id IS NULL OR doc_id <> 8"))) if r[0] != 9]
    assert got == [r for r in sorted(brute.table([(k, t if k != 9 else "") for k, t in data]), key=str) if r[0] != 9]
    assert A.alignment_scores(empty).count() == 0


def test_very_long_text_in_ranges_is_the_text_in_one(spark, edge):
    long = edge.where("doc_id IN (8, 9)")
    assert rows(A.alignment_scores(long, chunk=1 << 14, fan=4)) == rows(A.alignment_scores(long, chunk=1 << 24))


def test_joining_fragments_is_associative():
    rng = np.random.default_rng(5)
    for _ in range(50):
        end_a = np.unique(rng.integers(1, 200, 40))
        end_b = np.unique(np.concatenate([rng.integers(1, 200, 40), [200]]))
        end_a = np.unique(np.append(end_a, 200))
        cuts = np.unique(rng.integers(0, 200, 6)).tolist()

        def part(lo, hi):
            a, b = end_a[(end_a > lo) & (end_a <= hi)], end_b[(end_b > lo) & (end_b <= hi)]
            return A.fragment(a * 10, a, b * 10, b)[0]

        parts = [part(lo, hi) for lo, hi in zip([0, *cuts], [*cuts, 200]) if lo < hi]

        def fold(order):
            f, closed = [dict(p) for p in parts], []
            for i in order:
                i %= max(1, len(f) - 1)
                if len(f) > 1:
                    f[i], c = A.compose(f[i], f.pop(i + 1))
                    closed.append(c)
            return [{k: np.asarray(v).tolist() for k, v in x.items()} for x in f], \
                sorted([x.tolist() for x in c[:4]] for c in closed if c is not None)

        assert fold([0] * len(parts)) == fold(range(len(parts) - 1, -1, -1)) == fold(rng.integers(0, 9, len(parts)).tolist())
