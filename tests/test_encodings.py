"""Encodings judged from byte ranges."""
import os

import numpy as np
import pytest

from mailcase.sources import cases as S
from mailcase.sources.encodings import COUNTS, byte_counts


def report(spark, folder, **kw):
    return {os.path.basename(r.path): r for r in S.encoding_report(spark, f"{folder}/*.txt", **kw).collect()}


def decodes(data):
    try:
        data.decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


def test_faults_agree_with_a_strict_decoder():
    rng = np.random.default_rng(3)
    texts = ["é€\U0001f600a߿ࠀ￿\U0010ffff".encode()] * 200
    cases = [b"", b"\x80", b"\xc3", b"\xed\xa0\x80", b"\xe0\x80\x80", b"\xf4\x90\x80\x80", b"\xc0\xaf", b"\xf0\x80\x80\x80"]
    for t in texts:
        b = bytearray(t)
        b[rng.integers(len(b))] = rng.integers(256)
        cases.append(bytes(b))
    for data in cases + texts[:1]:
        assert (byte_counts(data, 0, len(data))["n_faults"] == 0) == decodes(data), data


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64])
def test_ranges_add_up_to_the_whole_file(spark, tmp_path, size):
    data = ("né€\U0001f600 ".encode() * 20) + b"\xff\xc3" + "ü".encode()
    (tmp_path / "a.txt").write_bytes(data)
    whole = byte_counts(data, 0, len(data))
    got = report(spark, tmp_path, range_bytes=size)["a.txt"]
    assert {c: got[c] for c in COUNTS} == whole and got.length == len(data)
    assert whole["n_faults"] == 2 and whole["n_sequences"] == 61


def test_encodings_and_confidence(spark, tmp_path):
    text = "Grüße, naïve café – déjà vu. " * 50
    plain = text.replace("–", "-")
    files = {"utf8": text.encode(), "sig": text.encode("utf-8-sig"), "latin": plain.encode("latin-1"),
             "cp": text.encode("cp1252"), "le": plain.encode("utf-16-le"), "be": plain.encode("utf-16-be"),
             "mark": text.encode("utf-16"), "ascii": b"abc", "one": "é".encode(),
             "broken": text.encode() + b"\xff", "odd": b"caf\xe9 \x81"}
    for name, data in files.items():
        (tmp_path / f"{name}.txt").write_bytes(data)
    got = report(spark, tmp_path, range_bytes=97)
    assert {n: got[f"{n}.txt"].encoding for n in files} == {
        "utf8": "utf-8", "sig": "utf-8-sig", "latin": "latin-1", "cp": "cp1252", "le": "utf-16-le",
        "be": "utf-16-be", "mark": "utf-16", "ascii": "utf-8", "one": "utf-8",
        "broken": "cp1252", "odd": "latin-1"}
    sure = {n: got[f"{n}.txt"].confidence for n in files}
    assert all(sure[n] > 0.99 for n in ("utf8", "sig", "latin", "cp", "le", "be", "mark", "ascii"))
    assert 0.6 < sure["one"] < 0.9 and sure["broken"] < 0.01


def test_no_row_holds_a_whole_file(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x" * 1000)
    plan = S.encoding_report(spark, f"{tmp_path}/*.txt", range_bytes=100)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
