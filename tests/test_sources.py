import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mailcase.sources import cases as S
from mailcase.sources.tables import email_cases


def _local(path):
    p = path.removeprefix("file:")
    os.makedirs(p, exist_ok=True)
    return p


def _write(path, name, data: bytes):
    with open(os.path.join(_local(path), name), "wb") as f:
        f.write(data)


CSV = (
    "﻿Name;Subject;TextBody;Priority\n"
    'a;"He said ""hi""";"line one\nline two";Low\n'
    "b;short row\n"
    "c;too;many;fields;here\n"
    "d;NA;;null\n"
).encode("utf-8")


def test_read_cases_golden(spark, tmp_out):
    _write(tmp_out, "export.csv", CSV)
    df = S.read_cases(spark, tmp_out)
    assert df.columns == ["Name", "Subject", "TextBody", "Priority"]
    rows = {r["Name"]: r for r in df.collect()}
    assert sorted(rows) == ["a", "b", "d"]              # long row dropped (S3)
    assert rows["a"]["Subject"] == 'He said "hi"'      # doubled quote
    assert rows["a"]["TextBody"] == "line one\nline two"  # newline inside quotes
    assert rows["b"]["TextBody"] is None and rows["b"]["Priority"] is None  # padded
    assert rows["d"]["Subject"] is None and rows["d"]["TextBody"] is None  # S5
    assert rows["d"]["Priority"] is None


def test_write_read_roundtrip_keeps_text(spark, tmp_out):
    src = email_cases(spark, SF_SMALL).select("case_id", "Subject", "TextBody")
    S.write_cases(src, f"{tmp_out}/cases")
    head = open(next(os.path.join(_local(f"{tmp_out}/cases"), f)
                     for f in sorted(os.listdir(_local(f"{tmp_out}/cases")))
                     if f.endswith(".csv")), encoding="utf-8").read(1)
    assert head == "﻿"                              # S6 BOM
    back = S.read_cases(spark, f"{tmp_out}/cases")
    a = sorted((int(r[0]), r[1], r[2]) for r in back.collect())
    b = sorted((r[0], r[1], r[2]) for r in src.collect())
    assert a == b


def test_training_logs_and_best_checkpoint(spark, tmp_out):
    from mailcase.operators.metrics import best_checkpoint, loss_curves

    for run, accs in (("r1", [0.5, 0.9, 0.9]), ("r2", [0.7, 0.6, 0.65])):
        hist = []
        for i, a in enumerate(accs):
            hist.append({"epoch": i + 0.5, "step": 10 * i + 5, "loss": 1.0 / (i + 1),
                         "grad_norm": 1.0, "learning_rate": 1e-4})
            hist.append({"epoch": i + 1.0, "step": 10 * i + 10, "eval_accuracy": a,
                         "eval_loss": 1.0 - a, "eval_runtime": 1.0,
                         "eval_samples_per_second": 100.0, "eval_steps_per_second": 3.0})
        _write(f"{tmp_out}/{run}", "trainer_state.json",
               json.dumps({"global_step": 30, "log_history": hist}, indent=2).encode())
    log = S.read_training_logs(spark, f"{tmp_out}/*/trainer_state.json")
    assert log.count() == 12
    log = log.withColumn("run", F.regexp_extract("run", r"/(r\d)/", 1))
    best = {r["run"]: (r["best_step"], r["best_eval_accuracy"])
            for r in best_checkpoint(log, "eval_accuracy").collect()}
    assert best == {"r1": (20, 0.9), "r2": (10, 0.7)}   # earliest step on ties
    curves = loss_curves(log)
    assert curves.where("run = 'r1'").count() == 6


def test_encoding_report(spark, tmp_out):
    _write(tmp_out, "bom.csv", "﻿a;b\n".encode("utf-8"))
    _write(tmp_out, "utf8.csv", "naïve;€\n".encode("utf-8"))
    _write(tmp_out, "latin.csv", "naïve;ç\n".encode("latin-1"))
    rep = {os.path.basename(r["path"]): r["encoding"]
           for r in S.encoding_report(spark, f"{tmp_out}/*.csv").collect()}
    assert rep == {"bom.csv": "utf-8-sig", "utf8.csv": "utf-8", "latin.csv": "latin-1"}
