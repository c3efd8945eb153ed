"""Metrics against brute-force Python definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailcase.functions.labels import LabelSet, PRIORITY5
from mailcase.functions.scores import argmax, softmax
from mailcase.operators import metrics as M
from mailcase.operators.profile import class_weights


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    if not pos or not neg:
        return None
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def brute_ap(y, s):
    P = sum(y)
    if P == 0:
        return None
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, s) if b >= t and a == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


@pytest.fixture(scope="module")
def scores(spark):
    rnd = random.Random(7)
    rows = [(i, int(rnd.random() < 0.3), round(rnd.random(), 2)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id int, y int, s double")


@pytest.mark.parametrize("buckets", [1, 4, 256])
def test_auc_ap_exact_for_any_bucketing(scores, buckets):
    rows, df = scores
    y = [r[1] for r in rows]
    s = [r[2] for r in rows]
    auc = M.roc_auc(df, "y", "s", n_buckets=buckets).first()[0]
    ap = M.average_precision(df, "y", "s", n_buckets=buckets).first()[0]
    assert auc == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert ap == pytest.approx(brute_ap(y, s), abs=1e-12)


def test_roc_curve_points(scores):
    rows, df = scores
    pts = M.roc_curve(df, "y", "s").collect()
    assert len(pts) == len({r[2] for r in rows}) + 1
    start = [p for p in pts if math.isinf(p["threshold"])][0]
    assert (start["fpr"], start["tpr"]) == (0.0, 0.0)
    last = min((p for p in pts if not math.isinf(p["threshold"])), key=lambda p: p["threshold"])
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)
    pr = M.pr_curve(df, "y", "s").collect()
    assert all(0 <= p["precision"] <= 1 and 0 <= p["recall"] <= 1 for p in pr)


def test_no_positives_gives_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.5)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] is None
    assert M.average_precision(df, "y", "s").first()[0] is None


def test_confusion_prf_report(spark):
    ls = LabelSet("t3", ("a", "b", "c"))
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (0, 0), (1, 0)]  # class c: no rows, never predicted
    df = spark.createDataFrame(rows, "y int, p int")
    cm = {(r["true_id"], r["pred_id"]): r["n"] for r in M.confusion_matrix(df, "y", "p", ls).collect()}
    assert len(cm) == 9 and sum(cm.values()) == len(rows) and cm[(2, 2)] == 0
    prf = {r["class_id"]: r for r in M.per_class_prf(df, "y", "p", ls).collect()}
    assert prf[0]["precision"] == pytest.approx(2 / 3) and prf[0]["recall"] == pytest.approx(2 / 3)
    assert prf[2]["precision"] == 0 and prf[2]["recall"] == 0 and prf[2]["f1"] == 0
    rep = {r["row"]: r for r in M.classification_report(df, "y", "p", ls).collect()}
    assert rep["accuracy"]["f1_score"] == pytest.approx(4 / 6)
    assert rep["macro avg"]["f1_score"] == pytest.approx((2 / 3 + 2 / 3 + 0) / 3)
    assert rep["weighted avg"]["support"] == 6


def test_published_report_arithmetic(spark):
    """Macro / weighted rows follow from per-class rows (report v2 of the reference)."""
    per_class = [  # precision, recall, f1, support (published, 4 digits)
        (0.9658, 0.9350, 0.9501, 3261), (0.7921, 0.6006, 0.6832, 4199),
        (0.8637, 0.9293, 0.8953, 16871), (0.8820, 0.8654, 0.8737, 8242),
        (0.0, 0.0, 0.0, 2), (1.0, 0.1667, 0.2857, 6), (0.0, 0.0, 0.0, 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(per_class)],
                               "class_id int, precision double, recall double, f1 double, support long")
    a = M.averages(df).first()
    assert a["support"] == 32582
    assert a["macro_f1"] == pytest.approx(0.5269, abs=1e-4)
    assert a["weighted_f1"] == pytest.approx(0.8678, abs=1e-4)
    assert a["macro_precision"] == pytest.approx(0.6434, abs=1e-4)
    assert a["weighted_recall"] == pytest.approx(0.8711, abs=1e-4)


def test_class_weights_empty_class(spark):
    ls = LabelSet("p5", ("a", "b", "c", "d", "e"))
    rows = [(0,)] * 10 + [(1,)] * 5 + [(2,)] * 3 + [(3,)]
    w = {r["class_id"]: r["weight"] for r in class_weights(
        spark.createDataFrame(rows, "y int"), "y", ls).collect()}
    assert w[4] is None
    assert sum(v for v in w.values() if v is not None) == pytest.approx(1.0)
    inv = np.array([1 / 10, 1 / 5, 1 / 3, 1.0])
    assert [w[i] for i in range(4)] == pytest.approx(list(inv / inv.sum()))


def test_softmax_argmax_focal(spark):
    x = [1.0, 3.0, 3.0, -2.0]
    df = spark.createDataFrame([(x, 1)], "x array<double>, y int")
    r = df.select(softmax("x").alias("p"), argmax("x").alias("a")).first()
    e = np.exp(np.array(x) - max(x))
    assert r["p"] == pytest.approx(list(e / e.sum()))
    assert r["a"] == 1  # first index on ties
    fl = M.focal_loss(df, "y", "x", gamma=2.0).first()[0]
    ce = -math.log((e / e.sum())[1])
    assert fl == pytest.approx((1 - math.exp(-ce)) ** 2 * ce)
    wfl = M.focal_loss(df, "y", "x", gamma=2.0, alpha=[1, 0.5, 1, 1]).first()[0]
    wce = 0.5 * ce
    assert wfl == pytest.approx((1 - math.exp(-wce)) ** 2 * wce)


def test_bce_stable(spark):
    df = spark.createDataFrame([(1000.0, 0, [0.0, 1.0], 1), (-1000.0, 1, [0.0, 1.0], 0)],
                               "x double, y int, l array<double>, c int")
    r = M.log_loss(df, bin_label="y", bin_logit="x", mc_label="c", mc_logits="l").first()
    assert r["loss_binary"] == pytest.approx(1000.0)


def test_best_checkpoint_tie_rule(spark):
    log = spark.createDataFrame([(0, 10, 0.9), (0, 5, 0.9), (0, 1, 0.5), (1, 3, None)],
                                "run long, step long, eval_accuracy double")
    r = M.best_checkpoint(log, "eval_accuracy").collect()
    assert [(x["run"], x["best_step"], x["best_eval_accuracy"]) for x in r] == [(0, 5, 0.9)]


def test_ovr_macro_skips_null(spark):
    rows = [([0.9, 0.1, 0.0], 0), ([0.2, 0.8, 0.0], 1), ([0.6, 0.4, 0.0], 1)]
    df = spark.createDataFrame(rows, "probs array<double>, label int")
    ls = LabelSet("t3", ("a", "b", "c"))
    o = {r["class_name"]: r["value"] for r in M.ovr_metric(df, "label", "probs", ls, "roc_auc").collect()}
    assert o["c"] is None
    assert o["macro"] == pytest.approx((o["a"] + o["b"]) / 2)


def test_bucket_count_follows_the_scores(spark, monkeypatch):
    from mailcase.operators import metrics as M

    df = spark.range(400).selectExpr("CAST(id % 3 = 0 AS INT) AS y", "id / 400.0 AS s")
    expected = M.roc_auc(df, "y", "s").first()[0]
    asked = []
    cut = M._score_buckets
    monkeypatch.setattr(M, "_score_buckets", lambda c, s, n: asked.append(n) or cut(c, s, n))
    monkeypatch.setattr(M, "MIN_BUCKETS", 2)
    monkeypatch.setattr(M, "BUCKET_SCORES", 20)
    assert abs(M.roc_auc(df, "y", "s").first()[0] - expected) < 1e-12
    assert asked == [20]
