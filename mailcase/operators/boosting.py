"""Boosted trees with patience: one ensemble, cut at its best round (M4, M5).

The first block of rounds is MLlib's own fit where its dense rows are small.
If the evaluation loss has not settled by then, boosting goes on from that
ensemble, and without one from the start: each round fits one tree to the
residuals of the margin so far, as MLlib's next round would, from histograms of
the stored entries (``sparse_trees``), and stops ``patience`` rounds after the
best one. Nothing is fitted twice; the kept model is the first trees and
weights of the ensemble, an MLlib model that can be saved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.operators.sparse_trees import Rounds

#: Rounds without a better evaluation loss before boosting stops (fixed value).
PATIENCE = 20
#: Rounds of the first block, and the bytes that MLlib's dense binned rows may take for it.
FIRST_ROUNDS = 40
DENSE_BYTES = 64 << 20


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> int | None:
    """Number of rounds to keep: the one of smallest evaluation loss, once
    ``patience`` later rounds were no better; None if that is still open."""
    best, at = math.inf, 0
    for i, v in enumerate(losses, 1):
        if v < best:
            best, at = v, i
        elif i - at >= patience:
            return at
    return None


def assemble(model: GBTClassificationModel | GBTClassifier, trees: Sequence, weights: Sequence[float],
             n_features: int | None = None) -> GBTClassificationModel:
    """The model whose rounds are ``trees`` (of the JVM) and ``weights``, with the settings of
    ``model``; of an estimator give ``n_features``, too."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    array = sc._gateway.new_array(kind, len(trees))
    shares = sc._gateway.new_array(sc._jvm.double, len(weights))
    for i, (t, w) in enumerate(zip(trees, weights)):
        array[i], shares[i] = t, float(w)
    made = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, array, shares, n_features or model.numFeatures, 2)
    if isinstance(model, GBTClassifier):
        model._transfer_params_to_java()
    model._java_obj.copyValues(made, model._java_obj.extractParamMap())
    return GBTClassificationModel(made)


def cut(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The first ``rounds`` rounds of a fitted ensemble: scores as a fit of so many rounds."""
    trees = list(model._java_obj.trees())
    if not 1 <= rounds <= len(trees):
        raise ValueError(f"{rounds} rounds of {len(trees)}")
    return model if rounds == len(trees) else assemble(model, trees[:rounds], model.treeWeights[:rounds])


def _go_on(model: GBTClassificationModel | GBTClassifier, rows: DataFrame, n_features: int, losses: Sequence[float],
           trees: list, weights: list[float], *, params: dict, patience: int
           ) -> tuple[GBTClassificationModel, list[float]]:
    """Rounds after those of ``trees``, over rows (features, _y, _eval, _m)."""
    more, losses = Rounds(rows, n_features, params=params, offset=len(trees)), list(losses)
    while len(losses) < params["maxIter"] and best_round(losses, patience) is None:
        before = more.next()
        # A job tells the loss of the round before it.
        if len(more.trees) > 1:
            losses.append(before)
        if len(losses) == params["maxIter"] - 1 and best_round(losses, patience) is None:
            losses.append(more.loss())
    done = more.trees[:len(losses) - len(trees)]
    made = assemble(model, trees + [more.jvm(t) for t, _ in done], weights + [w for _, w in done], n_features)
    more.close()
    return made, losses


def boost_on(model: GBTClassificationModel, rows: DataFrame, label: str, validation: str, losses: Sequence[float],
             *, params: dict, patience: int = PATIENCE) -> tuple[GBTClassificationModel, list[float]]:
    """Further rounds until the loss settles or ``maxIter`` is reached: (whole ensemble, all losses).

    ``rows`` has the features, the 0/1 label and the boolean ``validation``.
    """
    raw = model.transform(rows)
    x = raw.select("features", (2.0 * F.col(label) - 1.0).alias("_y"), F.col(validation).alias("_eval"),
                   F.element_at(vector_to_array(model.getRawPredictionCol()), 2).alias("_m"))
    return _go_on(model, x, model.numFeatures, losses, list(model._java_obj.trees()), list(model.treeWeights),
                  params=params, patience=patience)


def fit_boosted(rows: DataFrame, label: str, validation: str | None = None, *, params: dict,
                patience: int = PATIENCE, first_rounds: int = FIRST_ROUNDS,
                dense_bytes: int = DENSE_BYTES) -> tuple[GBTClassificationModel, list[float]]:
    """(model of the best round, evaluation loss of every round fitted).

    ``rows``: features, 0/1 label and the boolean ``validation``; without one
    all of ``maxIter`` rounds are fitted and there are no losses. MLlib fits the
    first rounds where its dense rows take at most ``dense_bytes``.
    """
    if validation is None:
        return GBTClassifier(featuresCol="features", labelCol=label, **params).fit(rows), []
    fit_rows, eval_rows = rows.where(~F.col(validation)), rows.where(F.col(validation))
    if eval_rows.isEmpty():
        raise ValueError("no evaluation rows: boosting can't tell when to stop")
    n_features = rows.select(F.unwrap_udt("features").alias("f")).select(
        F.coalesce("f.size", F.size("f.values"))).first()[0]
    if 4 * n_features * fit_rows.count() > dense_bytes:
        x = rows.select("features", (2.0 * F.col(label) - 1.0).alias("_y"), F.col(validation).alias("_eval"),
                        F.lit(0.0).alias("_m"))
        settings = GBTClassifier(featuresCol="features", labelCol=label, **params)
        model, losses = _go_on(settings, x, n_features, [], [], [], params=params, patience=patience)
        keep = best_round(losses, patience) or 1 + min(range(len(losses)), key=losses.__getitem__)
        return cut(model, keep), losses
    block = dict(params, maxIter=min(first_rounds, params["maxIter"]))
    model = GBTClassifier(featuresCol="features", labelCol=label, **block).fit(fit_rows)
    losses = list(model.evaluateEachIteration(eval_rows))
    if best_round(losses, patience) is None and len(losses) < params["maxIter"]:
        model, losses = boost_on(model, rows, label, validation, losses, params=params, patience=patience)
    keep = best_round(losses, patience) or 1 + min(range(len(losses)), key=losses.__getitem__)
    return cut(model, keep), losses
