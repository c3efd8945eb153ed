"""Text classifiers on MLlib.

All training and scoring runs on Spark: the featurizer is a fitted
vocabulary turned into MLlib stages (``features.featurizer``), the
classifiers are MLlib estimators, and scoring is ``PipelineModel.transform``.
The fitted vocabulary is saved with the model, so a model is fit once and
applied to any later batch with the same feature indices.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailcase.functions.labels import BINARY, LabelSet, decode
from mailcase.functions.scores import argmax, log_softmax
from mailcase.operators.boosting import PATIENCE, best_round, fit_boosted
from mailcase.operators.features import MAX_FEATURES, fit_featurizer
from mailcase.operators.metrics import focal_loss
from mailcase.operators.profile import class_weights
from mailcase.session import materialize, written

# Boosted-tree settings of the reference (rounds, depth, rate, sampling, seed).
GBT_PARAMS = dict(maxIter=300, maxDepth=3, stepSize=0.1, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)


def _with_features(train: DataFrame, key: str, text: str, cols: Sequence[str], max_features: int,
                   vocabulary_rows=None) -> tuple[PipelineModel, DataFrame]:
    """(featurizer stages, training rows as (cols..., features)).

    The text is prepared once and written, as the vocabulary reads it twice
    and the features once more; the vectors are checkpointed, so every later
    pass reads them instead of the text. ``vocabulary_rows``: condition on the
    rows that shape the vocabulary.
    """
    rows = written(train.select(key, text, *cols), "training")
    shaping = rows if vocabulary_rows is None else rows.where(vocabulary_rows)
    feat, _ = fit_featurizer(shaping, key, text, max_features=max_features)
    return feat, materialize(feat.transform(rows).select(*cols, "features"))


def train_gbt(train: DataFrame, key: str, text: str, label: str, *,
              validation: str | None = None, patience: int = PATIENCE,
              max_features: int = MAX_FEATURES, params: dict | None = None) -> PipelineModel:
    """M4 + M5: binary boosted trees on TF-IDF; ``validation`` names a boolean
    column marking the early-stopping evaluation rows.

    Boosting stops when ``patience`` rounds in a row did not lower the loss of
    the evaluation rows, and the best round is kept (``rounds``)."""
    return train_gbt_logged(train, key, text, label, validation=validation, patience=patience,
                            max_features=max_features, params=params)[0]


def train_gbt_logged(train: DataFrame, key: str, text: str, label: str, *,
                     validation: str | None = None, patience: int = PATIENCE,
                     max_features: int = MAX_FEATURES, params: dict | None = None
                     ) -> tuple[PipelineModel, list[float]]:
    """``train_gbt`` and the evaluation loss of each round."""
    cols = [label] + ([validation] if validation else [])
    # The evaluation rows stay out of the vocabulary and of the trees.
    feat, x = _with_features(train, key, text, cols, max_features, ~F.col(validation) if validation else None)
    model, losses = fit_boosted(_labelled(x, label, BINARY), label, validation,
                                params=dict(GBT_PARAMS, **(params or {})), patience=patience)
    return PipelineModel(feat.stages + [model]), losses


def rounds(model: PipelineModel) -> int:
    """Boosting rounds of a trained model."""
    return len(model.stages[-1].treeWeights)


def loss_table(spark: SparkSession, losses: Sequence[float], kept: int) -> DataFrame:
    """(round, loss, kept): one row per round fitted."""
    return spark.createDataFrame([(i, float(v), i <= kept) for i, v in enumerate(losses, 1)],
                                 "round int, loss double, kept boolean")


def _labelled(x: DataFrame, label: str, label_set: LabelSet) -> DataFrame:
    """The training rows with the label column marked as one of the set's classes,
    so a model has all of them even if the last ones never occur. Labels
    outside the set (or null) are an error, not dropped."""
    n = len(label_set)
    bad = x.where(F.col(label).isNull() | ~F.col(label).between(0, n - 1)).count()
    if bad:
        raise ValueError(f"{bad} training rows have a label outside {label_set.name} (0..{n - 1})")
    meta = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(c) for c in label_set.classes]}}
    return x.withColumn(label, F.col(label).cast("double").alias(label, metadata=meta))


def train_logistic(train: DataFrame, key: str, text: str, label: str, label_set: LabelSet, *,
                   weighted: bool = False, max_features: int = MAX_FEATURES,
                   max_iter: int = 100, reg: float = 0.0) -> PipelineModel:
    """M6 / M7: logistic regression (multinomial when more than two classes);
    ``weighted`` adds A8 inverse-frequency class weights as ``weightCol``."""
    feat, x = _with_features(train, key, text, [label], max_features)
    x = _labelled(x, label, label_set)
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                            regParam=reg, family="multinomial" if len(label_set) > 2 else "auto")
    if weighted:
        # One weight per class of the label set, as a literal array: no join, no row lost.
        w = F.array(*[F.lit(v) for v in _class_weights(x, label, label_set)])
        x = x.withColumn("_w", F.element_at(w, F.col(label).cast("int") + 1))
        lr.setWeightCol("_w")
    model = lr.fit(x)
    return PipelineModel(feat.stages + [model])


def _class_weights(x: DataFrame, label: str, label_set: LabelSet) -> list[float]:
    """A8 weight of each class of the set, 0 for one without rows."""
    w = {int(r["class_id"]): r["weight"] or 0.0 for r in class_weights(x, label, label_set).collect()}
    return [float(w.get(i, 0.0)) for i in range(len(label_set))]


def train_focal(train: DataFrame, key: str, text: str, label: str, label_set: LabelSet, *,
                gamma: float = 2.0, weighted: bool = False, max_features: int = MAX_FEATURES,
                max_iter: int = 100, reg: float = 0.01, max_rounds: int = 20, tol: float = 1e-4
                ) -> tuple[PipelineModel, DataFrame]:
    """M7 with the focal objective (E14): (model, (round, focal_loss, kept)).

    Iteratively reweighted logistic regression. A row's slope is that of its
    focal loss against its cross-entropy; weights equal to the slopes leave the
    focal loss no way down. Round 0 is the plain fit. Each round moves the
    weights of the best fit so far a step towards its slopes (scaled to a mean
    of 1) and fits again; a step that does not lower the focal loss of the
    training rows is halved. Rounds end when the loss falls by less than
    ``tol`` of its value, after three halvings in a row, or at ``max_rounds``;
    the best round is kept. ``weighted`` adds the class weights (A8), scaled to
    a mean of 1 a class.
    """
    feat, x = _with_features(train, key, text, [label], max_features)
    x = _labelled(x, label, label_set)
    meta = x.schema[label].metadata
    alpha = _class_weights(x, label, label_set) if weighted else [1.0] * len(label_set)
    alpha = [a * len(alpha) / sum(alpha) for a in alpha]
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="_w", maxIter=max_iter,
                            regParam=reg, family="multinomial")
    y = F.col(label).cast("int") + 1
    a = F.element_at(F.array(*[F.lit(v) for v in alpha]), y)
    rows, best, log, step, halved = x.withColumn("_w", a), None, [], 1.0, 0
    for i in range(max_rounds + 1):
        model = lr.fit(rows)
        raw = model.transform(rows).withColumn("_z", vector_to_array(model.getRawPredictionCol()))
        loss = focal_loss(raw, label, "_z", gamma, alpha).first()[0]
        log.append(loss)
        if best is None or loss < best[1]:
            settled = best is not None and loss >= best[1] * (1.0 - tol)
            best, halved = (model, loss, i), 0
            if settled:
                break
            ce = -a * F.element_at(log_softmax("_z"), y)
            pt = F.exp(-ce)
            rest = F.greatest(1.0 - pt, F.lit(1e-12))
            slope = a * (F.pow(rest, F.lit(gamma)) + gamma * ce * pt * F.pow(rest, F.lit(gamma - 1.0)))
            # Checkpointed: the next fits read weights and slopes in each of their passes.
            at = materialize(raw.select(label, "features", "_w", slope.alias("_s")))
            mean = at.agg(F.avg("_s") / F.avg("_w")).first()[0]
        else:
            step, halved = step / 2.0, halved + 1
            if halved > 3:
                break
        if not mean:
            break
        mixed = (1.0 - step) * F.col("_w") + step / mean * F.col("_s")
        rows = at.select(F.col(label).alias(label, metadata=meta), "features", mixed.alias("_w"))
    table = train.sparkSession.createDataFrame([(i, float(v), i == best[2]) for i, v in enumerate(log)],
                                               "round int, focal_loss double, kept boolean")
    return PipelineModel(feat.stages + [best[0]]), table


def train_two_heads(train: DataFrame, key: str, text: str, bin_label: str, mc_label: str,
                    label_set: LabelSet, max_features: int = MAX_FEATURES,
                    max_iter: int = 100) -> tuple[PipelineModel, PipelineModel]:
    """M8: one shared feature stage, two logistic heads (binary and multiclass)."""
    feat, x = _with_features(train, key, text, [bin_label, mc_label], max_features)
    x = _labelled(_labelled(x, bin_label, BINARY), mc_label, label_set)
    hb = LogisticRegression(featuresCol="features", labelCol=bin_label, maxIter=max_iter,
                            predictionCol="pred_b", probabilityCol="prob_b",
                            rawPredictionCol="raw_b").fit(x)
    hm = LogisticRegression(featuresCol="features", labelCol=mc_label, maxIter=max_iter,
                            family="multinomial", predictionCol="pred_m",
                            probabilityCol="prob_m", rawPredictionCol="raw_m").fit(x)
    return PipelineModel(feat.stages + [hb]), PipelineModel(feat.stages + [hm])


def score(model: PipelineModel, df: DataFrame, label_set: LabelSet | None = None,
          keep: Sequence[str] = ()) -> DataFrame:
    """M9: (keep..., probs, pred, confidence[, pred_name]) for every row."""
    out = model.transform(df)
    prob_col = model.stages[-1].getProbabilityCol()
    s = out.select(*keep, vector_to_array(prob_col).alias("probs"))
    s = s.withColumns({"pred": argmax("probs"), "confidence": F.array_max("probs")})
    if label_set is not None:
        s = s.withColumn("pred_name", decode("pred", label_set))
    return s


#: Characters of a slice of an Arrow batch that a hosted model scores at once.
SLICE_CHARS = 1 << 22

_hosted: dict[str, Callable] = {}


def hosted(path: str, load: Callable[[bytes], Callable], content: bytes) -> Callable:
    """A model loaded once per Python worker, told apart by its path and content."""
    name = f"{path}:{hash(content)}"
    if name not in _hosted:
        _hosted[name] = load(content)
    return _hosted[name]


def score_external(df: DataFrame, text: str, path: str, load: Callable[[bytes], Callable], n_classes: int,
                   keep: Sequence[str] = (), *, batch_chars: int = 1 << 20) -> DataFrame:
    """M9 for a model outside Spark, saved as files under ``path`` in shared storage.

    Spark reads the files (so any store it knows will do) and sends their
    bytes to the tasks; ``load(bytes)`` runs once per Python worker and returns
    ``predict(list of texts) -> array (n, C)``. The rows of an Arrow batch are
    taken in slices of about ``SLICE_CHARS``; the texts of a slice are sorted by
    length and predicted in batches of at most ``batch_chars`` characters (or
    one text), so that texts of a batch are of like length; rows keep their
    order. Kept columns stay in Arrow. A null text is predicted as ''.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    spark = df.sparkSession
    files = spark.read.format("binaryFile").load(path).orderBy("path").select("content").collect()
    sent = spark.sparkContext.broadcast(b"".join(bytes(r["content"]) for r in files))
    keep = list(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in
                        df.select(*keep).schema.fields] + ["probs array<double>"])

    def predicted(predict, column):
        texts = [t if t is not None else "" for t in column.to_pylist()]
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        probs, i = np.zeros((len(texts), n_classes)), 0
        while i < len(order):
            j, held = i, 0
            while j < len(order) and (j == i or held + len(texts[order[j]]) <= batch_chars):
                held += len(texts[order[j]])
                j += 1
            probs[order[i:j]] = np.asarray(predict([texts[k] for k in order[i:j]]), dtype=float)
            i = j
        offsets = np.arange(0, probs.size + 1, n_classes, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, probs.ravel())

    def run(batches):
        predict = hosted(path, load, sent.value)
        for b in batches:
            sizes = pc.fill_null(pc.utf8_length(b.column("_text")), 0).to_numpy(zero_copy_only=False)
            for at, end in slices(sizes, SLICE_CHARS):
                part = b.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], predicted(predict, part.column("_text"))],
                                                 names=[*keep, "probs"])

    s = df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
    return s.withColumns({"pred": argmax("probs"), "confidence": F.array_max("probs")})


def slices(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Ranges of rows whose sizes add up to at most ``most`` (or one row)."""
    found, at, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > most:
            found.append((at, i))
            at, held = i, 0
        held += n
    return found + [(at, len(sizes))] if len(sizes) else found


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.getActiveSession()


def feature_importance(model: PipelineModel, k: int = 20, *, spark: SparkSession | None = None) -> DataFrame:
    """Top ``k`` (term, importance) of a tree model, ties by term.

    The importance vector has one entry per vocabulary term (bounded by
    ``max_features``), so it is turned into a DataFrame on the driver.
    """
    cv = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(t, float(v)) for t, v in zip(cv.vocabulary, imp)]
    df = _session(spark).createDataFrame(rows, "term string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("term").asc()).limit(k)


# ------------------------------------------------------------ prediction tables

def prediction_table(scored: DataFrame, subject: str = "Subject", body: str = "TextBody",
                     label: str = "label", positive: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., Subject, TextBody, True_Label, Predicted_Label, Complaint_Probability)."""
    return scored.select(*keep, F.col(subject).alias("Subject"), F.col(body).alias("TextBody"),
                         F.col(label).alias("True_Label"), F.col("pred").alias("Predicted_Label"),
                         F.element_at("probs", positive + 1).alias("Complaint_Probability"))


def class_table(scored: DataFrame, label_set: LabelSet, subject: str = "Subject",
                keep: Sequence[str] = ()) -> DataFrame:
    """E19, compact: (keep..., Subject, Predicted_Class, Confidence)."""
    return scored.select(*keep, F.col(subject).alias("Subject"),
                         decode("pred", label_set).alias("Predicted_Class"), F.col("confidence").alias("Confidence"))


def confidence_table(scored: DataFrame, label_set: LabelSet, label: str = "label",
                     keep: Sequence[str] = ()) -> DataFrame:
    """E19, compact: (keep..., predicted_label, confidence, true_label), labels by name."""
    return scored.select(*keep, decode("pred", label_set).alias("predicted_label"), "confidence",
                         decode(label, label_set).alias("true_label"))


# ------------------------------------------------------------ saved models

def _manifests(spark: SparkSession, root: str, name: str) -> list[dict]:
    """Published versions, the oldest first. A manifest is one short row."""
    path = f"{root.rstrip('/')}/{name}/published"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return []
    rows = spark.read.schema("name string, version long, at long, data string, label_set string, classes array<string>"
                             ).json(f"{path}/*").collect()
    return sorted((r.asDict() for r in rows), key=lambda m: (m["version"], m["at"], m["data"]))


def save_model(model: PipelineModel, root: str, name: str, version: int | None = None,
               label_set: LabelSet | None = None, *, spark: SparkSession | None = None) -> int:
    """Publish a model under ``root/name`` with its label set; returns the version.

    The model is written aside, in a folder of its own, and becomes visible
    only with its manifest, which is written last. A save that dies before
    leaves the published versions as they are, and so does saving a version
    again. Without ``version`` it is the one after the latest.
    """
    spark = _session(spark)
    known = _manifests(spark, root, name)
    if version is None:
        version = 1 + max((m["version"] for m in known), default=0)
    base, data = f"{root.rstrip('/')}/{name}", uuid.uuid4().hex
    model.write().save(f"{base}/data/{data}")
    row = (name, int(version), max([time.time_ns(), *(m["at"] + 1 for m in known)]), data,
           label_set.name if label_set else None, list(label_set.classes) if label_set else None)
    spark.createDataFrame([row], "name string, version long, at long, data string, label_set string, "
                                 "classes array<string>").coalesce(1).write.json(f"{base}/published/v{version}-{data}")
    return int(version)


def latest_version(root: str, name: str, *, spark: SparkSession | None = None) -> int | None:
    """The highest published version; None if there is none."""
    return max((m["version"] for m in _manifests(_session(spark), root, name)), default=None)


def load_model(root: str, name: str, version: int | None = None, *, spark: SparkSession | None = None
               ) -> tuple[PipelineModel, LabelSet | None]:
    """(model, label set) of a published version, by default the latest; of a
    version saved more than once, its last save."""
    found = [m for m in _manifests(_session(spark), root, name) if version is None or m["version"] == int(version)]
    if not found:
        raise LookupError(f"no published model {name}" + (f" version {version}" if version is not None else ""))
    m = found[-1]
    model = PipelineModel.load(f"{root.rstrip('/')}/{name}/data/{m['data']}")
    return model, LabelSet(m["label_set"], tuple(m["classes"])) if m["classes"] else None


__all__ = ["GBT_PARAMS", "GBTClassificationModel", "best_round", "class_table", "confidence_table",
           "feature_importance", "latest_version", "load_model", "loss_table", "prediction_table", "rounds",
           "save_model", "score", "score_external", "train_focal", "train_gbt", "train_gbt_logged",
           "train_logistic", "train_two_heads"]
