"""Score transforms on logit / probability arrays.

All are higher-order array expressions evaluated row by row on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailcase.functions.labels import LabelSet


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def softmax(logits) -> Column:
    """``exp(x - max) / sum(exp(x - max))`` per row."""
    x = _col(logits).cast("array<double>")
    m = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - m))
    s = _sum(e)
    return F.transform(e, lambda v: v / s)


def log_softmax(logits) -> Column:
    """``x - max - log(sum(exp(x - max)))`` per row."""
    x = _col(logits).cast("array<double>")
    m = F.array_max(x)
    lse = F.log(_sum(F.transform(x, lambda v: F.exp(v - m))))
    return F.transform(x, lambda v: v - m - lse)


def argmax(arr) -> Column:
    """0-based index of the largest element, first one on ties."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def sigmoid_positive(x, threshold: float = 0.5) -> Column:
    """``sigmoid(x) >= threshold`` as 0/1."""
    return (sigmoid(x) >= F.lit(threshold)).cast("int")


def confidence(probs) -> Column:
    """probability of the winning class."""
    return F.array_max(_col(probs))


def probability_map(probs, label_set: LabelSet) -> Column:
    """class name -> probability."""
    return F.map_from_arrays(label_set.names(), _col(probs))
