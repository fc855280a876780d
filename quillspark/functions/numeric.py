"""Numeric column expressions: thresholds, class scores, indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def soft_threshold(x, l: float) -> Column:
    """sign(x) * max(|x| - l, 0); the +0.0 turns -0.0 into 0.0."""
    x = _c(x)
    return F.signum(x) * F.greatest(F.abs(x) - F.lit(float(l)), F.lit(0.0)) + F.lit(0.0)


def relu(x) -> Column:
    return F.greatest(_c(x), F.lit(0.0))


def soft_threshold_array(arr, l: float) -> Column:
    return F.transform(_c(arr), lambda v: soft_threshold(v, l))


def softmax(scores) -> Column:
    """Class probabilities of a score array, shifted by the row maximum for stability."""
    s = _c(scores)
    m = F.array_max(s)
    e = F.transform(s, lambda v: F.exp(v - m))
    tot = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / tot)


def argmax(scores) -> Column:
    """0-based index of the first largest score."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def log_sum_exp(scores) -> Column:
    s = _c(scores)
    m = F.array_max(s)
    return m + F.log(F.aggregate(F.transform(s, lambda v: F.exp(v - m)), F.lit(0.0),
                                 lambda acc, v: acc + v))


def one_hot(label, k: int) -> Column:
    """Indicator array of a 0..k-1 label."""
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == lab).cast("int"))


def const_array(values) -> Column:
    """A constant double array (folded once by the optimizer)."""
    return F.array(*[F.lit(float(v)) for v in values])
