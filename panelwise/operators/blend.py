"""Combining predictions of several models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelwise.functions.scalar import row_mean


def align(predictions: dict[str, DataFrame], key: str, value: str = "prediction") -> DataFrame:
    """One column per model, joined by key; NULL where a model has no row for a key."""
    named = [p.select(key, F.col(value).alias(n)) for n, p in predictions.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), named)


def ensemble(
    predictions: dict[str, DataFrame],
    key: str,
    weights: dict[str, float] | None = None,
    method: str = "avg",
    value: str = "prediction",
) -> DataFrame:
    """``(key, prediction)``: weighted average, or the smallest or largest prediction of all models.

    A key that one of the models has no prediction for gets NULL, whatever the method.
    """
    names = list(predictions)
    wide = align(predictions, key, value)
    return wide.select(key, combined(names, weights, method).alias("prediction"))


def combined(columns: Sequence[str], weights: dict[str, float] | None = None, method: str = "avg") -> Column:
    """The same over columns of one table."""
    if method in ("min", "max"):
        if len(columns) == 1:
            return F.col(columns[0])
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        return F.when(known, F.least(*columns) if method == "min" else F.greatest(*columns))
    if method != "avg":
        raise ValueError(f"unknown method {method!r}")
    w = {c: 1.0 if weights is None else float(weights[c]) for c in columns}
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w[c]) for c in columns]) / F.lit(sum(w.values()))


def mean_prediction(columns: Sequence[str]) -> Column:
    """Mean of per-fold or per-seed scores: probabilities or log odds, as stored."""
    return row_mean([F.col(c) for c in columns])
