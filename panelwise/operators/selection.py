"""Choosing or condensing features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwise.functions.scalar import quoted
from panelwise.plans.gramian import Gramian, correlations, gramian, mean_filled


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, corr)`` for every pair, over the rows where both are known; NULL where a column does not vary.

    One scan, whatever the number of columns; no rows are shuffled.
    """
    found = correlations(gramian(df, columns))
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(names[F.col("a")].alias("a"), names[F.col("b")].alias("b"), "corr")


def _mean_filled_correlation(found: Gramian) -> np.ndarray:
    _, moments = mean_filled(found)
    size = np.sqrt(np.diagonal(moments))
    with np.errstate(invalid="ignore", divide="ignore"):
        return moments / size[:, None] / size


def correlation_filter(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Columns left after dropping, in list order, each one correlated above the threshold with a kept one.

    Missing values count as the column mean. One scan; the matrix is columns by columns, whatever the row count.
    """
    close = np.abs(_mean_filled_correlation(gramian(df, columns))) > threshold
    kept: list[int] = []
    for i in range(len(columns)):
        if not close[i, kept].any():
            kept.append(i)
    return [columns[i] for i in kept]


@dataclass
class Axes:
    """Leading principal axes: one column per component, with the variance along each."""

    columns: list[str]
    means: np.ndarray
    directions: np.ndarray
    variances: np.ndarray


def principal_axes(df: DataFrame, columns: Sequence[str], components: int) -> Axes:
    """Axes of the largest variance, missing values at their column's mean; one scan.

    Each axis points to where its largest coefficient is positive.
    """
    means, moments = mean_filled(gramian(df, columns))
    rows = max(2, df.count())
    values, vectors = np.linalg.eigh(moments / (rows - 1))
    order = np.argsort(-values, kind="stable")[:components]
    directions = vectors[:, order]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    return Axes(list(columns), means, directions * np.where(signs == 0, 1, signs), np.maximum(values[order], 0))


def project(df: DataFrame, axes: Axes, key: str) -> DataFrame:
    """``(key, pca_0, pca_1, ...)``: rows on the axes, without centring."""
    names = [f"pca_{i}" for i in range(axes.directions.shape[1])]
    numbers = df.select(key, *[F.col(quoted(c)).cast("double").alias(f"_{i}") for i, c in enumerate(axes.columns)])
    means, directions = axes.means, axes.directions

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1).astype(float)
            on = np.where(np.isnan(x), means, x) @ directions
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, on.T.copy())], [batch.schema.names[0], *names])

    kind = df.schema[key].dataType.simpleString()
    return numbers.mapInArrow(task, f"{quoted(key)} {kind}, " + ", ".join(f"{n} double" for n in names))


def pca(df: DataFrame, columns: Sequence[str], key: str, components: int) -> DataFrame:
    """``(key, pca_0, pca_1, ...)``: projections on the leading principal axes."""
    return project(df, principal_axes(df, columns, components), key)
