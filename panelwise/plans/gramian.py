"""Sums over pairs of columns, from one scan.

Each task adds up, for every pair of columns, the sums that pairwise statistics need: the rows where both are known, and
over those rows the sums of either column, of their squares and of their product. They are products of a batch's value,
mask and square matrices, kept for the upper half as square tiles of ``TILE`` columns. A task emits its tiles once, at
its end; tiles are then added in two steps, first by tile and a part of the tasks, then by tile, so no step of the sum
holds more than one tile. Tasks are as many as cores (each reads several partitions one after another): what they hold,
and what is shuffled, is 24 bytes per pair of columns and core, 680 MB for 5326 columns.

Values are shifted by a column's mean over at most ``HEAD`` rows first: large means would cost digits, and no pairwise
statistic depends on the shift. NULL and NaN are missing values.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from panelwise.functions.scalar import quoted
from panelwise.plans.ordering import written

TILE = 256
HEAD = 1000
BRANCHES = 16
TILES = "i int, j int, part int, sums binary"

# tasks get this module's code with them; it need not be installed on executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Gramian:
    """Tiles ``(i, j, sums)`` of the upper half, as a written table, with what it takes to read them."""

    columns: list[str]
    tiles: DataFrame
    shift: np.ndarray

    def width(self, tile: int) -> int:
        return min(TILE, len(self.columns) - tile * TILE)


def _numbers(batch: pa.RecordBatch, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shifted values, zero where missing, and where they are known."""
    x = np.empty((batch.num_rows, batch.num_columns))
    for c in range(batch.num_columns):
        x[:, c] = batch.column(c).to_numpy(zero_copy_only=False)
    known = ~np.isnan(x)
    return np.where(known, x - shift, 0.0), known.astype(float)


def _tiles(columns: int) -> list[tuple[int, int]]:
    n = -(-columns // TILE)
    return [(i, j) for i in range(n) for j in range(i, n)]


def gramian(df: DataFrame, columns: Sequence[str]) -> Gramian:
    """One scan of the columns; the rows are never shuffled."""
    columns = list(columns)
    numbers = df.select(*[F.col(quoted(c)).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    head = numbers.limit(HEAD).toPandas().to_numpy(float)
    known = ~np.isnan(head)
    shift = np.where(known, head, 0.0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
    tiles = _tiles(len(columns))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x, k = _numbers(batch, shift)
            square = x * x
            at = [slice(b, b + TILE) for b in range(0, len(shift), TILE)]
            for i, j in tiles:
                a, b = at[i], at[j]
                new = np.stack([k[:, a].T @ k[:, b], x[:, a].T @ k[:, b], square[:, a].T @ k[:, b], x[:, a].T @ x[:, b],
                                k[:, a].T @ x[:, b], k[:, a].T @ square[:, b]])
                sums[i, j] = sums[i, j] + new if (i, j) in sums else new
        part = TaskContext.get().partitionId() % BRANCHES
        for (i, j), s in sums.items():
            yield _row(i, j, part, s)

    cores = df.sparkSession.sparkContext.defaultParallelism
    partials = numbers.coalesce(cores).mapInArrow(partial, TILES)
    branches = partials.repartition("i", "j", "part").sortWithinPartitions("i", "j", "part").mapInArrow(_added, TILES)
    whole = branches.withColumn("part", F.lit(0)).repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(_added, TILES)
    return Gramian(columns, written(whole.drop("part"), "gramian"), shift)


def _row(i: int, j: int, part: int, sums: np.ndarray) -> pa.RecordBatch:
    values = [pa.array([v], t) for v, t in ((i, pa.int32()), (j, pa.int32()), (part, pa.int32()), (sums.tobytes(), pa.binary()))]
    return pa.RecordBatch.from_arrays(values, ["i", "j", "part", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of equal place and part added up; they stand next to each other."""
    held, sums = None, None
    for batch in batches:
        for r in range(batch.num_rows):
            place = tuple(batch.column(c)[r].as_py() for c in range(3))
            new = np.frombuffer(batch.column(3)[r].as_buffer())
            if place == held:
                sums = sums + new
                continue
            if held is not None:
                yield _row(*held, sums)
            held, sums = place, new
    if held is not None:
        yield _row(*held, sums)


def _unpacked(payload: bytes, rows: int, columns: int) -> tuple[np.ndarray, ...]:
    """``n, x_i, xx_i, xy, x_j, xx_j`` of a tile, each over the rows where both columns are known."""
    return tuple(np.frombuffer(payload).reshape(6, rows, columns))


def _correlation(payload: bytes, rows: int, columns: int) -> np.ndarray:
    """Pairwise correlations of a tile; NaN where a column does not vary or less than two rows know both."""
    n, x, xx, xy, y, yy = _unpacked(payload, rows, columns)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = (n * xy - x * y) / np.sqrt((n * xx - x * x) * (n * yy - y * y))
    return np.where(np.isfinite(out), np.clip(out, -1.0, 1.0), np.nan)


def correlations(found: Gramian, above: float | None = None) -> DataFrame:
    """``(a, b, corr)``: column numbers ``a < b``, pairwise complete; with ``above`` only pairs beyond it in size."""
    width = [found.width(t) for t in range(-(-len(found.columns) // TILE))]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, payload in zip(*(c.to_pylist() for c in batch.columns)):
                corr = _correlation(payload, width[i], width[j])
                a, b = np.indices(corr.shape)
                a, b = a + i * TILE, b + j * TILE
                kept = a < b
                if above is not None:
                    kept &= np.abs(corr) > above
                values = corr[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[kept].astype(np.int32)), pa.array(b[kept].astype(np.int32)), pa.array(values, mask=np.isnan(values))], ["a", "b", "corr"]
                )

    return found.tiles.select("i", "j", "sums").mapInArrow(pairs, "a int, b int, corr double")


def mean_filled(found: Gramian) -> tuple[np.ndarray, np.ndarray]:
    """Means and co-moments of the columns with missing values at their mean (a matrix on the driver).

    The co-moment of two columns is the sum of the products of their distances from their means, over rows that know
    both; all other rows add nothing.
    """
    size = len(found.columns)
    moments, means = np.zeros((size, size)), np.zeros(size)
    payloads = {(r["i"], r["j"]): r["sums"] for r in found.tiles.where("i = j").collect()}
    for (t, _), payload in payloads.items():
        n, x, *_ = (np.diagonal(m) for m in _unpacked(payload, found.width(t), found.width(t)))
        means[t * TILE : t * TILE + len(n)] = x / np.maximum(n, 1)
    for r in found.tiles.toLocalIterator():
        i, j = r["i"], r["j"]
        n, x, _, xy, y, _ = _unpacked(r["sums"], found.width(i), found.width(j))
        a, b = slice(i * TILE, i * TILE + n.shape[0]), slice(j * TILE, j * TILE + n.shape[1])
        block = xy - means[a][:, None] * y - x * means[b] + n * means[a][:, None] * means[b]
        moments[a, b] = block
        moments[b, a] = block.T
    return means + found.shift, moments
