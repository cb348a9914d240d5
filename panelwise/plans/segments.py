"""Statistics of many columns per key, from rows sorted by key: whole Arrow batches at once.

Spark brings the rows of a key together and sorts them by key and row order, with spill; a task then sees each key as
a stretch of neighbouring rows. All columns of a batch are reduced by the stretches' boundaries in a few array
operations, so the cost of a further column is that of its values, not of one more aggregate. A key that goes on in
the next batch is carried over, and nothing but such keys is held: memory is bounded by one batch, the largest key
(``plans.skew`` keeps larger keys out), and ``CELLS_AT_ONCE`` cells of work space.

Medians are picked from sorted stretches: stretches of similar length are laid out side by side, sorted together, and
their middle ranks read. No value lists are built on the JVM heap.

Missing values are skipped as in SQL: NULL is unknown, NaN is a value larger than any other.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from panelwise.functions.scalar import quoted

CELLS_AT_ONCE = 1 << 21
MICROS_PER_DAY = 86_400_000_000
NUMBERS = {"mean", "std", "sum", "median"}  # statistics that need a number
DOUBLES = {"mean", "std", "median"}
COUNTS = {"count", "nunique"}
FLOATS, INTS, TIMES = (T.FloatType, T.DoubleType), (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.TimestampType, T.TimestampNTZType)
_ARROW = {
    T.DoubleType: pa.float64(), T.FloatType: pa.float32(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.ShortType: pa.int16(), T.ByteType: pa.int8()
}
GAP_COLUMN = -1  # days since the previous row, computed from the timestamps

# tasks get this module's code with them; it need not be installed on executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class RowSet:
    """Rows of a key that a statistic looks at: all but the ``n`` newest (``older``), the ``n``-th newest (``at``), or
    those less than ``n`` days older than the newest (``within``)."""

    kind: str
    n: int

    def mask(self, age: np.ndarray, ts: np.ndarray, newest: np.ndarray) -> np.ndarray:
        if self.kind == "older":
            return age > self.n
        if self.kind == "at":
            return age == self.n
        known = (ts != _UNKNOWN) & (newest != _UNKNOWN)
        return known & (newest - np.where(known, ts, newest) < self.n * MICROS_PER_DAY)


@dataclass(frozen=True)
class Wanted:
    """One statistic: of the column at ``column`` (or of the gaps), over ``rows`` (None: all)."""

    stat: str
    column: int
    rows: RowSet | None


_UNKNOWN = np.iinfo(np.int64).min


def suits(stat: str, kind: T.DataType) -> bool:
    """Whether this module computes the statistic for a column of that type as SQL does."""
    return stat not in NUMBERS or isinstance(kind, FLOATS + INTS)


def result_type(stat: str, kind: T.DataType) -> T.DataType:
    if stat in DOUBLES:
        return T.DoubleType()
    if stat in COUNTS:
        return T.LongType()
    if stat == "sum":
        return T.LongType() if isinstance(kind, INTS) else T.DoubleType()
    return kind


def reduce_sorted(
    rows: DataFrame, key: str, order: Sequence[str], ts: str, columns: Sequence[str], wanted: Sequence[Wanted], names: Sequence[str]
) -> DataFrame:
    """One row per key with a column per wanted statistic.

    ``columns`` are SQL expressions over a row; ``order`` sorts the rows of a key, oldest first; ``ts`` is its first
    column. Rows are shuffled by key once.
    """
    sorts = [f"_order_{i}" for i in range(len(order))]
    shipped = (
        rows.selectExpr(
            quoted(key), *[f"{quoted(c)} AS {o}" for c, o in zip(order, sorts)], f"{quoted(ts)} AS _time", *[f"{x} AS _value_{i}" for i, x in enumerate(columns)]
        )
        .repartition(key)
        .sortWithinPartitions(key, *sorts)
        .drop(*sorts)
    )
    kinds = {GAP_COLUMN: T.IntegerType(), **{i: shipped.schema[f"_value_{i}"].dataType for i in range(len(columns))}}
    timed = isinstance(shipped.schema["_time"].dataType, TIMES)
    if not timed:
        shipped = shipped.withColumn("_time", F.lit(False))  # not read
    schema = T.StructType(
        [T.StructField(key, shipped.schema[key].dataType), *[T.StructField(n, result_type(w.stat, kinds[w.column])) for n, w in zip(names, wanted)]]
    )
    plan = _plan(wanted, kinds)
    like = [(w, field.dataType) for w, field in zip(wanted, schema.fields[1:])]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_keys(batches):
            found, keys = _reduced(whole, plan, timed)
            arrays = [keys, *(_typed(found[w], t) for w, t in like)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return shipped.mapInArrow(task, schema)


def _plan(wanted: Sequence[Wanted], kinds: dict[int, T.DataType]) -> dict[tuple, list[int]]:
    """Columns that are reduced alike: (class of type, ((row set, statistics), ...)) -> columns."""
    by_column: dict[int, dict[RowSet | None, set[str]]] = {}
    for w in wanted:
        by_column.setdefault(w.column, {}).setdefault(w.rows, set()).add(w.stat)
    out: dict[tuple, list[int]] = {}
    for column, sets in by_column.items():
        kind = kinds[column]
        name = "float" if isinstance(kind, FLOATS) else "int" if isinstance(kind, INTS) else "other"
        stats = tuple(sorted(((r, tuple(sorted(s))) for r, s in sets.items()), key=repr))
        out.setdefault((name, stats), []).append(column)
    return out


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, cut so that no key is spread over two batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(_starts(batch.column(0))[-1])
        if held and not last and held[-1].column(0)[-1].equals(batch.column(0)[0]):
            held.append(batch)
            continue
        done = [*held, batch.slice(0, last)] if last else held
        if done:
            yield _joined(done)
        held = [batch.slice(last)]
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _starts(keys: pa.Array) -> np.ndarray:
    """Where each stretch of equal keys begins."""
    changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(changes.astype(bool)) + 1]


def _known(column: pa.Array) -> np.ndarray:
    return column.is_valid().to_numpy(zero_copy_only=False)


def _micros(column: pa.Array) -> np.ndarray:
    return column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64()).fill_null(int(_UNKNOWN)).to_numpy(zero_copy_only=False)


def _reduced(batch: pa.RecordBatch, plan: dict[tuple, list[int]], timed: bool) -> tuple[dict[Wanted, tuple], pa.Array]:
    n = batch.num_rows
    starts = _starts(batch.column(0))
    sizes = np.diff(np.r_[starts, n])
    stretches = _Stretches(starts, sizes)
    ts = _micros(batch.column(1)) if timed else np.full(n, _UNKNOWN)
    newest = np.repeat(ts[starts + sizes - 1], sizes)
    found: dict[Wanted, tuple] = {}
    for (kind, sets), columns in plan.items():
        width = max(1, CELLS_AT_ONCE // n) if kind != "other" else 1
        for begin in range(0, len(columns), width):
            chosen = columns[begin : begin + width]
            block = _column_block(batch, chosen, kind, ts, stretches)
            for rows, stats in sets:
                part = block if rows is None else block.where(rows.mask(stretches.age, ts, newest))
                for stat in stats:
                    values = part.reduce(stat, stretches)
                    for i, c in enumerate(chosen):
                        found[Wanted(stat, c, rows)] = values(i)
    return found, batch.column(0).take(pa.array(starts))


def _gaps(ts: np.ndarray, stretches: _Stretches) -> tuple[np.ndarray, np.ndarray]:
    gaps = np.zeros(len(ts), np.int64)
    known = np.zeros(len(ts), bool)
    known[1:] = (ts[1:] != _UNKNOWN) & (ts[:-1] != _UNKNOWN)
    known[stretches.starts] = False
    gaps[1:] = np.where(known[1:], ts[1:] - np.where(known[1:], ts[:-1], 0), 0) // MICROS_PER_DAY
    return gaps, known


def _column_block(batch: pa.RecordBatch, columns: list[int], kind: str, ts: np.ndarray, stretches: _Stretches) -> _Block | _Other:
    if kind == "other":
        return _Other(batch.column(2 + columns[0]))
    values = np.zeros((batch.num_rows, len(columns)), np.float64 if kind == "float" else np.int64)
    known = np.ones(values.shape, bool)
    for i, c in enumerate(columns):
        if c == GAP_COLUMN:
            values[:, i], known[:, i] = _gaps(ts, stretches)
            continue
        column = batch.column(2 + c)
        if column.null_count:
            known[:, i] = _known(column)
            column = column.fill_null(0)
        values[:, i] = column.to_numpy(zero_copy_only=False)
    return _Block(values, known)


class _Stretches:
    """Where the keys lie in a batch."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.starts, self.sizes = starts, sizes
        self.number = np.repeat(np.arange(len(starts)), sizes)
        self.age = (starts + sizes)[self.number] - np.arange(len(self.number))  # 1 for the newest row

    def by_length(self) -> Iterator[tuple[np.ndarray, int]]:
        """Stretches whose lengths lie between the same powers of two, and the longest length among them."""
        order = np.ceil(np.log2(self.sizes)).astype(int)
        for step in np.unique(order):
            chosen = np.flatnonzero(order == step)
            yield chosen, int(self.sizes[chosen].max())


class _Block:
    """Numeric columns side by side: values (zero where unknown) and where they are known."""

    def __init__(self, values: np.ndarray, known: np.ndarray) -> None:
        self.values, self.known = values, known
        self._kept: dict[str, np.ndarray] = {}

    def where(self, mask: np.ndarray) -> _Block:
        known = self.known & mask[:, None]
        return _Block(np.where(known, self.values, 0), known)

    def reduce(self, stat: str, at: _Stretches):
        """A function from the column's place to (values per stretch, which of them are known)."""
        values, known = getattr(self, "_" + stat)(at)
        return lambda i: (values[:, i], None if known is None else known[:, i])

    def _once(self, name: str, make) -> np.ndarray:
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def _n(self, at: _Stretches) -> np.ndarray:
        return self._once("n", lambda: np.add.reduceat(self.known, at.starts, axis=0, dtype=np.int64))

    def _total(self, at: _Stretches) -> np.ndarray:
        return self._once("total", lambda: np.add.reduceat(self.values, at.starts, axis=0, dtype=np.float64))

    def _count(self, at):
        return self._n(at), None

    def _sum(self, at):
        return (self._total(at) if self.values.dtype.kind == "f" else np.add.reduceat(self.values, at.starts, axis=0)), None

    def _mean(self, at):
        n = self._n(at)
        return self._once("mean", lambda: self._total(at) / np.maximum(n, 1)), n > 0

    def _std(self, at):
        n = self._n(at)
        away = np.where(self.known, self.values - self._mean(at)[0][at.number], 0.0)
        return np.sqrt(np.add.reduceat(away * away, at.starts, axis=0) / np.maximum(n - 1, 1)), n > 1

    def _limits(self) -> tuple:
        kind = self.values.dtype
        return (-np.inf, np.inf) if kind.kind == "f" else (np.iinfo(kind).min, np.iinfo(kind).max)

    def _max(self, at):
        return np.maximum.reduceat(np.where(self.known, self.values, self._limits()[0]), at.starts, axis=0), self._n(at) > 0

    def _min(self, at):
        filled = np.where(self.known, self.values, self._limits()[1])
        least = np.fmin.reduceat(filled, at.starts, axis=0)
        if self.values.dtype.kind == "f" and np.isnan(self.values).any():  # only NaN is known: the minimum is NaN
            real = np.add.reduceat(self.known & ~np.isnan(self.values), at.starts, axis=0, dtype=np.int64)
            least = np.where((real == 0) & (self._n(at) > 0), np.nan, least)
        return least, self._n(at) > 0

    def _median(self, at):
        """Stretches of similar length as rows of a table, sorted with unknown values last; then the middle ranks."""
        n = self._n(at)
        out = np.zeros(n.shape)
        filled = np.append(np.where(self.known, self.values, np.nan), np.full((1, self.values.shape[1]), np.nan), axis=0)
        for chosen, length in at.by_length():
            some = max(1, CELLS_AT_ONCE // (length * filled.shape[1]))
            for begin in range(0, len(chosen), some):
                part = chosen[begin : begin + some]
                place = at.starts[part][:, None] + np.arange(length)
                place[np.arange(length) >= at.sizes[part][:, None]] = len(filled) - 1
                table = np.sort(filled[place].transpose(0, 2, 1), axis=2)
                low, high = np.maximum(n[part] - 1, 0) // 2, np.minimum(n[part] // 2, length - 1)
                pick = [np.take_along_axis(table, r[:, :, None], axis=2)[:, :, 0] for r in (low, high)]
                out[part] = (pick[0] + pick[1]) / 2
        return out, n > 0

    def _picked(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = (place >= 0) & (place < len(self.values))
        return self.values[np.where(known, place, 0), np.arange(place.shape[1])], known

    def _last(self, at):
        row = np.arange(len(self.values))[:, None]
        return self._picked(np.maximum.reduceat(np.where(self.known, row, -1), at.starts, axis=0))

    def _first(self, at):
        row = np.arange(len(self.values))[:, None]
        return self._picked(np.minimum.reduceat(np.where(self.known, row, len(self.values)), at.starts, axis=0))

    def _last_row(self, at):
        end = at.starts + at.sizes - 1
        return self.values[end], self.known[end]

    def _nunique(self, at):
        out = np.zeros((len(at.starts), self.values.shape[1]), np.int64)
        for i in range(out.shape[1]):
            known = self.known[:, i]
            out[:, i] = _distinct(at.number[known], np.unique(self.values[known, i], return_inverse=True)[1], len(out))
        return out, None


def _distinct(stretch: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    if not len(code):
        return np.zeros(n, np.int64)
    width = int(code.max()) + 1
    return np.bincount(np.unique(stretch * width + code) // width, minlength=n)


class _Other:
    """One column of any other type: its values are only counted, compared and taken."""

    def __init__(self, column: pa.Array, known: np.ndarray | None = None) -> None:
        self.column = column
        self.known = _known(column) if known is None else known

    def where(self, mask: np.ndarray) -> _Other:
        return _Other(self.column, self.known & mask)

    def reduce(self, stat: str, at: _Stretches):
        result = getattr(self, "_" + stat)(at)
        return lambda i: result

    def _taken(self, place: np.ndarray, known: np.ndarray) -> tuple[pa.Array, None]:
        return self.column.take(pa.array(place, pa.int64(), mask=~known)), None

    def _count(self, at):
        return np.add.reduceat(self.known, at.starts, dtype=np.int64), None

    def _last(self, at):
        place = np.maximum.reduceat(np.where(self.known, np.arange(len(self.known)), -1), at.starts)
        return self._taken(place, place >= 0)

    def _first(self, at):
        place = np.minimum.reduceat(np.where(self.known, np.arange(len(self.known)), len(self.known)), at.starts)
        return self._taken(place, place < len(self.known))

    def _last_row(self, at):
        end = at.starts + at.sizes - 1
        return self._taken(end, self.known[end])

    def _codes(self) -> tuple[np.ndarray, np.ndarray]:
        """A number per row that orders the values, and a row for each number."""
        coded = self.column.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order) + 1, np.int64)
        rank[order] = np.arange(len(order))
        rank[-1] = -1
        codes = rank[coded.indices.fill_null(len(order)).to_numpy(zero_copy_only=False)]
        row = np.zeros(len(order), np.int64)
        row[codes[codes >= 0]] = np.flatnonzero(codes >= 0)
        return codes, row

    def _nunique(self, at):
        codes, _ = self._codes()
        return _distinct(at.number[self.known], codes[self.known], len(at.starts)), None

    def _max(self, at):
        codes, row = self._codes()
        best = np.maximum.reduceat(np.where(self.known, codes, -1), at.starts)
        return self._taken(row[np.maximum(best, 0)] if len(row) else best * 0, best >= 0)

    def _min(self, at):
        codes, row = self._codes()
        best = np.minimum.reduceat(np.where(self.known, codes, len(row)), at.starts)
        return self._taken(row[np.minimum(best, len(row) - 1)] if len(row) else best * 0, best < len(row))


def _typed(result: tuple, kind: T.DataType) -> pa.Array:
    values, known = result
    if isinstance(values, pa.Array):
        return values
    arrow = _ARROW[type(kind)]
    filled = values if known is None else np.where(known, values, 0)
    return pa.array(np.ascontiguousarray(filled).astype(arrow.to_pandas_dtype(), copy=False), arrow, mask=None if known is None else ~known)
