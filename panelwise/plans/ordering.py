"""Global order without a single-task sort.

A window ordered over a whole table runs on one task. Here the rows that matter (order, values, what the caller keeps)
are written once; Spark deals them out by ranges of the order into buckets of about ``ROWS_PER_BUCKET`` rows, sorts each
bucket with spill and writes it with its running sums. A bucket's rows are then fixed, whatever is lost or run again.
Totals per bucket give each bucket its offset, in two steps: groups of ``GROUP`` buckets are summed up first, then the
buckets within a group, so no step looks at all buckets at once however many there are. With ``by``, every value of
that column is an order of its own, and all of them are computed in the same pass; a value may hold any share of the
rows, since buckets cut through it.

``order`` is always a list of SQL expressions sorted ascending, unique per row as a whole; sort a
number in descending order by its negative. Equal scores are cut by the later columns, so a score
shared by a third of the rows still spreads over many buckets.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from panelwise.functions.scalar import quoted
from panelwise.sources.workdir import fresh_folder

ROWS_PER_BUCKET = 250_000  # a table of at most this many rows is one bucket
GROUP = 1024  # buckets whose totals are looked at together
BROADCAST_OFFSETS = 100_000  # offset tables up to this many rows are broadcast, longer ones are shuffled
SAMPLE_PER_BUCKET = 20
BUCKET, BUCKETS = "_bucket", "_bucket_group"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# tasks get this module's code with them; it need not be installed on executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class SplitPoints:
    """Ascending split tuples of an order; bucket n holds rows with exactly n splits at or below them.

    For callers that want to fix the cut of an order themselves; they are constants of the plan, searched by halving, so
    a row costs as many comparisons as the number of splits has bits. Without them buckets are dealt out by Spark.
    """

    splits: list[tuple]
    types: list[str]
    total: int  # rows of the table

    def add_bucket(self, df: DataFrame, order: list[str]) -> DataFrame:
        if not self.splits:
            return df.selectExpr("*", f"0 AS {BUCKET}")
        many = len(self.splits)
        struct = "struct<" + ",".join(f"o{i}:{t}" for i, t in enumerate(self.types)) + ">"
        row = "named_struct(" + ", ".join(
            f"'o{i}', CAST({o} AS {t})" for i, (o, t) in enumerate(zip(order, self.types))
        ) + ")"
        splits = _literal(self.splits, f"array<{struct}>")
        steps = ", ".join(str(1 << k) for k in reversed(range(many.bit_length())))
        further = f"n + step <= {many} AND element_at({splits}, least(n + step, {many})) <= _row"
        found = f"aggregate(array({steps}), 0, (n, step) -> IF({further}, n + step, n))"
        return df.selectExpr("*", f"{row} AS _row").selectExpr("*", f"{found} AS {BUCKET}").drop("_row")


def _literal(splits: list, kind: str) -> str:
    """Split points as a constant. A value that does not survive as JSON fails, it never becomes NULL."""

    def plain(v):
        if isinstance(v, tuple):
            return {f"o{i}": x for i, x in enumerate(v)}
        if isinstance(v, list):
            return [plain(x) for x in v]
        return v

    text = json.dumps(
        plain(splits), default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v)
    ).replace("'", "\\u0027")
    return f"from_json(r'{text}', '{kind}', map('mode', 'FAILFAST'))"


def split_points(df: DataFrame, order: list[str], rows_per_bucket: int | None = None) -> SplitPoints:
    """Count the rows, put a sample of ``order`` in order and return one split per bucket after the first."""
    cols = df.selectExpr(*[f"{o} AS o{i}" for i, o in enumerate(order)])
    types = [f.dataType.simpleString() for f in cols.schema.fields]
    total = cols.count()
    buckets = math.ceil(total / (rows_per_bucket or ROWS_PER_BUCKET))
    if buckets <= 1:
        return SplitPoints([], types, total)
    want = buckets * SAMPLE_PER_BUCKET
    sample = cols if total <= 2 * want else cols.sample(fraction=want / total, seed=17)
    # NULL sorts first, as in SQL, and is cut by the later columns like any other value; only splits reach the driver
    ranked = with_position(sample, cols.columns, "_place")
    cut = ranked.where(f"_place > 0 AND _place % greatest(1, ceil(_place_total / {buckets})) = 0").select(*cols.columns)
    return SplitPoints(sorted({tuple(r) for r in cut.collect()}, key=_nulls_first), types, total)


def _nulls_first(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


def written(df: DataFrame, purpose: str = "order") -> DataFrame:
    """The same rows, computed once and read from the shared folder from then on."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_buckets(rows: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """Rows dealt out by ranges of ``order`` (column names) and sorted, with ``BUCKET``; write this before using it twice."""
    dealt = rows.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    return dealt.withColumn(BUCKET, F.spark_partition_id())


def with_running(
    df: DataFrame, order: list[str], sums: dict[str, str], points: SplitPoints | None = None, by: str | None = None
) -> DataFrame:
    """Add running totals in ``order``.

    For each ``name: value`` adds ``name`` (sum of ``value`` up to and including the row) and
    ``name_total`` (sum over all rows). With ``by`` (an SQL expression), both are per value of it.
    """
    if points is not None:
        return _running_between(df, order, sums, points)
    kept = [c for c in df.columns if c not in sums]
    rows = written(
        df.selectExpr(
            *[quoted(c) for c in kept], f"{by or 0} AS _g", *[f"{o} AS _o{i}" for i, o in enumerate(order)], *[f"{v} AS _s{i}" for i, v in enumerate(sums.values())]
        )
    )
    return running_over_written(rows, kept, len(order), list(sums), by is not None)


def running_over_written(rows: DataFrame, kept: list[str], order: int, sums: list[str], grouped: bool = False) -> DataFrame:
    """``with_running`` for a written table with the columns ``kept``, ``_g``, ``_o0, _o1, ...`` and ``_s0, _s1, ...``."""
    total = rows.count()
    columns = [f"_o{i}" for i in range(order)]
    values = [f"_s{i}" for i in range(len(sums))]
    keep = [quoted(c) for c in kept]
    part = "PARTITION BY _g " if grouped else ""
    if total <= ROWS_PER_BUCKET:
        ordered = f"({part}ORDER BY {', '.join(columns)} ROWS UNBOUNDED PRECEDING)"
        return rows.selectExpr(
            *keep,
            *[f"sum({v}) OVER {ordered} AS {quoted(n)}" for v, n in zip(values, sums)],
            *[f"sum({v}) OVER ({part}) AS {quoted(n + '_total')}" for v, n in zip(values, sums)],
        )
    dealt = in_buckets(rows, ["_g", *columns], math.ceil(total / ROWS_PER_BUCKET)).drop(*columns)
    local = written(_running(dealt, values), "running")
    totals = local.groupBy("_g", BUCKET).agg(*[F.sum(v).alias(v) for v in values])
    offsets = _offsets(totals, values, part)
    few = offsets.count() <= BROADCAST_OFFSETS
    at = offsets.select(F.col("_g").alias("_og"), F.col(BUCKET).alias("_ob"), *[c for v in values for c in (f"{v}_before", f"{v}_total")])
    joined = local.join(F.broadcast(at) if few else at, (F.col(BUCKET) == F.col("_ob")) & F.col("_g").eqNullSafe(F.col("_og")))
    return joined.selectExpr(
        *keep,
        *[f"{v}_run + {v}_before AS {quoted(n)}" for v, n in zip(values, sums)],
        *[f"{v}_total AS {quoted(n + '_total')}" for v, n in zip(values, sums)],
    )


def _offsets(totals: DataFrame, values: list[str], part: str) -> DataFrame:
    """Per value of ``_g`` and bucket, the sums of all earlier buckets and of all buckets; groups of buckets first."""
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    grouped = totals.selectExpr("*", f"{BUCKET} div {GROUP} AS {BUCKETS}")
    groups = grouped.groupBy(BUCKETS, "_g").agg(*[F.sum(v).alias(v) for v in values])
    starts = groups.selectExpr(
        f"{BUCKETS} AS _group", "_g AS _gg",
        *[f"coalesce(sum({v}) OVER ({part}ORDER BY {BUCKETS} {earlier}), 0) AS {v}_start" for v in values],
        *[f"sum({v}) OVER ({part}) AS {v}_total" for v in values],
    )
    inside = grouped.selectExpr(
        "*", *[f"coalesce(sum({v}) OVER (PARTITION BY _g, {BUCKETS} ORDER BY {BUCKET} {earlier}), 0) AS {v}_in" for v in values]
    )
    joined = inside.join(starts, (F.col(BUCKETS) == F.col("_group")) & F.col("_g").eqNullSafe(F.col("_gg")))
    return joined.selectExpr("_g", BUCKET, *[f"{v}_in + {v}_start AS {v}_before" for v in values], *[f"{v}_total" for v in values])


def _running(dealt: DataFrame, values: list[str]) -> DataFrame:
    """Running sums of each value within its bucket and ``_g``; batches follow each other, so the last sums are carried."""
    whole = {v: isinstance(dealt.schema[v].dataType, INTEGRAL) for v in values}
    cast = dealt.withColumns({v: F.col(v).cast("long" if whole[v] else "double") for v in values})
    names = [*cast.columns, *[f"{v}_run" for v in values]]
    schema = T.StructType([*cast.schema.fields, *[T.StructField(f"{v}_run", cast.schema[v].dataType) for v in values]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, carried = None, dict.fromkeys(values, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            by = batch.column("_g")
            codes = by.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            starts = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1]
            sizes = np.diff(np.r_[starts, batch.num_rows])
            same = group is not None and group.equals(by[0])
            group = by[len(by) - 1]
            sums = []
            for v in values:
                column = pc.fill_null(batch.column(v), 0).to_numpy(zero_copy_only=False)
                run = np.cumsum(column)
                base = run[starts] - column[starts]
                if same:
                    base[0] -= carried[v]
                run = run - np.repeat(base, sizes)
                carried[v] = run[-1]
                sums.append(pa.array(run))
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], names=names)

    return cast.mapInArrow(task, schema)


def _running_between(df: DataFrame, order: list[str], sums: dict[str, str], points: SplitPoints) -> DataFrame:
    """Running totals over buckets that the caller has cut."""
    bucketed = points.add_bucket(df, order)
    offsets = (
        bucketed.groupBy(BUCKET)
        .agg(*[F.expr(f"sum({v}) AS {n}") for n, v in sums.items()])
        .selectExpr(
            BUCKET,
            *[
                f"coalesce(sum({n}) OVER (ORDER BY {BUCKET} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
                f" AS {n}_before"
                for n in sums
            ],
            *[f"sum({n}) OVER () AS {n}_total" for n in sums],
        )
    )
    inside = f"(PARTITION BY {BUCKET} ORDER BY {', '.join(order)} ROWS UNBOUNDED PRECEDING)"
    # one row per split point, and those are constants of the plan
    return bucketed.join(F.broadcast(offsets), BUCKET).selectExpr(
        *[quoted(c) for c in df.columns if c not in sums],
        *[f"sum({v}) OVER {inside} + {n}_before AS {n}" for n, v in sums.items()],
        *[f"{n}_total" for n in sums],
    )


def with_position(
    df: DataFrame, order: list[str], name: str = "position", points: SplitPoints | None = None, by: str | None = None
) -> DataFrame:
    """Add the 0-based position of each row in ``order`` and the row count as ``{name}_total``; with ``by``, per value of it."""
    ranked = with_running(df, order, {name: "1"}, points, by)
    return ranked.selectExpr(*[quoted(c) for c in df.columns if c != name], f"{name} - 1 AS {name}", f"{name}_total")


def _values_at(rows: DataFrame, positions: list[int], total: int) -> dict[int, float]:
    asked = sorted(set(positions))
    if outside := [p for p in asked if not 0 <= p < total]:
        raise IndexError(f"positions {outside} lie outside a table of {total} values")
    if not asked:
        return {}
    ranked = running_over_written(rows, ["_v"], 2, ["position"])
    found = ranked.where(F.col("position").isin([p + 1 for p in asked])).select("position", "_v").collect()
    return {r["position"] - 1: r["_v"] for r in found}


def _known(df: DataFrame, value: str, key: str) -> tuple[DataFrame, int]:
    """The known values as a written table for ``running_over_written``, and their number."""
    v, k = quoted(value), quoted(key)
    rows = written(df.where(f"{v} IS NOT NULL").selectExpr(f"{v} AS _v", "0 AS _g", f"{v} AS _o0", f"{k} AS _o1", "1 AS _s0"))
    return rows, rows.count()


def order_statistics(df: DataFrame, value: str, key: str, positions: list[int]) -> dict[int, float]:
    """Exact values at the given 0-based positions of ``value`` in ascending order.

    Only the asked-for rows reach the driver. A position outside the table raises IndexError.
    """
    rows, total = _known(df, value, key)
    return _values_at(rows, positions, total)


def quantiles(df: DataFrame, value: str, key: str, probabilities: list[float]) -> list[float]:
    """Exact quantiles with linear interpolation between neighbours."""
    rows, total = _known(df, value, key)
    if total == 0:
        return []
    spots = [p * (total - 1) for p in probabilities]
    at = _values_at(rows, [f(s) for s in spots for f in (math.floor, math.ceil)], total)
    return [
        at[math.floor(s)] + (at[math.ceil(s)] - at[math.floor(s)]) * (s - math.floor(s)) for s in spots
    ]
