"""Keys that hold too many rows for one task."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions.scalar import day_gap_sql, quoted
from panelwise.plans import ordering
from panelwise.plans.ordering import BUCKET, in_buckets, written
from panelwise.spec import PanelSpec

ROWS_PER_KEY = 100_000  # a key with more rows than this is split
BROADCAST_ROWS = 100_000  # tables of up to this many values are broadcast, larger ones are shuffled
ROWS_PER_TASK = 1 << 19  # rows that a task of a plan over split keys should take
BYTES_PER_READ = 1 << 24  # and bytes of written tables that it should read

PARTITIONS, COALESCE, READ = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes"
_SIZING = threading.RLock()
_SIZED: dict[SparkSession, tuple[dict[str, str], list[int]]] = {}  # settings to go back to, and the sizes asked for


@dataclass
class HotKeys:
    """Keys with more than the allowed number of rows, and how to join with them."""

    table: DataFrame | None
    number: int = 0
    rows: int = 0  # of all these keys together
    total: int = 0  # of all keys

    def __bool__(self) -> bool:
        return self.table is not None

    def hint(self, small: DataFrame, width: int = 1) -> DataFrame:
        """Broadcast a table of one row per hot key with ``width`` values, if all its values are few enough."""
        return F.broadcast(small) if self.number * width <= BROADCAST_ROWS else small

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
        """(rows of ordinary keys, rows of hot keys)."""
        if not self:
            return rows, None
        return (
            rows.join(self.hint(self.table), key, "left_anti"),
            rows.join(self.hint(self.table), key, "left_semi"),
        )


def find_hot_keys(rows: DataFrame, key: str, rows_per_key: int | None = None) -> HotKeys:
    """Count rows per key (key column only, combined map-side) and write the keys above the limit, if there are any."""
    limit = ROWS_PER_KEY if rows_per_key is None else rows_per_key
    spark, k = rows.sparkSession, quoted(key)
    counts = f"SELECT {k}, count(*) AS _n FROM {{rows}} GROUP BY {k}"
    sizes = f"SELECT count_if(_n > {limit}), sum(IF(_n > {limit}, _n, 0)), sum(_n) FROM ({counts})"
    number, held, total = spark.sql(sizes, rows=rows).first()
    if not number:
        return HotKeys(None)
    return HotKeys(written(spark.sql(f"SELECT {k} FROM ({counts}) WHERE _n > {limit}", rows=rows), "large-keys"), number, held, total)


@contextmanager
def tasks_sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside deal out that many rows to as many tasks as keep each near ``ROWS_PER_TASK``.

    An aggregate that combines map-side takes its number of tasks from the session, so that is where it is set, and set
    back at the end. Smaller tables keep the session's own settings, and so do sessions whose number is higher.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    with _SIZING:
        before, asked = _SIZED.setdefault(spark, ({n: spark.conf.get(n) for n in (PARTITIONS, COALESCE, READ)}, []))
        asked.append(tasks)
        _set_sizes(spark, before, max(asked))
    try:
        yield
    finally:
        with _SIZING:  # plans side by side may overlap: the largest size holds until the last of them ends
            asked.remove(tasks)
            _set_sizes(spark, before, max(asked, default=0))
            if not asked:
                del _SIZED[spark]


def _set_sizes(spark: SparkSession, before: dict[str, str], tasks: int) -> None:
    sizes = dict(before)
    if tasks > int(before[PARTITIONS]):
        read = min(BYTES_PER_READ, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[READ]))
        sizes = {PARTITIONS: str(tasks), COALESCE: "false", READ: str(read)}
    for name, value in sizes.items():
        spark.conf.set(name, value)


def consecutive_gaps(rows: DataFrame, spec: PanelSpec, name: str) -> DataFrame:
    """``(key, *order, name)``: whole days since the previous row of the same key.

    Works on any distribution of keys: rows are written once, dealt into buckets of the order ``(key, ts, tiebreak)``,
    and the row before the first row of a bucket is taken from the bucket ends.
    """
    names = [spec.key, *spec.order]
    cols = [quoted(c) for c in names]
    narrow = written(rows.selectExpr(*cols), "gaps")
    buckets = max(1, -(-narrow.count() // ordering.ROWS_PER_BUCKET))
    if buckets == 1:  # few rows, whatever their keys: a window per key
        before = f"lag({cols[1]}) OVER (PARTITION BY {cols[0]} ORDER BY {', '.join(cols[1:])})"
        return narrow.selectExpr(*cols, f"{before} AS _before").selectExpr(*cols, f"{day_gap_sql(cols[1], '_before')} AS {quoted(name)}")
    cut = written(in_buckets(narrow, names, buckets), "gaps")
    row = f"named_struct('k', {cols[0]}, 't', {cols[1]})"
    ends = cut.groupBy(BUCKET).agg(F.expr(f"max_by({row}, struct({', '.join(cols)})) AS _end"))
    # one row per bucket: the last row of the nearest earlier bucket that has rows; groups of buckets come first
    grouped = ends.selectExpr("*", f"{BUCKET} div {ordering.GROUP} AS _group")
    groups = grouped.groupBy("_group").agg(F.expr(f"max_by(_end, {BUCKET}) AS _last"))
    before = groups.selectExpr("_group", "lag(_last) OVER (ORDER BY _group) AS _earlier")
    carried = grouped.join(before, "_group").selectExpr(
        BUCKET, f"coalesce(lag(_end) OVER (PARTITION BY _group ORDER BY {BUCKET}), _earlier) AS _carry"
    )
    return (
        cut.join(F.broadcast(carried) if buckets <= BROADCAST_ROWS else carried, BUCKET)
        .selectExpr(
            *cols,
            f"coalesce(lag({row}) OVER (PARTITION BY {BUCKET} ORDER BY {', '.join(cols)}), _carry) AS _before",
        )
        .selectExpr(*cols, f"IF(_before.k = {cols[0]}, {day_gap_sql(cols[1], '_before.t')}, NULL) AS {quoted(name)}")
    )
