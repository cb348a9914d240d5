"""Column preparation: imputing, encoding, rounding, narrowing types.

Functions named ``fit_*`` run a job and return a few values per column; the others are lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelwise.functions.scalar import round_half_even
from panelwise.plans.ordering import with_position, written
from panelwise.plans.skew import BROADCAST_ROWS

# Exclusive limits that decide the narrowest type.
INTEGER_LIMITS = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))
FLOAT_MAX = 3.4028234663852886e38

SALTS = 16  # parts that the rows of one value are dealt into where numbers are joined by shuffle


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(name, num, txt)`` per cell: numbers keep their order in ``num``, all values their text in ``txt``."""
    cells = [
        F.struct(
            F.lit(c).alias("name"),
            (F.col(c).cast("double") if _is_number(df, c) else F.lit(None).cast("double")).alias("num"),
            F.col(c).cast("string").alias("txt"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class Mode:
    value: str | None
    to_int: bool


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Mode]:
    """Most frequent value per column (the smallest on a tie) and whether every value is a whole number."""
    counts = (
        _long(df, columns).where(F.col("txt").isNotNull()).groupBy("name", "num", "txt").agg(F.count(F.lit(1)).alias("n"))
    )
    digits = F.col("txt").rlike(r"^\s*[+-]?\d+\s*$") & F.expr("try_cast(trim(txt) AS bigint) IS NOT NULL")
    whole = F.col("num").isNotNull() | digits
    found = {
        r["name"]: Mode(r["value"], r["whole"])
        for r in counts.groupBy("name")
        .agg(F.min_by("txt", F.struct(-F.col("n"), "num", "txt")).alias("value"), F.bool_and(whole).alias("whole"))
        .collect()
    }
    return {c: found.get(c, Mode(None, False)) for c in columns}


def impute_modes(df: DataFrame, modes: dict[str, Mode]) -> DataFrame:
    """Fill NULL with the mode; columns of whole numbers become 64-bit integers."""

    def filled(c: str) -> Column:
        kind = df.schema[c].dataType
        x = F.coalesce(F.col(c), F.lit(modes[c].value).cast(kind))
        return x.cast("bigint") if modes[c].to_int else x

    return df.select(*[filled(c).alias(c) if c in modes else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class LabelMap:
    """The numbers of all values of all columns: ``(name, txt, code)``, a written table of ``number`` rows."""

    table: DataFrame
    number: int


def fit_labels(df: DataFrame, columns: Sequence[str]) -> LabelMap:
    """Number the sorted distinct values of each column from 0; NULL, if present, comes last.

    All columns at once: distinct values combine map-side, and their places in each column's order are found by one
    distributed order. No values come to the driver.
    """
    values = _long(df, columns).distinct()
    order = ["IF(txt IS NULL, 1, 0)", "coalesce(num, 0)", "coalesce(txt, '')"]
    placed = with_position(values, order, "code", by="name").select("name", "txt", F.col("code").cast("int").alias("code"))
    table = written(placed, "labels")
    return LabelMap(table, table.count())


def apply_labels(df: DataFrame, labels: LabelMap, columns: Sequence[str]) -> DataFrame:
    """Replace each value by its number; fails on a value that was not there when fitting.

    Few numbers are broadcast. With more of them, the cells of all columns meet the numbers in one join, every value
    in ``SALTS`` parts, so that a value that a third of the rows have is spread over tasks; then the rows' cells come
    together again.
    """
    return _by_broadcast(df, labels, columns) if labels.number <= BROADCAST_ROWS else _by_cells(df, labels, columns)


def _code(column: str, value: Column, code: Column) -> Column:
    unseen = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), F.coalesce(value, F.lit("NULL"))))
    return F.when(code.isNull(), unseen.cast("int")).otherwise(code).alias(column)


def _by_broadcast(df: DataFrame, labels: LabelMap, columns: Sequence[str]) -> DataFrame:
    out = df
    for c in columns:
        codes = labels.table.where(F.col("name") == c).select(F.col("txt").alias("_txt"), F.col("code").alias("_code"))
        joined = out.join(F.broadcast(codes), F.col(c).cast("string").eqNullSafe(F.col("_txt")), "left")
        out = joined.select(*[_code(c, F.col(c).cast("string"), F.col("_code")) if x == c else F.col(x) for x in out.columns])
    return out


def _by_cells(df: DataFrame, labels: LabelMap, columns: Sequence[str]) -> DataFrame:
    rows = written(df.withColumn("_id", F.monotonically_increasing_id()), "encode")
    cells = rows.select(
        "_id", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"),
        F.inline(F.array(*[F.struct(F.lit(i).alias("_at"), F.lit(c).alias("_name"), F.col(c).cast("string").alias("_cell")) for i, c in enumerate(columns)])),
    )
    codes = labels.table.select("name", "txt", "code", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    same = (F.col("_name") == F.col("name")) & F.col("_cell").eqNullSafe(F.col("txt")) & (F.col("_salt") == F.col("salt"))
    # the numbers' files are small for their rows, so Spark would broadcast all parts of all values if left to choose
    found = cells.join(codes.hint("merge"), same, "left").select("_id", "_at", "code")
    numbers = found.groupBy("_id").agg(*[F.max(F.when(F.col("_at") == i, F.col("code"))).alias(f"_code_{i}") for i in range(len(columns))])
    joined = rows.hint("merge").join(numbers, "_id")
    place = {c: i for i, c in enumerate(columns)}
    return joined.select(*[_code(x, F.col(x).cast("string"), F.col(f"_code_{place[x]}")) if x in place else F.col(x) for x in df.columns])


def round_last(df: DataFrame, digits: int = 2) -> DataFrame:
    """Add ``{column}_round2`` for every floating column whose name contains "last"."""
    chosen = [
        f.name for f in df.schema.fields if "last" in f.name and isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    return df.withColumns({f"{c}_round{digits}": round_half_even(F.col(c).cast("double"), digits) for c in chosen})


def fixed_downcast(df: DataFrame) -> DataFrame:
    """Doubles to single precision, long integers to 32 bits."""

    def narrow(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DoubleType):
            return F.col(f.name).cast("float").alias(f.name)
        if isinstance(f.dataType, T.LongType):
            return F.col(f.name).cast("int").alias(f.name)
        return F.col(f.name)

    return df.select(*[narrow(f) for f in df.schema.fields])


def downcast_plan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, low, high, type)``: the narrowest type that strictly contains each numeric column."""
    fields = [
        f
        for f in df.schema.fields
        if isinstance(f.dataType, (T.IntegralType, T.FloatType, T.DoubleType)) and (columns is None or f.name in columns)
    ]
    one = df.agg(*[F.min(f.name).alias(f"lo_{f.name}") for f in fields], *[F.max(f.name).alias(f"hi_{f.name}") for f in fields])

    def narrowest(f: T.StructField) -> Column:
        lo, hi = F.col(f"lo_{f.name}"), F.col(f"hi_{f.name}")
        choice = F.lit(f.dataType.simpleString())
        if isinstance(f.dataType, T.IntegralType):
            for name, limit in reversed(INTEGER_LIMITS):
                choice = F.when((lo > -limit) & (hi < limit - 1), name).otherwise(choice)
            return choice
        return F.when((lo > -FLOAT_MAX) & (hi < FLOAT_MAX), "float").otherwise(choice)

    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"lo_{f.name}").cast("double").alias("low"),
            F.col(f"hi_{f.name}").cast("double").alias("high"),
            narrowest(f).alias("type"),
        )
        for f in fields
    ]
    return one.select(F.inline(F.array(*rows)))


def downcast(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Apply ``downcast_plan`` (runs one aggregate job)."""
    types = {r["column"]: r["type"] for r in downcast_plan(df, columns).collect()}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
