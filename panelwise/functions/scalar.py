"""Expressions shared by the operators, as Columns or as SQL text. All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``; NULL where the divisor is zero or either side is NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ratio_sql(top: str, bottom: str) -> str:
    return f"try_divide(CAST({top} AS DOUBLE), CAST({bottom} AS DOUBLE))"


def round_half_even(x: Column, digits: int = 2) -> Column:
    """Scale, round halves to the even neighbour, scale back (binary floating point)."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def sigmoid(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole days of 24 hours between two timestamps; the remainder is dropped."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def day_gap_sql(later: str, earlier: str) -> str:
    return f"CAST(extract(DAY FROM {later} - {earlier}) AS INT)"


def within_days_sql(last: str, ts: str, days: int) -> str:
    """True where ``ts`` lies strictly less than ``days`` days before ``last``."""
    return f"({last} - {ts}) < INTERVAL '{int(days)}' DAY"


def above(score: Column, threshold: float) -> Column:
    return (score > F.lit(float(threshold))).cast("int")


def row_mean(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / len(columns)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL; data written from pandas may use NaN for a missing number."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    chosen = floats if columns is None else floats & set(columns)
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )
