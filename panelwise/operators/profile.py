"""Tables for a first look at a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelwise.functions.scalar import ratio
from panelwise.spec import PanelSpec


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; NULL is a value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def rows_per_key_histogram(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """How many keys have how many rows."""
    return (
        panel.groupBy(spec.key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("rows")
        .agg(F.count(F.lit(1)).alias("keys"))
    )


def rows_per_date(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows per calendar date, in date order."""
    return (
        spec.prepare(panel)
        .groupBy(F.to_date(spec.ts).alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("date")
    )


def target_profile(
    panel: DataFrame, labels: DataFrame, spec: PanelSpec, target: str = "target", columns: Sequence[str] | None = None
) -> DataFrame:
    """``(feature, mean_0, mean_1, ratio)`` over the panel rows of each class.

    Sums are taken per key before the label join, so the join moves one row per key.
    """
    columns = list(columns or spec.numeric_columns(panel))
    per_key = panel.groupBy(spec.key).agg(
        *[F.sum(c).cast("double").alias(f"s_{c}") for c in columns], *[F.count(c).alias(f"n_{c}") for c in columns]
    )
    joined = per_key.join(labels.select(spec.key, target), spec.key)

    def mean(c: str, k: int):
        chosen = F.col(target) == k
        return F.try_divide(F.sum(F.when(chosen, F.col(f"s_{c}"))), F.sum(F.when(chosen, F.col(f"n_{c}"))))

    one = joined.agg(*[mean(c, k).alias(f"{c}_{k}") for c in columns for k in (0, 1)])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}_0").alias("mean_0"),
            F.col(f"{c}_1").alias("mean_1"),
            ratio(F.col(f"{c}_1"), F.col(f"{c}_0")).alias("ratio"),
        )
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))
