"""Pseudo-labels: confident predictions on unlabelled rows become training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwise.plans.ordering import order_statistics


def pseudo_label(
    train: DataFrame, scored: DataFrame, key: str, target: str = "target", score: str = "prediction", upper: float = 0.99
) -> DataFrame:
    """Train rows, then scored rows above ``upper`` as 1 and the lowest-scored rows as 0.

    The cut for zeros is the score at the place (0-based, ascending) that keeps the class ratio of the
    training rows; a place beyond the table raises IndexError. Column ``origin`` tells the parts apart.
    """
    counts = train.agg(F.sum((F.col(target) == 0).cast("long")).alias("n0"), F.sum((F.col(target) == 1).cast("long")).alias("n1")).first()
    positives = scored.where(F.col(score) > upper)
    place = int(counts["n0"] / counts["n1"] * positives.count())
    lower = order_statistics(scored, score, key, [place])[place]
    negatives = scored.where(F.col(score) < F.lit(lower))
    features = [c for c in train.columns if c != target]
    kind = train.schema[target].dataType

    def part(df: DataFrame, label, origin: str) -> DataFrame:
        return df.select(*features, F.lit(label).cast(kind).alias(target), F.lit(origin).alias("origin"))

    return (
        train.select(*features, target, F.lit("train").alias("origin"))
        .unionByName(part(positives, 1, "pseudo_1"))
        .unionByName(part(negatives, 0, "pseudo_0"))
    )
