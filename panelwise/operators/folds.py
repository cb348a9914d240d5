"""Stratified folds and samples, the same on every run and on any partitioning."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelwise.functions.scalar import quoted
from panelwise.plans.ordering import with_position, with_running


def _classes(df: DataFrame, target: str, key: str) -> DataFrame:
    """``(_class, _rows, _first, _start)``: each class, its size, its smallest key, and its place in the order of these keys."""
    sizes = df.groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_rows"), F.min(key).alias("_first"))
    placed = with_running(sizes, ["_first"], {"_end": "_rows"})
    return placed.select("_class", "_rows", "_first", (F.col("_end") - F.col("_rows")).alias("_start"))


def shuffle_key(key: str, seed: int) -> str:
    """A repeatable pseudo-random sort value per key."""
    return f"md5(concat('{seed}:', CAST({quoted(key)} AS STRING)))"


def _place_in_class(df: DataFrame, classes: DataFrame, target: str, key: str, seed: int | None) -> DataFrame:
    """``df`` with the columns of its class and ``_place``, the 0-based place of the row in its class."""
    mixed = [] if seed is None else [shuffle_key(key, seed)]
    joined = df.join(classes, F.col(target).eqNullSafe(F.col("_class")))
    placed = with_position(joined, ["_first", *mixed, quoted(key)], "_place")
    return placed.withColumn("_place", F.col("_place") - F.col("_start"))


def stratified_folds(df: DataFrame, target: str, key: str, k: int, seed: int | None = None) -> DataFrame:
    """Add ``fold`` (0..k-1) with equal class shares, for any number of classes.

    Without a seed, each class is cut into consecutive blocks in key order. With a seed, the rows of a
    class are put into a repeatable random order first.
    """
    placed = _place_in_class(df, _classes(df, target, key), target, key, seed)
    # class rows are dealt to folds by their global place modulo k: rows of the class in folds 0..i
    sizes = [f"greatest(0L, (_rows - pmod({i} - _start, {k}) + {k - 1}) div {k})" for i in range(k)]
    before = [F.expr(" + ".join(sizes[: i + 1])) for i in range(k)]
    fold = reduce(lambda a, b: a + b, [F.when(end <= F.col("_place"), 1).otherwise(0) for end in before])
    return placed.withColumn("fold", fold).select(*df.columns, "fold")


def stratified_sample(df: DataFrame, target: str, key: str, rate: float, seed: int = 42) -> DataFrame:
    """Keep ``floor(rate * n)`` rows with class shares kept as closely as whole rows allow."""
    classes = _classes(df, target, key)
    total = classes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    keep = math.floor(rate * total)
    shares = classes.withColumn("_exact", F.col("_rows") * F.lit(float(keep)) / F.lit(float(max(1, total))))
    shares = shares.withColumn("_quota", F.floor("_exact"))
    given = shares.agg(F.coalesce(F.sum("_quota"), F.lit(0))).first()[0]
    ranked = with_position(shares, ["_quota - _exact", "_first"], "_rank")
    quotas = ranked.withColumn("_quota", F.col("_quota") + (F.col("_rank") < keep - given).cast("long"))
    quotas = quotas.select("_class", "_rows", "_first", "_start", "_quota")
    placed = _place_in_class(df, quotas, target, key, seed)
    return placed.where(F.col("_place") < F.col("_quota")).select(*df.columns)
