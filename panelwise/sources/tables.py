"""Reading panels and labels, writing the tables of a scoring run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_panel(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet panel; with ``columns`` only those are read from disk."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_labels(spark: SparkSession, path: str, key: str, key_type: str = "string", target: str = "target") -> DataFrame:
    """Label CSV with a header; found by column name, whatever their order in the file."""
    names = spark.read.option("header", True).csv(path).columns
    schema = ", ".join(
        f"`{n}` {key_type if n == key else 'int' if n == target else 'string'}" for n in names
    )
    return spark.read.schema(schema).option("header", True).csv(path).select(key, target)


def attach_labels(features: DataFrame, labels: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join labels by key. A key with several label rows is an error, raised when the rows are computed."""
    names = [c for c in labels.columns if c != key]
    one = labels.groupBy(key).agg(F.count(F.lit(1)).alias("_labels"), *[F.first(c).alias(c) for c in names])
    joined = features.join(one, key, how)
    several = F.raise_error(F.concat(F.lit("several labels for key "), F.col(key).cast("string")))
    checked = [
        F.when(F.col("_labels") > 1, several.cast(labels.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
        for c in joined.columns
        if c != "_labels"
    ]
    return joined.select(*checked)


def join_on_key(tables: Sequence[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """Chain of one-to-one joins; every table is shuffled by key at most once."""
    return reduce(lambda a, b: a.join(b, key, how), tables)


def tagged_union(train: DataFrame, test: DataFrame, tag: str = "target") -> DataFrame:
    """Train rows with 0 and test rows with 1 in one table."""
    return train.withColumn(tag, F.lit(0)).unionByName(test.withColumn(tag, F.lit(1)), allowMissingColumns=True)


def write_wide(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_oof(oof: DataFrame, path: str) -> None:
    """Out-of-fold predictions of all folds, one directory per fold."""
    oof.write.mode("overwrite").partitionBy("fold").parquet(path)


def write_importance(importance: DataFrame, path: str) -> None:
    importance.write.mode("overwrite").option("header", True).csv(path)


def write_fold_importances(importances: DataFrame, path: str) -> None:
    """``(fold, feature, importance)``, one directory of CSV files per fold."""
    importances.write.mode("overwrite").partitionBy("fold").option("header", True).csv(path)


def one_to_one(predictions: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``predictions``, checked against the asked-for ``keys``: a key that is missing, asked for twice, predicted twice
    or not asked for is an error, raised when the rows are computed."""
    asked = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_asked"))
    given = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("_given"), *[F.first(c).alias(c) for c in predictions.columns if c != key])
    joined = asked.join(given, key, "full")
    wrong = F.raise_error(F.concat(F.lit("predictions do not match the asked-for keys one to one: "), F.col(key).cast("string")))
    right = (F.coalesce("_asked", F.lit(0)) == 1) & (F.coalesce("_given", F.lit(0)) == 1)
    kind = predictions.schema[key].dataType
    return joined.withColumn(key, F.when(right, F.col(key)).otherwise(wrong.cast(kind))).select(*predictions.columns)


def write_submission(predictions: DataFrame, key: str, path: str, value: str = "prediction", keys: DataFrame | None = None) -> None:
    """``(key, prediction)`` as CSV part files with a header; with ``keys``, only if they match one to one."""
    if keys is not None:
        predictions = one_to_one(predictions.select(key, value), keys.select(key), key)
    predictions.select(key, F.col(value).alias("prediction")).write.mode("overwrite").option("header", True).csv(path)


def write_fold_predictions(predictions: DataFrame, key: str, columns: Sequence[str], path: str) -> None:
    """``(key, prediction_0, prediction_1, ...)`` as CSV part files with a header."""
    named = [F.col(c).alias(f"prediction_{i}") for i, c in enumerate(columns)]
    predictions.select(key, *named).write.mode("overwrite").option("header", True).csv(path)


def read_predictions(spark: SparkSession, path: str, key: str, key_type: str = "string") -> DataFrame:
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType.fromDDL(", ".join(f"`{n}` {key_type if n == key else 'double'}" for n in names))
    return spark.read.schema(schema).option("header", True).csv(path)


def write_drift_report(report: DataFrame, kept: DataFrame, path: str) -> None:
    """Rounds and dropped features as JSON lines, kept feature names as text."""
    report.write.mode("overwrite").json(f"{path}/report")
    kept.select(F.col("feature")).write.mode("overwrite").text(f"{path}/kept")
