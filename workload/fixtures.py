"""Panels and scored tables derived from the given parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelwise.functions.scalar import quoted
from panelwise.spec import PanelSpec

STATEMENTS = PanelSpec(
    key="o_custkey",
    ts="o_orderdate",
    tiebreak=("o_orderkey",),
    categorical=("o_orderstatus", "o_orderpriority", "last_flag"),
    numeric=("o_totalprice", "qty", "disc_price", "avg_tax", "n_lines"),
)
IMPORTANT = ("o_totalprice", "qty", "disc_price", "avg_tax")
EVENTS = PanelSpec(
    key="user_id", ts="ts", tiebreak=("event_id",), categorical=("event_type",), numeric=("value",)
)


# customers of these market segments play the unlabelled (test) population, all others the train one
TEST_SEGMENTS = ("AUTOMOBILE", "HOUSEHOLD")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order of a customer, with the totals of its lines."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.expr("sum(l_quantity) AS qty"),
            F.expr("sum(l_extendedprice * (1 - l_discount)) AS disc_price"),
            F.expr("avg(l_tax) AS avg_tax"),
            F.expr("count(*) AS n_lines"),
            F.expr("max(l_returnflag) AS last_flag"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "qty", "disc_price", "avg_tax",
        "n_lines", "last_flag", "o_orderstatus", "o_orderpriority",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a label, their split, and two deterministic scores: one fine, one with heavy ties."""
    fine = ((F.col("c_custkey") * 7919) % 10007) / F.lit(10007.0)
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("key"),
            (F.col("c_acctbal") < 0).cast("int").alias("target"),
            fine.alias("score_a"),
            F.when(F.col("c_mktsegment").isin(*TEST_SEGMENTS), "test").otherwise("train").alias("split"),
        )
        .withColumn("score_b", F.floor(F.col("score_a") * 50) / 50)
    )


def by_split(spark: SparkSession, sf_dir: str, panel: DataFrame) -> dict[str, DataFrame]:
    """The panel's rows of train and of test customers; together they are the whole panel."""
    splits = scored(spark, sf_dir).select(F.col("key").alias("o_custkey"), "split")
    tagged = panel.join(splits, "o_custkey", "left")
    test = F.coalesce(F.col("split") == "test", F.lit(False))
    return {"train": tagged.where(~test).drop("split"), "test": tagged.where(test).drop("split")}


def as_float(df: DataFrame, only: Sequence[str] | None = None, digits: int | None = 9) -> DataFrame:
    """Doubles as single precision, so that sums taken in another order compare equal.

    The first rounding removes what is left of a difference that should be zero.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    chosen = doubles if only is None else [c for c in doubles if c in only]
    single = "CAST({0} AS FLOAT) AS {0}" if digits is None else f"CAST(round({{0}}, {digits}) AS FLOAT) AS {{0}}"
    return df.selectExpr(*[single.format(quoted(c)) if c in chosen else quoted(c) for c in df.columns])
