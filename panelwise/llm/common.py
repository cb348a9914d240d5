"""Helpers that several text operators share."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a new one where it is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        named = tempfile.mkdtemp(prefix="panelwise-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Has Spark remove the shuffle files of a query when it ends; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written once below the shared folder: a lost executor costs a read, not a rerun.

    What was shuffled for them is removed at once, as nothing reads it again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def put(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a small file below the shared folder; its path. ``addFile`` then takes it to every executor."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(content)
    out.close()
    return place.toString()


_SENT: list[Broadcast] = []


def sent(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast that ``release`` frees."""
    _SENT.append(spark.sparkContext.broadcast(value))
    return _SENT[-1]


def release() -> None:
    """Free all broadcasts made so far. Call it when every table that reads them is settled, as between pipeline stages."""
    while _SENT:
        _SENT.pop().destroy()


def shielded(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The documents with every column but the needed ones under a name of its own, and the way back.

    An operator may then use any names for what it adds. The way back takes a result that still has these columns, and
    the names of added columns to keep behind them.
    """
    own = {c: c if c in needed else f"_own_{i}" for i, c in enumerate(docs.columns)}

    def back(result: DataFrame, *added: str) -> DataFrame:
        return result.select(*[F.col(o).alias(c) for c, o in own.items()], *added)

    return docs.toDF(*own.values()), back


_SHIPPED: set[str] = set()


def in_arrow(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow``, after sending this package to the executors (once per application)."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent.parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for module in sorted([root / "__init__.py", *root.glob("llm/*.py")]):
                z.write(module, f"{root.name}/{module.relative_to(root)}")
        spark.sparkContext.addPyFile(put(spark, f"panelwise-{uuid.uuid4().hex}.zip", packed.getvalue()))
        _SHIPPED.add(app)
    return df.mapInArrow(task, schema)


def text_of(name: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))
