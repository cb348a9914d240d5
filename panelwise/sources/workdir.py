"""Where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    named = tempfile.mkdtemp(prefix="panelwise-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/panelwise-{purpose}-{uuid.uuid4().hex}"
