"""Feature store: one table per family and split, and tables assembled from chosen columns.

Layout: ``{root}/{family}/{split}``. A selection maps a family to ``"all"``, to a list of column
names, or to the name of a group file ``{groups}/{family}/{name}.txt`` with one column name per line.
With ``buckets`` a family is stored bucketed and sorted by key, and joins of such families need no
shuffle.

Beside the files of a family lies a manifest, ``{root}/{family}/{split}.manifest``: key, buckets, columns, and a hash of
the columns and the files' names. It is written last. Any session that reads the family opens it as the manifest says,
bucketed or not; files that are not those of the manifest are an error, since a wrong belief about their buckets would
give wrong joins.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions.scalar import quoted
from panelwise.sources.tables import join_on_key

Selection = dict[str, str | list[str]]


def _path(root: str, family: str, split: str) -> str:
    return f"{root}/{family}/{split}"


def _table_name(root: str, family: str, split: str) -> str:
    """A catalog name for exactly this path."""
    return "panelwise_" + hashlib.sha256(_path(root, family, split).encode()).hexdigest()[:32]


@dataclass(frozen=True)
class Manifest:
    """What is stored for one family and split."""

    key: str | None
    buckets: int | None
    columns: list[list[str]]  # name and type
    files: int
    layout: str  # hash of columns and file names


def _described(spark: SparkSession, path: str, key: str | None, buckets: int | None) -> Manifest:
    files = spark.read.parquet(path)
    columns = [[f.name, f.dataType.simpleString()] for f in files.schema.fields]
    names = sorted(f.rsplit("/", 1)[-1] for f in files.inputFiles())
    return Manifest(key, buckets, columns, len(names), hashlib.sha256(json.dumps([columns, names]).encode()).hexdigest())


def _manifest_file(spark: SparkSession, root: str, family: str, split: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{_path(root, family, split)}.manifest")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_manifest(spark: SparkSession, root: str, family: str, split: str) -> Manifest | None:
    """The manifest of a family, or None if it has none."""
    files, place = _manifest_file(spark, root, family, split)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, root: str, family: str, split: str, manifest: Manifest) -> None:
    files, place = _manifest_file(spark, root, family, split)
    out = files.create(place, True)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()


def write_family(
    df: DataFrame, root: str, family: str, split: str, key: str | None = None, buckets: int | None = None
) -> None:
    spark, path = df.sparkSession, _path(root, family, split)
    # a catalog entry of an earlier write may have other columns or buckets; dropping it keeps the files
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(root, family, split)}")
    files, place = _manifest_file(spark, root, family, split)
    files.delete(place, False)  # none until the new files are complete
    if buckets is None:
        df.write.mode("overwrite").parquet(path)
    else:
        (
            df.repartition(buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(_table_name(root, family, split))
        )
    _write_manifest(spark, root, family, split, _described(spark, path, key, buckets))


def read_family(spark: SparkSession, root: str, family: str, split: str) -> DataFrame:
    """The family as its manifest describes it: bucketed, in a session that has never seen it too."""
    path, manifest = _path(root, family, split), read_manifest(spark, root, family, split)
    if manifest is None:
        return spark.read.parquet(path)
    if _described(spark, path, manifest.key, manifest.buckets) != manifest:
        raise ValueError(f"the files of {path} are not those of its manifest; write the family again")
    if manifest.buckets is None:
        return spark.read.parquet(path)
    name = _table_name(root, family, split)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{quoted(c)} {kind}" for c, kind in manifest.columns)
        key = quoted(manifest.key)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {manifest.buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def open_bucketed(spark: SparkSession, root: str, family: str, split: str, key: str, buckets: int) -> DataFrame:
    """Read a family that must be bucketed like this; anything else is an error."""
    manifest = read_manifest(spark, root, family, split)
    if manifest is None or (manifest.key, manifest.buckets) != (key, buckets):
        raise ValueError(f"{_path(root, family, split)} is not bucketed by {key} into {buckets}")
    return read_family(spark, root, family, split)


def read_group(spark: SparkSession, groups: str, family: str, name: str) -> list[str]:
    """Column names of a group, in file order; the part files of a folder follow each other by name."""
    parts = spark.read.text(f"{groups}/{family}/{name}.txt", wholetext=True)
    found = parts.select("value", F.col("_metadata.file_name").alias("file")).orderBy("file").collect()
    return [line.strip() for part in found for line in part["value"].splitlines() if line.strip()]


def write_group(spark: SparkSession, groups: str, family: str, name: str, columns: Sequence[str]) -> None:
    """A group of column names, to be read by ``read_group`` in the same order."""
    rows = spark.createDataFrame([(c,) for c in columns], "value string").coalesce(1)
    rows.write.mode("overwrite").text(f"{groups}/{family}/{name}.txt")


def resolved_features(
    spark: SparkSession, root: str, split: str, selection: Selection, key: str, groups: str | None = None
) -> dict[str, list[str]]:
    """Column names per family that a selection stands for. The key is not a feature."""
    out = {}
    for family, wanted in selection.items():
        if wanted == "all":
            names = read_family(spark, root, family, split).columns
        elif isinstance(wanted, str):
            names = read_group(spark, groups, family, wanted)
        else:
            names = list(wanted)
        out[family] = [n for n in names if n != key]
    return out


def assemble(
    spark: SparkSession, root: str, split: str, selection: Selection, key: str, groups: str | None = None
) -> DataFrame:
    """Chosen columns of several families side by side, joined by key.

    If two families bring the same column name, the later family wins, as when files are overwritten. A key that
    some family lacks stays, with NULL in that family's columns.
    """
    names = resolved_features(spark, root, split, selection, key, groups)
    owner = {n: family for family, columns in names.items() for n in columns}
    parts = [
        read_family(spark, root, family, split).select(key, *[n for n in dict.fromkeys(columns) if owner[n] == family])
        for family, columns in names.items()
    ]
    return join_on_key(parts, key, "full").select(key, *owner)


def consolidate(
    spark: SparkSession, root: str, families: Sequence[str], split: str, key: str, name: str = "all_features",
    buckets: int | None = None,
) -> None:
    """Store all columns of the families as one more family, bucketed by key if ``buckets`` is given."""
    whole = assemble(spark, root, split, {f: "all" for f in families}, key)
    write_family(whole, root, name, split, key, buckets)


def feature_record(spark: SparkSession, names: dict[str, list[str]]) -> DataFrame:
    """``(family, position, feature)``: what a model was trained on, kept next to it."""
    rows = [(f, i, n) for f, columns in names.items() for i, n in enumerate(columns)]
    return spark.createDataFrame(rows, "family string, position int, feature string")


def read_record(record: DataFrame) -> dict[str, list[str]]:
    """Back to a selection (one row per feature: a small table)."""
    out: dict[str, list[str]] = {}
    for r in record.orderBy("family", "position").collect():
        out.setdefault(r["family"], []).append(r["feature"])
    return out
