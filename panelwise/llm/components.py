"""Connected groups: components of a set of links, and groups of rows that share buckets.

``components`` finds the smallest id reachable from each id by alternating large-star and small-star steps. Minima
per id combine map-side, and every step is a plain join that adaptive execution can split, so one id may have any
number of links.

``grouped`` finds the components of "linked" among rows that share a bucket without testing all pairs of a bucket.
First every bucket's member that shares most buckets with most others becomes its centre and is tested against the
rest: in a group of copies of one original that is the original, and nearly all are connected at once. Buckets whose
members are then connected are done. In the others, members of different components are compared by small sketches
inside tasks, a block of a bucket against a block at a time, so that a bucket of any size is spread over many tasks; only
pairs whose sketches are close enough, each once, are tested. Pairs within a component are never looked at.

Where a test can be made from what travels with a member (``Proof``), it is made in the same task: pairs that fail never
leave it, and of those that hold only the ones that connect what was not connected yet, at most one less than the
members of the two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import in_arrow, settled

#: Members of a bucket that meet in one task at once, about.
BLOCK = 1024


class Proof(Protocol):
    """A test of two members inside a task."""

    def prepared(self, texts: Sequence[str]) -> list:
        """What the test looks at, of each text."""

    def linked(self, a, b) -> bool:
        """Whether two members, prepared, are linked."""


def components(links: DataFrame) -> DataFrame:
    """``id, root`` of all ids that occur in ``links`` (``a, b``); ``root`` is the smallest id of the component."""
    edges = settled(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(low, "u")
        edges = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = settled(edges.filter("u > v").distinct(), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )


def several(members: DataFrame) -> DataFrame:
    """The members of buckets with two members at least."""
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return members.join(full, "bucket", "left_semi")


def grouped(
    members: DataFrame,
    link: Callable[[DataFrame], DataFrame],
    sketches: DataFrame,
    likely: Callable,
    texts: DataFrame | None = None,
    proof: Proof | None = None,
    narrowed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``id, root`` of all ids with a link.

    ``members`` are distinct ``bucket, id``; ``link`` keeps the linked pairs of ``a < b``; ``sketches`` has ``id, sketch,
    keys`` (bytes): what ``likely`` compares, and the low 32 bits of all buckets of the id, in the same places for
    every id, or nothing where these places differ; a pair then comes from every bucket it shares, and is tested once all
    the same. ``likely`` takes two arrays of sketches, one sketch a row, and says for all pairs whether to test them.
    With ``texts`` (``id, text``) and ``proof`` close pairs are tested where they meet, with the same result as by ``link``.
    ``narrowed`` may leave out rows of ``bucket, id, root, n`` that are not likely linked with one of another root in their
    bucket, and deal the others to other buckets; only those take sketches and texts along.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    degrees = members.join(sizes, "bucket").groupBy("id").agg(F.sum("n").alias("degree"))
    ranked = settled(members.join(degrees, "id").select("bucket", "id", "degree"), "members")
    best = F.max(F.struct("degree", F.xxhash64("id").alias("h"), "id"))["id"]
    centres = ranked.groupBy("bucket").agg(best.alias("centre"))
    stars = _tested(ranked.join(centres, "bucket").filter("id <> centre").select("id", "centre"), link)
    labels = settled(components(stars), "labels")
    now = ranked.join(labels, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    now = settled(now, "rooted")
    split = now.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    split = split.filter("low < high").select("bucket", "n")
    apart = now.join(split, "bucket")
    apart = (settled(narrowed(apart), "apart") if narrowed else apart).join(sketches, "id")
    if proof is None:
        pairs = _close(apart.withColumn("text", F.lit("")), likely, None)
        found = _tested(pairs.select(F.col("a").alias("id"), F.col("b").alias("centre")), link)
    else:
        found = settled(_close(apart.join(texts, "id"), likely, proof), "found")
    return components(labels.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(found))


def _tested(pairs: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    once = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    return settled(link(settled(once, "pairs")).select("a", "b").distinct(), "found")


def _close(rows: DataFrame, likely: Callable, proof: Proof | None) -> DataFrame:
    """The pairs ``a, b`` of one bucket and different roots with close sketches, in the first bucket they share; with
    ``proof`` links that connect all of them that are linked."""
    spread = rows.withColumn("blocks", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} AS int)"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    spread = spread.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "root", "sketch", "keys", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, i, j, group in _runs(batches):
            column = {c: np.concatenate([g[c] for g in group]) for c in group[0]}
            forest = _Forest(column, proof) if proof else None
            left = np.flatnonzero(column["block"] == i)
            right = left if i == j else np.flatnonzero(column["block"] == j)
            for rows_ in np.array_split(left, max(1, len(left) * len(right) >> 17)):
                ok = column["root"][rows_][:, None] != column["root"][right][None, :]
                if i == j:
                    ok &= rows_[:, None] < right[None, :]
                if not ok.any():
                    continue
                ok &= likely(column["sketch"][rows_], column["sketch"][right])
                x, y = np.nonzero(ok)
                x, y = rows_[x], right[y]
                here = np.ones(len(x), bool)
                if column["keys"].shape[1]:
                    same = column["keys"][x] == column["keys"][y]
                    first = np.where(same, column["keys"][x], np.uint32(0xFFFFFFFF)).min(axis=1, initial=0xFFFFFFFF)
                    here = first == np.uint32(bucket & 0xFFFFFFFF)
                x, y = x[here], y[here]
                if forest:
                    x, y = forest.grown(x, y)
                yield pa.RecordBatch.from_arrays([pa.array(column["id"][z]) for z in (x, y)], ["a", "b"])

    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = spread.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return in_arrow(dealt, compare, "a long, b long")


class _Forest:
    """Which members of two blocks are connected so far, and the test that connects more."""

    def __init__(self, column: dict, proof: Proof) -> None:
        self._text, self._proof = column["text"], proof
        roots, self._tree = np.unique(column["root"], return_inverse=True)
        self._up = list(range(len(roots)))
        self._ready: dict[int, object] = {}

    def _root(self, tree: int) -> int:
        while self._up[tree] != tree:
            self._up[tree] = self._up[self._up[tree]]
            tree = self._up[tree]
        return tree

    def grown(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs, those that hold and connect two trees."""
        kept = []
        for begin in range(0, len(x), 1 << 12):
            some = range(begin, min(begin + (1 << 12), len(x)))
            open_ = [k for k in some if self._root(self._tree[x[k]]) != self._root(self._tree[y[k]])]
            fresh = sorted({int(m) for k in open_ for m in (x[k], y[k])} - self._ready.keys())
            self._ready.update(zip(fresh, self._proof.prepared([self._text[m] for m in fresh])))
            for k in open_:
                a, b = self._root(self._tree[x[k]]), self._root(self._tree[y[k]])
                if a != b and self._proof.linked(self._ready[int(x[k])], self._ready[int(y[k])]):
                    self._up[max(a, b)] = min(a, b)
                    kept.append(k)
        return x[kept], y[kept]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[dict]]]:
    """Consecutive rows of equal ``bucket, i, j`` as arrays, from any number of batches."""
    held, group = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {c: batch.column(c).to_numpy() for c in ("bucket", "i", "j", "block", "id", "root")}
        column["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        column["keys"] = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint32)
        column["keys"] = column["keys"].reshape(batch.num_rows, len(column["keys"]) // batch.num_rows)
        column["text"] = np.array(batch.column("text").to_pylist(), object)
        change = np.flatnonzero(np.any([column[c][1:] != column[c][:-1] for c in ("bucket", "i", "j")], axis=0)) + 1
        for begin, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            key = tuple(int(column[c][begin]) for c in ("bucket", "i", "j"))
            if held is not None and key != held:
                yield *held, group
                group = []
            held = key
            group.append({c: v[begin:end] for c, v in column.items()})
    if held is not None:
        yield *held, group
