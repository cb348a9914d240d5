"""Near-duplicate documents by SuperMinHash signatures, bands, verification and connected groups.

Each distinct shingle of a document draws a random permutation of the signature's places, one place per level, and a
random value in ``[level, level + 1)`` for it; a place keeps its smallest value. A document is finished at the first
level that leaves no place empty, since later values are larger: that is the early stop. Documents of a batch go
through the levels together, as arrays.

``BANDS`` bands of ``ROWS`` places, the first half of ``PLACES``, make two documents candidates; at a similarity of 0.8 a
pair is missed with a probability below 1e-7. Within large buckets a pair is verified if it agrees in ``CLOSE`` of all
places, four standard deviations below 0.8, and if the sizes of the sets allow the similarity. Documents with equal shingle sets are one node first (any number of exact copies costs one
row per copy); nodes that share a band are compared by ``components.grouped`` on the full shingle sets of their
texts. Shingles are compared by 64-bit hashes.

Defined results: a document without words has an empty set and is linked with nothing; fewer words than a shingle
make one shingle of all of them; rows of equal sets are one group, repeated rows too; a row without id takes the
smallest id of its group and is never kept if it has one; other columns are ignored; an empty table gives no rows.
Rows are told apart by a hash of id and text, so rows without id, and different texts of one id, are documents of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import flat_text, mixed, pieces, run_hashes
from panelwise.llm.common import in_arrow, settled, shielded
from panelwise.llm.components import grouped, several

BANDS, ROWS = 32, 4
PLACES = 256
CLOSE = 0.7
#: Shingles that go through the levels at once.
AT_ONCE = 1 << 17
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all rows, and where each row's begin."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    fresh = np.zeros(len(data) + 1, bool)
    fresh[at] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | fresh[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return run_hashes(data, begin, end), np.searchsorted(begin, at)


def shingles(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, sorted, and where each row's begin."""
    words, at = words_of(data, at)
    count = np.diff(at)
    number = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(number)), number)
    first = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(len(row))
    length = np.minimum(count, size)[row]
    total = length.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        total = total + np.where(k < length, padded[first + k] + np.uint64(k), np.uint64(0)) * ODD[k % len(ODD)]
    total = mixed(total)
    order = np.lexsort((total, row))
    total, row = total[order], row[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (row[1:] != row[:-1])
    return total[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(number)))]).astype(np.int64)


def signatures(grams: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash signatures of all rows (rows without shingles stay infinite)."""
    out = np.full((len(at) - 1, places), np.inf)
    row, begin = 0, 0
    while row < len(out):
        end = max(row + 1, int(np.searchsorted(at, at[row] + AT_ONCE, side="right")) - 1)
        _levels(grams[at[row] : at[end]], np.repeat(np.arange(end - row), np.diff(at[row : end + 1])), out[row:end])
        row = end
    return out


def _levels(grams: np.ndarray, row: np.ndarray, out: np.ndarray) -> None:
    places = out.shape[1]
    order = None
    flat = out.reshape(-1)
    for level in range(places):
        if not len(grams):
            return
        draw = mixed(grams + np.uint64(int(ODD[0]) * (2 * level + 1) % (1 << 64)))
        value = (draw >> np.uint64(11)) * 2.0**-53 + level
        pick = level + ((mixed(draw ^ ODD[1]) >> np.uint64(32)) * np.uint64(places - level) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(grams))
        if order is None:
            place = pick
        else:
            place = order[rows, pick].astype(np.int64)
        np.minimum.at(flat, row * places + place, value)
        empty = np.isinf(out).any(axis=1)
        going = empty[row]
        if order is None:
            order = np.tile(np.arange(places, dtype=np.uint16), (int(going.sum()), 1))
            pick, rows = pick[going], np.arange(len(order))
            order[rows, pick] = 0
        else:
            order[rows, pick] = order[:, level]
            order = order[going]
        grams, row = grams[going], row[going]


def bands(signature: np.ndarray, number: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    bits = signature.view(np.uint64).reshape(len(signature), number, rows)
    key = np.broadcast_to(ODD[2] * (np.arange(number, dtype=np.uint64) + np.uint64(1)), bits.shape[:2])
    for k in range(rows):
        key = mixed(key ^ bits[:, :, k]) * ODD[3]
    return key


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def records(docs: DataFrame, size: int, number: int = BANDS, rows: int = ROWS, places: int = PLACES) -> DataFrame:
    """``doc_id, row, n_shingles, node, bands, sketch``: ``node`` is a hash of the shingle set, null if it is empty.

    ``sketch`` has eight bits of each place of the signature, and the size of the set.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            grams, at = shingles(*flat_text(piece.column("text")), size)
            node = set_hashes(grams, at)
            count = np.diff(at)
            signature = signatures(grams, at, places)
            key = bands(np.ascontiguousarray(signature[:, : number * rows]), number, rows)[count > 0]
            bits = (mixed(signature.view(np.uint64)) & np.uint64(255)).astype(np.uint8)
            sketch = pa.array([row.tobytes() + n.tobytes() for row, n in zip(bits, count.astype(np.uint32))], pa.binary())
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum((count > 0) * number)]), pa.int32()), pa.array(key.reshape(-1).view(np.int64))
            )
            columns = [piece.column("doc_id"), piece.column("row"), pa.array(count), pa.array(node, mask=count == 0), lists, sketch]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_shingles", "node", "bands", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(_keyed(docs), work, f"doc_id {kind}, row long, n_shingles long, node long, bands array<long>, sketch binary")


def alike(percent: int):
    """A test whether sketches agree in ``CLOSE`` of their places, and sizes (the last four bytes) in ``percent`` of the larger."""

    def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        least = CLOSE * (a.shape[1] - 4)
        left, right = (np.ascontiguousarray(x[:, -4:]).view(np.uint32).reshape(-1).astype(np.int64) for x in (a, b))
        sizes = 100 * np.minimum(left[:, None], right) >= percent * np.maximum(left[:, None], right)
        return sizes & np.stack([np.count_nonzero(b[:, :-4] == row[:-4], axis=1) >= least for row in a])

    return test


def set_hashes(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit hash per set, whatever the order of its members."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams ^ ODD[4]))])
    return mixed((sums[at[1:]] - sums[at[:-1]]) + np.diff(at).astype(np.uint64) * ODD[1]).view(np.int64)


class Overlap:
    """The test of two texts: full shingle sets that overlap by ``percent`` of their union."""

    def __init__(self, size: int, percent: int) -> None:
        self.size, self.percent = size, percent

    def prepared(self, texts: list[str]) -> list[np.ndarray]:
        grams, at = shingles(*flat_text(pa.array(texts, pa.large_string())), self.size)
        return [grams[b:e] for b, e in zip(at[:-1], at[1:])]

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets overlap by ``percent`` of their union; ``texts`` has ``node, text``."""
    overlap = Overlap(size, percent)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def sets(nodes: list[int], column: pa.Array) -> list[np.ndarray]:
            fresh = {n: i for i, n in enumerate(nodes) if n not in known}
            at_once = list(fresh.values())
            grams, at = shingles(*flat_text(column.take(pa.array(at_once, pa.int64()))), size)
            local = {nodes[i]: grams[at[k] : at[k + 1]] for k, i in enumerate(at_once)}
            return [known[n] if n in known else local[n] for n in nodes]

        for batch in batches:
            for piece in pieces([batch], "text_a", 1 << 20):
                a, b = (piece.column(c).to_pylist() for c in ("a", "b"))
                left, right = sets(a, piece.column("text_a")), sets(b, piece.column("text_b"))
                known = {n: g for n, g in [*zip(a[-4:], left[-4:]), *zip(b[-4:], right[-4:])]}
                mask = np.array([overlap.linked(x, y) for x, y in zip(left, right)], bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(v, np.int64)[mask]) for v in (a, b)], ["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return in_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), check, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, number: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the smallest id of each document's group, and whether it is the document's own."""
    return _rooted(docs, size, percent, number, rows).select("doc_id", "n_shingles", "component_id", "kept")


def _rooted(docs: DataFrame, size: int, percent: int, number: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, row, n_shingles, root, component_id, kept``; ``root`` names the group, null without shingles."""
    made = settled(records(docs, size, number, rows), "superminhash")
    nodes = made.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("one"), F.min("row").alias("row"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = settled(nodes, "nodes")
    members = settled(several(nodes.select(F.explode("bands").alias("bucket"), F.col("node").alias("id")).distinct()), "buckets")
    wanted = members.select(F.col("id").alias("node")).distinct().join(nodes.select("node", "row"), "node")
    texts = _keyed(docs).select("row", "text").join(wanted, "row")
    texts = settled(_own(texts, size), "texts")
    sketches = in_arrow(nodes.select("node", "bands", "sketch"), _keys, "id long, sketch binary, keys binary")
    told = texts.select(F.col("node").alias("id"), "text")
    roots = grouped(members, lambda pairs: verified(pairs, texts, size, percent), sketches, alike(percent), told, Overlap(size, percent))
    named = nodes.select("node", "one").join(roots.withColumnRenamed("id", "node"), "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("one").alias("component_id"))
    named = named.join(smallest, "root").select("node", "root", "component_id")
    out = made.select("doc_id", "row", "n_shingles", "node").join(named, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).drop("node")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column("bands").flatten().to_numpy()
        keys = flat.view(np.uint64).astype(np.uint32).reshape(batch.num_rows, -1) if batch.num_rows else []
        columns = [batch.column("node"), batch.column("sketch"), pa.array([k.tobytes() for k in keys], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "sketch", "keys"])


def _own(texts: DataFrame, size: int) -> DataFrame:
    """``node, text`` where the text has the node's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            node = set_hashes(*shingles(*flat_text(piece.column("text")), size))
            yield piece.select(["node", "text"]).filter(pa.array(node == piece.column("node").to_numpy()))

    return in_arrow(texts.select("node", "text"), work, "node long, text string").dropDuplicates(["node"])


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its own columns: the one with the smallest id; of several, one whatever their text.

    Documents without words stay, repeated rows once.
    """
    docs, back = shielded(docs, "doc_id", "text")
    kept = _rooted(docs, size, percent).filter("kept").select("row", "root")
    single = kept.filter("root IS NULL").select("row")
    rows = kept.filter("root IS NOT NULL").groupBy("root").agg(F.min("row").alias("row")).select("row").unionByName(single)
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    first = keyed.join(rows.select(F.col("row").alias("_row")), "_row", "left_semi")
    return back(first.dropDuplicates(["_row"]))
