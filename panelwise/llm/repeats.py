"""Removing repeated byte strings across documents with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document of a smaller id. Such strings
(windows) are found in whole texts in these steps.

1. Of each window the smallest hash of its ``GRAM``-byte grams is its anchor; windows next to each other with one anchor
   form a stretch. Equal windows have equal anchors, so only stretches whose anchor occurs in two documents matter.
2. Stretches with such anchors are dealt out by anchor, each distinct one once per task with the smallest id that has
   it. An anchor with one distinct stretch has no other to compare. The rest of every shard is concatenated; the suffix array (``suffixes``) and its permuted common
   prefixes bring equal windows together, and each window learns the smallest id of all stretches that hold it.
3. Each stretch then has an owner (the smallest id that holds all of it) and the windows that an even smaller id has.
   Every occurrence of the stretch meets them in a join: in documents other than the owner all its windows go.
4. The windows of each document are merged to spans and cut out.

Documents whose text equals that of a smaller id go as a whole before the first step. Rows meet only by hash joins;
frequent stretches travel once per task, and their occurrences are plain rows of a join that can be split. Bitmaps of
fixed size (``sieve``) keep rows out that cannot matter. Anchors, stretches and equal texts are told apart by 64-bit
hashes; windows are compared byte by byte.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep everything; a null id counts as larger than
all others; rows of one id do not remove from each other; repeated rows are treated alike; other columns are ignored;
an empty table gives no rows. The bytes kept need not be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import TEXT_BYTES, flat_text, mixed, pieces, powers, spread
from panelwise.llm.common import in_arrow, settled, text_of
from panelwise.llm.sieve import passes, sieve
from panelwise.llm.suffixes import permuted_prefixes, suffix_array

LENGTH, GRAM = 50, 20
#: Bytes of stretches in one suffix array, and wanted in one task.
SHARD_BYTES, TASK_BYTES = 1 << 18, 6 << 20
#: Bytes of text in which a stretch travels once.
PIECE_BYTES = 4 << 20
NO_ID = (1 << 63) - 1
#: An odd base of polynomial hashes modulo 2^64, and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C55)
BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))


class Stretches:
    """Runs of windows with one anchor: row, first byte, number of windows, anchor and hash of the bytes.

    Found in whole rows of about ``TEXT_BYTES`` at a time, as the arrays on the way take many times as much as the text.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM):
        self.data, self.at = data, at
        parts, begin = [], 0
        while begin < len(at) - 1:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + TEXT_BYTES, side="right")) - 1)
            row, start, *more = _stretches(data[at[begin] : at[end]], at[begin : end + 1] - at[begin], length, gram)
            parts.append((row + begin, start + at[begin], *more))
            begin = end
        empty = (np.zeros(0, np.int64),) * 5
        self.row, self.start, self.windows, self.anchor, self.hash = (np.concatenate(c) for c in zip(*parts or [empty]))


def _stretches(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, first byte, number of windows, anchor and hash of each stretch."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 5
    sums = _sums(data)
    low = _anchors(sums, length, gram)
    fits = np.zeros(len(low) + 1, np.int8)  # windows that end inside their row
    room = np.flatnonzero(np.diff(at) >= length)
    fits[at[room]] = 1
    np.add.at(fits, at[room + 1] - length + 1, -1)
    fits = np.cumsum(fits[:-1], dtype=np.int8).astype(bool)
    change = np.ones(len(low), bool)
    change[1:] = low[1:] != low[:-1]
    change[at[room]] = True
    change[1:] |= ~fits[:-1]
    start = np.flatnonzero(change & fits)
    upto = np.concatenate([[0], np.cumsum(fits)])
    windows = upto[np.append(start[1:], len(low))] - upto[start] if len(start) else start
    size = windows + length - 1
    hashes = mixed((sums[start + size] - sums[start]) * powers(BACK, len(sums))[start] + size.astype(np.uint64))
    return np.searchsorted(at, start, side="right") - 1, start, windows, low[start].view(np.int64), hashes.view(np.int64)


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums of ``(byte + 1) * BASE^position``: with a power of ``BACK``, the hash of any run of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def _anchors(sums: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The smallest gram hash of the window at each position."""
    low = mixed((sums[gram:] - sums[:-gram]) * powers(BACK, len(sums) - gram))
    wide, span = length - gram + 1, 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[: len(low) - (wide - span)], low[wide - span :]) if span < wide else low


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.withColumn("row", F.xxhash64("id", "text"))


def equal_to_smaller(rows: DataFrame) -> DataFrame:
    """``row`` of the documents whose whole text is that of a smaller id."""
    long = rows.filter(F.octet_length("text") >= LENGTH).select("id", "row", F.xxhash64("text").alias("t"), F.octet_length("text").alias("n"))
    least = long.groupBy("t", "n").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    return long.join(least, ["t", "n"]).filter("id > least").select("row").distinct()


class Corpus:
    """The documents without those equal to a smaller one, to be read several times."""

    def __init__(self, rows: DataFrame, gone: DataFrame):
        self.rows = rows
        self.gone = sieve(gone, "row")
        bitmap = self.gone

        def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(passes(bitmap.value, batch.column("row").to_numpy())))

        passed = in_arrow(rows.select("id", "text", "row"), maybe, "id long, text string, row long")
        self.doubtful = settled(passed.join(gone, "row", "left_anti"), "repeats-doubtful")

    def each(self, make, schema: str) -> DataFrame:
        """``make(ids, rows, stretches)`` over all documents; it returns record batches."""
        bitmap = self.gone

        def over(batches: Iterator[pa.RecordBatch], screen: bool) -> Iterator[pa.RecordBatch]:
            task = make()
            for batch in batches:
                if screen:
                    batch = batch.filter(pa.array(~passes(bitmap.value, batch.column("row").to_numpy())))
                for piece in pieces([batch], most=PIECE_BYTES):
                    yield task(piece.column("id").to_numpy(), piece.column("row").to_numpy(), Stretches(*flat_text(piece.column("text"))))

        most = in_arrow(self.rows.select("id", "text", "row"), lambda b: over(b, True), schema)
        return most.unionByName(in_arrow(self.doubtful.select("id", "text", "row"), lambda b: over(b, False), schema))


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def shared_anchors(corpus: Corpus) -> DataFrame:
    """``h``: the anchors that occur in documents of different ids."""

    def make():
        def task(ids: np.ndarray, rows: np.ndarray, found: Stretches) -> pa.RecordBatch:
            owner = ids[found.row]
            order = np.lexsort((owner, found.anchor))
            h, d = found.anchor[order], owner[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else order
            return _table(h=h[first], least=d[first], most=d[np.append(first[1:], len(h)) - 1] if len(h) else d)

        return task

    seen = corpus.each(make, "h long, least long, most long")
    return seen.groupBy("h").agg(F.min("least").alias("least"), F.max("most").alias("most")).filter("least < most").select("h")


def distinct_stretches(corpus: Corpus, kept: Broadcast) -> DataFrame:
    """``h, g, id, n, bytes``: stretches with shared anchors, each distinct one once per batch, with its smallest id."""

    def make():
        def task(ids: np.ndarray, rows: np.ndarray, found: Stretches) -> pa.RecordBatch:
            chosen = np.flatnonzero(passes(kept.value, found.anchor)) if len(found.anchor) else found.row
            g = found.hash[chosen]
            owner = ids[found.row[chosen]]
            order = np.lexsort((owner, g))
            new = np.ones(len(g), bool)
            new[1:] = g[order][1:] != g[order][:-1]
            one = order[new]
            n = np.diff(np.append(np.flatnonzero(new), len(g)))
            begin = found.start[chosen[one]]
            length = found.windows[chosen[one]] + (LENGTH - 1)
            at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            raw = found.data[spread(begin, length)].tobytes() if len(one) else b""
            text = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(raw)])
            return _table(h=found.anchor[chosen[one]], g=g[one], id=owner[one], n=n, bytes=text)

        return task

    return corpus.each(make, "h long, g long, id long, n long, bytes binary")


def earlier_windows(data: np.ndarray, at: np.ndarray, owner: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the window at each byte of the concatenated stretches is in a stretch of a smaller owner than its own."""
    count = np.diff(at)
    text = np.zeros(len(data) + len(count) + 1, np.uint16)
    raw = np.zeros(len(text), np.uint8)
    begin = at[:-1] + np.arange(len(count))
    place = spread(begin, count)
    text[place], raw[place] = data.astype(np.uint16) + 2, data
    text[begin + count] = 1
    whole = np.zeros(len(text), bool)
    whole[spread(begin, np.maximum(0, count - length + 1))] = True
    order = suffix_array(text, length)
    shared = permuted_prefixes(raw, order, whole, length)
    order = order[whole[order]]
    who = np.repeat(owner, count + 1)
    who = np.append(who, NO_ID)[order]
    fresh = ~shared[order]
    if len(fresh):
        fresh[0] = True
    groups = np.flatnonzero(fresh)
    least = np.repeat(np.minimum.reduceat(who, groups), np.diff(np.append(groups, len(order)))) if len(order) else who
    out = np.zeros(len(text), bool)
    out[order] = least < who
    return out[place]


def judged(stretches: DataFrame, shards: int) -> DataFrame:
    """``g, owner, earlier``: of each distinct stretch its smallest id and the ranges of windows that a smaller id has."""

    def shard(h: np.ndarray, g: np.ndarray, ids: np.ndarray, n: np.ndarray, parts: list[bytes]) -> pa.RecordBatch:
        order = np.lexsort((ids, g))
        new = np.ones(len(g), bool)
        new[1:] = g[order][1:] != g[order][:-1]
        one = order[new]
        times = np.add.reduceat(n[order], np.flatnonzero(new))
        _, which, many = np.unique(h[one], return_inverse=True, return_counts=True)
        compared = many[which] > 1
        size = np.array([len(parts[i]) for i in one.tolist()], np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        early = np.zeros(at[-1], bool)
        if compared.any():
            texts = [parts[i] for i in one[compared].tolist()]
            found = earlier_windows(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(size[compared])]), ids[one[compared]])
            early[np.repeat(compared, size)] = found
        step = np.diff(np.concatenate([[0], early.astype(np.int8), [0]]))
        up, down = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        holder = np.searchsorted(at, up, side="right") - 1
        ranges: dict[int, list[int]] = {}
        for i, a, b in zip(holder.tolist(), up.tolist(), down.tolist()):
            ranges.setdefault(i, []).extend((a - int(at[i]), b - int(at[i])))
        keep = np.flatnonzero((times > 1) | np.isin(np.arange(len(one)), holder))
        lists = pa.array([ranges.get(i, []) for i in keep.tolist()], pa.list_(pa.int32()))
        return _table(g=g[one][keep], owner=ids[one][keep], earlier=lists)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        h = rows.column("h").to_numpy()
        order = np.argsort(h, kind="stable")
        size = np.cumsum(pc.binary_length(rows.column("bytes")).to_numpy()[order].astype(np.int64))
        begin = 0
        while begin < len(order):
            end = int(np.searchsorted(size, (size[begin - 1] if begin else 0) + SHARD_BYTES, side="right"))
            end = max(end, begin + 1)
            end = int(np.searchsorted(h[order], h[order[end - 1]], side="right"))  # all stretches of an anchor together
            part = rows.take(pa.array(order[begin:end]))
            yield shard(*(part.column(c).to_numpy() for c in ("h", "g", "id", "n")), part.column("bytes").to_pylist())
            begin = end

    return in_arrow(stretches.repartition(shards, "h"), work, "g long, owner long, earlier array<int>")


def occurrences(corpus: Corpus, shared: Broadcast, kept: Broadcast) -> DataFrame:
    """``g, id, row, start, windows`` of the stretches that may have been judged."""

    def make():
        def task(ids: np.ndarray, rows: np.ndarray, found: Stretches) -> pa.RecordBatch:
            chosen = np.flatnonzero(passes(shared.value, found.anchor)) if len(found.anchor) else found.row
            g = found.hash[chosen]
            judged_ = passes(kept.value, g) if len(g) else np.zeros(0, bool)
            chosen, g = chosen[judged_], g[judged_]
            begin = (found.start - found.at[found.row])[chosen] if len(chosen) else chosen
            row = found.row[chosen]
            return _table(g=g, id=ids[row], row=rows[row], start=begin.astype(np.int32), windows=found.windows[chosen].astype(np.int32))

        return task

    return corpus.each(make, "g long, id long, row long, start int, windows int")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents as rows, the rows that go as a whole, and ``row, cuts``: windows to go as pairs of first byte and end."""
    rows = _prepared(docs, id_col, text_col)
    gone = settled(equal_to_smaller(rows), "repeats-equal")
    corpus = Corpus(rows, gone)
    anchors = settled(shared_anchors(corpus), "repeats-anchors")
    number = anchors.count()
    shared = sieve(anchors, "h")
    found = distinct_stretches(corpus, shared)
    known = settled(judged(found, max(4, -(-number * 4 * LENGTH // TASK_BYTES))), "repeats-judged")
    met = occurrences(corpus, shared, sieve(known, "g")).join(known, "g")
    late = met.filter("id > owner").select("row", "start", (F.col("start") + F.col("windows") + LENGTH - 1).alias("end"))
    own = met.filter("id = owner AND size(earlier) > 0").withColumn("k", F.explode(F.expr("sequence(0, size(earlier) - 1, 2)")))
    own = own.select("row", F.expr("start + earlier[k]").alias("start"), F.expr(f"start + earlier[k + 1] + {LENGTH - 1}").alias("end"))
    cuts = late.unionByName(own).distinct().groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    return rows, gone, settled(cuts, "repeats-cuts")


def _changed(rows: DataFrame, gone: DataFrame, cuts: DataFrame) -> DataFrame:
    """``row, removed, runs, kept`` of the documents that lose bytes, repeated rows repeatedly."""
    marks = cuts.select("row", "cuts", F.lit(False).alias("whole")).unionByName(
        gone.select("row", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"), F.lit(True).alias("whole"))
    )
    touched = sieve(marks, "row")

    def those(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(touched.value, batch.column("row").to_numpy())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out = []
            for text, pairs, whole in zip(*(piece.column(c).to_pylist() for c in ("text", "cuts", "whole"))):
                raw = text.encode()
                stay, at, runs, removed = [], 0, 0, 0
                for begin, end in [(0, len(raw))] if whole else merged(pairs or []):
                    stay.append(raw[at:begin])
                    at, runs, removed = end, runs + 1, removed + end - begin
                out.append((removed, runs, b"".join([*stay, raw[at:]])))
            columns = [*(pa.array([o[k] for o in out], pa.int64()) for k in range(2)), pa.array([o[2] for o in out], pa.binary())]
            yield pa.RecordBatch.from_arrays([piece.column("row"), *columns], ["row", "removed", "runs", "kept"])

    once = in_arrow(rows.select("row", "text"), those, "row long, text string").join(marks, "row")
    return in_arrow(once, cut, "row long, removed long, runs long, kept binary")


def _sized(rows: DataFrame, *more) -> DataFrame:
    return rows.select("doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"), *more)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` are the bytes that stay."""
    rows, gone, cuts = spans(docs, id_col, text_col)
    joined = _sized(rows, F.col("text").cast("binary").alias("whole")).join(_changed(rows, gone, cuts).dropDuplicates(["row"]), "row", "left")
    return joined.select("doc_id", "n_bytes", *_counts(), F.coalesce("kept", "whole").alias("kept"))


def _counts() -> list:
    return [F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in (("removed", "n_removed"), ("runs", "n_spans"))]


def merged(pairs: list[dict]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as maximal runs, in order."""
    out: list[list[int]] = []
    for begin, end in sorted((p["start"], p["end"]) for p in pairs):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, with digests instead of texts in the last join."""
    rows, gone, cuts = spans(docs)
    changed = _changed(rows, gone, cuts).select("row", "removed", "runs", F.sha2("kept", 256).alias("new")).dropDuplicates(["row"])
    joined = _sized(rows, F.sha2(F.col("text").cast("binary"), 256).alias("old")).join(changed, "row", "left")
    return joined.select("doc_id", "n_bytes", *_counts(), F.coalesce("new", "old").alias("kept_sha256"))
