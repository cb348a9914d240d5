"""Runs (maximal periodic stretches) of the words of a text, and texts without their repeated periods.

The words of a text enter a suffix automaton one by one. The tree of its suffix links is a link-cut tree: every path
segment holds the states whose strings last ended at the same word. Appending word ``i`` accesses the state of the
whole prefix; the access walks up the segments, and each of them tells the longest suffix that ended at ``e`` before.
If that suffix is not shorter than ``i - e``, it overlaps or touches its earlier self: a square, and with it the run
of period ``i - e`` that begins where the suffix began at ``e``. While the run lasts, every further word reports it
again, which moves its end. The access then joins all segments to one that ended at ``i``.

A run of at least ``LEAST`` words and two periods has, at both ends of every period, stretches of ``WINDOW`` words
that occur again inside the run. So only zones enter the automaton: maximal stretches covered by windows that occur
twice within their own zone, found by hashes for whole batches and narrowed until nothing changes. Words and windows
are compared by 64-bit hashes. A document is one row and is worked on in one task; tasks hold one piece of a batch.

Defined results: null and empty texts have no words, no runs and an empty remaining text; a document without id is
left as it is by ``looped``; repeated rows give repeated rows; columns other than the id and the text are ignored; an
empty table gives no rows. Texts may have any length: time is ``n log n`` in the words of a zone.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import flat_text, mixed, pieces, run_hashes, spread
from panelwise.llm.common import in_arrow

#: A run has at least so many words (and two periods).
LEAST = 12
#: Every run of ``LEAST`` words repeats stretches of so many words.
WINDOW = LEAST // 2


class Runs:
    """Suffix automaton over a growing word sequence, with its link tree as a link-cut tree.

    ``ends[start, period]`` is where each run found so far ends (exclusive).
    """

    def __init__(self) -> None:
        self.size = 0
        self.ends: dict[tuple[int, int], int] = {}
        self._last = 0
        # automaton: longest length, suffix link, the first transition, and further ones
        self._length, self._link = array("i", [0]), array("i", [-1])
        self._word, self._to = array("i", [-1]), array("i", [-1])
        self._more: dict[int, dict[int, int]] = {}
        # link-cut tree: parent (or path parent), shallower and deeper child, last end (valid at the root of a segment)
        self._up, self._lo, self._hi, self._seen = array("i", [-1]), array("i", [-1]), array("i", [-1]), array("i", [0])

    def _state(self, length: int, word: int = -1, to: int = -1) -> int:
        for column, value in (
            (self._length, length), (self._link, -1), (self._word, word), (self._to, to),
            (self._up, -1), (self._lo, -1), (self._hi, -1), (self._seen, 0),
        ):
            column.append(value)
        return len(self._length) - 1

    def _goes(self, state: int, word: int) -> int:
        if self._word[state] == word:
            return self._to[state]
        more = self._more.get(state)
        return more.get(word, -1) if more else -1

    def _lead(self, state: int, word: int, to: int) -> None:
        if self._word[state] in (-1, word):
            self._word[state], self._to[state] = word, to
        else:
            self._more.setdefault(state, {})[word] = to

    def append(self, word: int) -> None:
        """Add a word (a number from 0), and note the runs that it begins or continues."""
        length, link = self._length, self._link
        new = self._state(length[self._last] + 1)
        at = self._last
        while at >= 0 and self._goes(at, word) < 0:
            self._lead(at, word, new)
            at = link[at]
        if at < 0:
            parent = 0
        else:
            parent = self._goes(at, word)
            if length[at] + 1 != length[parent]:
                parent = self._split(parent, at, word)
        link[new] = self._up[new] = parent
        self._last = new
        self.size += 1
        self._access(new)

    def _split(self, whole: int, at: int, word: int) -> int:
        """A state for the shorter strings of ``whole``; in the tree it comes directly above, in the same segment."""
        part = self._state(self._length[at] + 1, self._word[whole], self._to[whole])
        if whole in self._more:
            self._more[part] = dict(self._more[whole])
        self._link[part] = self._link[whole]
        while at >= 0 and self._goes(at, word) == whole:
            self._lead(at, word, part)
            at = self._link[at]
        self._link[whole] = part
        self._splay(whole)
        above = self._lo[whole]
        self._lo[part] = above
        if above >= 0:
            self._up[above] = part
        self._up[part] = whole
        self._lo[whole] = part
        return part

    def _rotate(self, x: int) -> None:
        up, lo, hi = self._up, self._lo, self._hi
        p = up[x]
        g = up[p]
        if lo[p] == x:
            inner = hi[x]
            lo[p], hi[x] = inner, p
        else:
            inner = lo[x]
            hi[p], lo[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if lo[g] == p:
                lo[g] = x
            elif hi[g] == p:
                hi[g] = x

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its segment's splay tree, which takes over the segment's last end."""
        up, lo, hi, seen = self._up, self._lo, self._hi, self._seen
        while True:
            p = up[x]
            if p < 0 or (lo[p] != x and hi[p] != x):
                return
            g = up[p]
            if g < 0 or (lo[g] != p and hi[g] != p):
                seen[x] = seen[p]
                self._rotate(x)
                return
            seen[x] = seen[g]
            self._rotate(p if (lo[g] == p) == (lo[p] == x) else x)
            self._rotate(x)

    def _access(self, state: int) -> None:
        up, hi, seen, length = self._up, self._hi, self._seen, self._length
        i, deeper, x = self.size, -1, state
        while x >= 0:
            self._splay(x)
            end = seen[x]
            if end and i - end <= length[x]:
                self.ends[end - length[x], i - end] = i
            rest = hi[x]
            if rest >= 0:  # deeper states off the path keep their last end, as a segment of their own
                seen[rest] = end
            hi[x] = deeper
            deeper = x
            x = up[x]
        self._splay(state)
        seen[state] = i


def runs_of(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``least`` words, by start, then period."""
    found = Runs()
    for w in words:
        found.append(w)
    lengths = ((s, e - s, q) for (s, q), e in found.ends.items())
    return sorted((s, n, q) for s, n, q in lengths if n >= max(least, 2 * q))


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of the rows begins and ends (bytes), and each row's first word."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, at)


def looped(doc_id: int | None, words: int) -> np.ndarray:
    """Which original word stands at each place: a tenth of the documents repeat a stretch to their end."""
    place = np.arange(words)
    if doc_id is None or not words:
        return place
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return place
    g = h // 10
    a = g % words
    place[a:] = a + (place[a:] - a) % (1 + (words - a) // (3 + g % 8))
    return place


def _occur_twice(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice = np.empty(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    return twice


def zones(words: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(row, begin, end)`` of the stretches that can hold runs, in order; ``words`` are hashes of all rows' words."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts = np.flatnonzero(np.arange(len(words)) + WINDOW <= at[1:][row]) if len(words) else np.zeros(0, np.int64)
    key = np.zeros(len(starts), np.uint64)
    for i in range(WINDOW):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + words[starts + i])
    row = row[starts]
    zone = row
    while len(starts):
        stays = _occur_twice(key ^ mixed(zone.astype(np.uint64) + np.uint64(1)))
        if stays.all():
            break
        starts, key, row = starts[stays], key[stays], row[stays]
        zone = np.cumsum(np.r_[True, (np.diff(starts) > WINDOW) | (np.diff(row) > 0)][: len(starts)])
    if len(starts):
        opens = np.flatnonzero(np.r_[True, np.diff(zone) > 0])
        closes = np.r_[opens[1:], len(starts)] - 1
        for o, c in zip(opens, closes):
            if starts[c] + WINDOW - starts[o] >= LEAST:
                yield int(row[o]), int(starts[o]), int(starts[c]) + WINDOW


def collapsed(docs: DataFrame, loop: bool = False, text_col: str = "text") -> DataFrame:
    """``doc_id, runs, kept``: the runs of each text, and its words without repeated periods, joined by one space.

    With ``loop``, the words are rearranged by ``looped`` first.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            ids = piece.column("doc_id")
            data, at = flat_text(piece.column("_text"))
            begin, end, at = word_spans(data, at)
            words = run_hashes(data, begin, end)
            if loop:
                names = ids.to_pylist()
                place = [at[r] + looped(names[r], int(at[r + 1] - at[r])) for r in range(len(names))]
                place = np.concatenate([*place, np.zeros(0, np.int64)])
                words, begin, end = words[place], begin[place], end[place]
            runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ids))]
            kept = np.ones(len(words), bool)
            for r, b, e in zones(words, at):
                for s, n, q in runs_of(np.unique(words[b:e], return_inverse=True)[1].tolist()):
                    runs[r].append((b + s - int(at[r]), n, q))
                    kept[b + s + q : b + s + n] = False
            lists = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in sorted(x)] for x in runs], kind)
            at = np.r_[0, np.cumsum(kept)][at]
            yield pa.RecordBatch.from_arrays([ids, lists, _joined(data, begin[kept], end[kept], at)], ["doc_id", "runs", "kept"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string"
    return in_arrow(docs.select("doc_id", F.col(text_col).alias("_text")), task, schema)


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> pa.Array:
    """The words of each row, joined by single spaces."""
    size = end - begin + 1
    out = np.append(data, np.uint8(32))[spread(begin, size)]
    stops = np.cumsum(size)
    out[stops - 1] = 32
    edges = np.r_[0, stops][at]
    texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    return pa.array(texts, pa.binary()).cast(pa.string())


def digest(docs: DataFrame) -> DataFrame:
    """Per looped document: number of runs, the longest one, and digests of all runs and of the remaining text."""
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS length, r.start AS start, r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return collapsed(docs, loop=True).select("doc_id", "runs", "kept", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("kept"), 256).alias("collapsed_sha256"),
    )
