"""Text in Arrow batches as flat byte arrays, and ragged-array helpers for work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; arrays made of them take many times as much.
TEXT_BYTES = 1 << 20
#: Neighbouring places whose counts travel as one row.
SLOTS_A_ROW = 1 << 10


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, in order, as record batches of about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, done + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, nulls as empty, and where each row begins (one more entry than rows)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] ... starts[i] + lengths[i] - 1`` of all ``i``, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values scrambled (the splitmix finalizer), as a new array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C55) -> np.ndarray:
    """64-bit polynomial hashes of the runs ``values[begins[i]:ends[i]]``, scrambled; equal runs hash equally.

    One pass of running sums of ``value * base^position``; a run's sum times ``base^-begin`` is its hash.
    """
    n = len(values)
    odd = np.uint64(base | 1)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(odd, n), out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * powers(inverse, n + 1)[begins] + (ends - begins).astype(np.uint64))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base^0 ... base^(n-1)`` modulo 2^64."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.empty(max(n, 1 << 16), np.uint64)
        known[0] = 1
        filled = 1
        while filled < len(known):
            more = min(filled, len(known) - filled)
            known[filled : filled + more] = known[:more] * np.uint64(int(known[filled - 1]) * int(base) % (1 << 64))
            filled += more
        if len(known) <= 8 * TEXT_BYTES:
            _POWERS[int(base)] = known
    return known[:n]


def counts_sent(seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``part, counts``: the counts of ``SLOTS_A_ROW`` places a row, all lowest bytes first, so that they compress well."""
    rows = seen.reshape(-1, SLOTS_A_ROW)
    parts = np.flatnonzero(rows.any(axis=1))
    counts = [rows[p].view(np.uint8).reshape(-1, 8).T.tobytes() for p in parts.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(counts, pa.binary())], ["part", "counts"])


def counts_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``slot, n`` from all rows of the task's parts."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            own = np.ascontiguousarray(np.frombuffer(counts.as_buffer(), np.uint8).reshape(8, -1).T).view(np.int64)[:, 0]
            total[part] = total[part] + own if part in total else own
    for part, n in total.items():
        some = np.flatnonzero(n)
        slot = (part * SLOTS_A_ROW + some).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n[some])], ["slot", "n"])
