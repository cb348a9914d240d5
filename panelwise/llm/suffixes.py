"""Suffix arrays of shards by induced sorting, as whole-array steps, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The substrings between leftmost S
positions are sorted by inducing: buckets of the first symbol are visited in order, and the predecessors of a bucket's
suffixes are appended to their own buckets, one wave of array operations at a time (a wave for each repetition of the
bucket's symbol). Their names make a reduced string; its suffixes are ordered by doubling, as far as ``depth`` symbols
of the text, because its alphabet is too large for buckets. A second inducing pass gives the order of all suffixes,
right for their first ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np

from panelwise.llm.batches import run_hashes


def smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last symbol must be the unique smallest."""
    n = len(text)
    less = np.append(text[:-1] < text[1:], True)
    decided = np.append(text[:-1] != text[1:], True)
    at = np.where(decided, np.arange(n), n)
    return less[np.minimum.accumulate(at[::-1])[::-1]]


def induced(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    size = np.bincount(text, minlength=symbols)
    end = np.cumsum(size)
    start = end - size
    out = np.full(len(text), -1, np.int32)
    mine = np.bincount(text[lms], minlength=symbols)
    by = np.argsort(text[lms], kind="stable")
    out[np.repeat(end - mine - (np.cumsum(mine) - mine), mine) + np.arange(len(lms))] = lms[by]
    head = start.copy()
    present = np.flatnonzero(size).tolist()

    def push(from_: np.ndarray, type_: bool, edge: np.ndarray, step: int) -> None:
        p = from_[from_ > 0] - 1
        p = p[small[p] == type_]
        if not len(p):
            return
        first = text[p]
        count = np.bincount(first, minlength=symbols)
        p = p[np.argsort(first, kind="stable")]
        rank = np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)
        base = np.repeat(edge, count)
        out[base + rank if step > 0 else base - 1 - rank] = p
        edge += step * count

    for c in present:
        done = start[c]
        while done < head[c]:
            wave = out[done : head[c]].copy()
            done = int(head[c])
            push(wave, False, head, 1)
        push(out[end[c] - mine[c] : end[c]].copy(), False, head, 1)
    tail = end.copy()
    last = len(text) - 1
    out[end[text[last]] - 1] = last
    tail[text[last]] -= 1
    for c in reversed(present):
        done = end[c]
        while done > tail[c]:
            wave = out[tail[c] : done][::-1].copy()
            done = int(tail[c])
            push(wave, True, tail, -1)
        push(out[start[c] : head[c]][::-1].copy(), True, tail, -1)
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (small non-negative symbols, the last one unique and smallest) ordered by ``depth`` symbols."""
    symbols = int(text.max()) + 1
    text = text.astype(np.uint16)
    small = smaller(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if len(lms) < 2:
        return induced(text, small, lms, symbols)
    order = induced(text, small, lms, symbols)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    place = np.empty(len(text), np.int32)
    place[lms] = np.arange(len(lms))
    sums = run_hashes(text, lms, np.append(lms[1:] + 1, len(text)))[place[order]]
    names = np.empty(len(lms), np.int64)
    names[place[order]] = np.concatenate([[0], np.cumsum(sums[1:] != sums[:-1])])
    return induced(text, small, lms[reduced(names, depth)], symbols)


def reduced(names: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of the reduced string in order; every name stands for two symbols at least."""
    rank, span = names, 1
    while True:
        if span * 2 > depth + 2 or int(rank.max()) + 1 == len(rank):
            return np.argsort(rank, kind="stable")
        after = np.zeros(len(rank), np.int64)
        after[:-span] = rank[span:] + 1
        key = rank * (len(rank) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        span *= 2


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(np.uint64).reshape(-1)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, wanted: np.ndarray, most: int) -> np.ndarray:
    """In text order: whether each wanted suffix shares its first ``most`` bytes with the one before it in ``order``.

    Compared are eight bytes at a time, the last ones first, as neighbours mostly differ there. ``wanted`` suffixes are
    at least ``most`` (8 or more) bytes long.
    """
    before = np.full(len(order), -1, np.int64)
    before[order[1:]] = order[:-1]
    words = words_at(data)
    live = np.flatnonzero(wanted & (before >= 0))
    for offset in sorted({most - 8, *range(0, most - 7, 8)}, reverse=True):
        a, b = live + offset, before[live] + offset
        inside = b < len(words)
        live = live[inside]
        live = live[words[a[inside]] == words[b[inside]]]
    shared = np.zeros(len(order), bool)
    shared[live] = True
    return shared
