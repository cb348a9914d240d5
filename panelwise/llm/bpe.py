"""BPE encoding and decoding with a transducer lexicon.

The most frequent words of the corpus are encoded once, on the driver, and compiled into a minimal acyclic
automaton: words share prefixes and suffixes, and the path of a word adds up to its number, which indexes its ids.
Automaton, ids and merge table go into one file below the shared folder, which every executor fetches once and
maps into memory. Tasks split texts into words, walk the automaton for all distinct words of a batch at once, and
merge the words it does not hold exactly: the leftmost pair of the lowest rank, one merge per word and round, for
thousands of words at a time. The lexicon only saves time: results do not depend on it.

Defined results: a null text is empty; an empty text has no ids and decodes to the empty string; repeated rows are
repeated; other columns are ignored; words of any length are merged exactly (very long ones with a heap). Characters count as letters and lower-case as in
the Unicode version of this Python: those that later versions add can split differently in other libraries.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import pieces, spread
from panelwise.llm.common import in_arrow, put, settled

#: Words compiled into the automaton.
LEXICON_WORDS = 1 << 16
#: Distinct chunks a task remembers before it starts anew.
REMEMBERED = 400_000
#: Words of more bytes are merged one by one.
LONG_WORD = 128
NO_RANK = np.int32(2**31 - 1)

#: Characters that str.split() takes for white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [c for _, c in sorted([(b, chr(b)) for b in shown] + [(b, chr(256 + i)) for i, b in enumerate(rest)])]


class Rules:
    """What a tokenizer file of the kind "BPE with word ends" says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-case BPE vocabulary with word ends")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + end] for s in symbols], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        names = {i: t for t, i in [*vocab.items(), *self.specials.items()]}
        shown = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.names = np.frombuffer(b"".join(shown), np.uint8)
        self.names_at = np.concatenate([[0], np.cumsum([len(s) for s in shown])]).astype(np.int64)


def automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted distinct words, as arrays.

    ``arcs`` are sorted keys ``state << 8 | byte`` with ``goto`` and ``add``; the sum of ``add`` along a word is
    its place in ``words``; ``final`` marks states where words end.
    """
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(done)
            done.append(key)
        return register[key]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1][-1] = (path[-1][1][-1][0], freeze(node))

    before = b""
    for word in words:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        close(same)
        for byte in word[same:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    root = freeze(path[0])
    held = np.zeros(len(done), np.int64)
    arcs, goto, add = [], [], []
    for state, (final, out) in enumerate(done):  # a state's targets are numbered before it
        total = int(final)
        for byte, to in out:
            arcs.append(state << 8 | byte)
            goto.append(to)
            add.append(total)
            total += int(held[to])
        held[state] = total
    final = np.array([f for f, _ in done], np.int32)
    return {
        "arcs": np.array(arcs, np.int64), "goto": np.array(goto, np.int32), "add": np.array(add, np.int32),
        "final": final, "root": np.array([root], np.int32),
    }


def numbers(lexicon: dict[str, np.ndarray], data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of each word ``data[at[i]:at[i + 1]]`` in the automaton, -1 if it is not there."""
    arcs, goto, add = lexicon["arcs"], lexicon["goto"], lexicon["add"]
    out = np.full(len(at) - 1, -1, np.int64)
    if not len(arcs) or not len(out):
        return out
    live = np.arange(len(out))
    state = np.full(len(out), lexicon["root"][0], np.int64)
    total = np.zeros(len(out), np.int64)
    length = np.diff(at)
    depth = 0
    while len(live):
        ended = length[live] == depth
        here = live[ended]
        good = lexicon["final"][state[ended]] == 1
        out[here[good]] = total[ended][good]
        live, state, total = live[~ended], state[~ended], total[~ended]
        key = state << 8 | data[at[live] + depth]
        found = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
        known = arcs[found] == key
        live, found = live[known], found[known]
        state, total = goto[found].astype(np.int64), total[known] + add[found]
        depth += 1
    return out


class Merger:
    """Exact merging of words that are in no lexicon."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.keys, self.ranks, self.made, self.first, self.last = keys, ranks, made, first, last

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.made[at]

    def merge(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and where each begins."""
        lengths = np.diff(at)
        out: list = [None] * len(lengths)
        counts = np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        cut = int(np.searchsorted(lengths[order], LONG_WORD, side="right"))
        for begin in range(0, cut, 8192):
            group = order[begin : min(begin + 8192, cut)]
            ids, n = self._together(data, at[group], lengths[group])
            counts[group] = n
            for i, row, k in zip(group.tolist(), ids, n.tolist()):
                out[i] = row[:k]
        for i in order[cut:].tolist():
            out[i] = self._alone(data[at[i] : at[i + 1]])
            counts[i] = len(out[i])
        filled = [x for x in out if x is not None]
        flat = np.concatenate(filled) if filled else np.zeros(0, np.int32)
        return flat.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _together(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, wide = len(begin), int(length.max())
        cols = np.arange(wide)
        inside = cols < length[:, None]
        ids = np.where(inside, self.first[data[np.minimum(begin[:, None] + cols, len(data) - 1)]], -1).astype(np.int32)
        ids[np.arange(n), length - 1] = self.last[data[begin + length - 1]]
        result, count = ids.copy(), length.copy()
        if wide == 1:
            return result, count
        rank, made = self.look(ids[:, :-1], ids[:, 1:])
        rank = np.where(inside[:, 1:], rank, NO_RANK)
        live, left = np.arange(n), length.copy()
        while True:
            spot = rank.argmin(axis=1)
            rows = np.arange(len(live))
            more = rank[rows, spot] != NO_RANK
            if not more.all():
                stop = ~more
                result[live[stop]], count[live[stop]] = ids[stop], left[stop]
                live, ids, rank, made, left, spot = live[more], ids[more], rank[more], made[more], left[more], spot[more]
                rows = np.arange(len(live))
            if not len(live):
                return result, count
            new = made[rows, spot]
            shift = cols + (cols > spot[:, None])
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=-1), shift, axis=1)
            ids[rows, spot] = new
            pair = cols[:-1] + (cols[:-1] > spot[:, None])
            rank = np.take_along_axis(np.pad(rank, ((0, 0), (0, 1)), constant_values=NO_RANK), pair, axis=1)
            made = np.take_along_axis(np.pad(made, ((0, 0), (0, 1))), pair, axis=1)
            left = left - 1
            for side in (spot - 1, spot):
                fits = (side >= 0) & (side + 1 < left)
                r, s = rows[fits], side[fits]
                rank[r, s], made[r, s] = self.look(ids[r, s], ids[r, s + 1])
            ends = (spot + 1 >= left) & (spot < wide - 1)
            rank[rows[ends], spot[ends]] = NO_RANK

    def _alone(self, word: np.ndarray) -> np.ndarray:
        ids = self.first[word].tolist()
        ids[-1] = int(self.last[word[-1]])
        after, ahead = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank, made = self.look(np.array(ids[:-1]), np.array(ids[1:]))
        queue = [(r, i, ids[i], ids[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), made.tolist())) if r != NO_RANK]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, m = heapq.heappop(queue)
            j = after[i] if ids[i] == a else len(ids)
            if j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[i] < len(ids):
                ahead[after[i]] = i
            for s in (ahead[i], i):
                e = after[s] if s >= 0 else len(ids)
                if e < len(ids):
                    r, m2 = self.look(np.array([ids[s]]), np.array([ids[e]]))
                    if r[0] != NO_RANK:
                        heapq.heappush(queue, (int(r[0]), s, ids[s], ids[e], int(m2[0])))
        return np.array([x for x in ids if x >= 0], np.int32)


class Chunks(dict):
    """Numbers for distinct chunks, given as they are asked for."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.fresh.append(chunk)
        self[chunk] = number = len(self)
        return number


class Splitter:
    """Normalised white-space chunks of texts, and words of chunks."""

    def __init__(self, pattern: str, specials: dict[str, int]):
        self.words = regex.compile(pattern).findall
        self.specials = {s: f" {i}" for s, i in specials.items()}  # no chunk holds a space
        self.cut = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def chunks(self, text: str) -> list[str]:
        if self.cut and "<|" in text and len(parts := self.cut.split(text)) > 1:
            return [c for p in parts for c in ([self.specials[p]] if p in self.specials else self.plain(p))]
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
        else:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").lower()  # no final sigma: characters are lowered one by one
        return self.words(text) if ODD_SPACE.search(text) else text.split()


class Codec:
    """Encodes and decodes batches of texts with the arrays of one lexicon file."""

    def __init__(self, arrays: dict[str, np.ndarray], pattern: str, specials: dict[str, int]):
        self.a = arrays
        self.split = Splitter(pattern, specials)
        self.merger = Merger(*(arrays[k] for k in ("keys", "ranks", "made", "first", "last")))
        self._anew()

    def _anew(self) -> None:
        self.known = Chunks()
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin."""
        if len(self.known) > REMEMBERED:
            self._anew()
        codes: list[int] = []
        upto = [0]
        for text in texts:
            codes.extend(map(self.known.__getitem__, self.split.chunks(text)))
            upto.append(len(codes))
        if self.known.fresh:
            flat, at = self._chunks(self.known.fresh)
            self.at = np.concatenate([self.at, at[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, flat])
            self.known.fresh = []
        codes_at = np.array(codes, np.int64)
        counts = np.diff(self.at)[codes_at] if len(codes_at) else codes_at
        ids = self.flat[spread(self.at[codes_at], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[upto]

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, codes, upto = Chunks(), [], [0]
        for c in chunks:
            codes.extend(map(words.__getitem__, [c] if c[0] == " " else self.split.words(c)))
            upto.append(len(codes))
        flat, at = self._words(words.fresh)
        codes_at = np.array(codes, np.int64)
        counts = np.diff(at)[codes_at] if len(codes_at) else codes_at
        return flat[spread(at[codes_at], counts)], np.concatenate([[0], np.cumsum(counts)])[upto]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [b"" if w[0] == " " else w.encode() for w in words]
        at = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        number = numbers(self.a, data, at)
        number[[i for i, w in enumerate(words) if w[0] == " "]] = -2
        unseen = np.flatnonzero(number == -1)
        lengths = np.diff(at)[unseen]
        merged, merged_at = self.merger.merge(data[spread(at[unseen], lengths)], np.concatenate([[0], np.cumsum(lengths)]))
        special = np.array([int(w) for w in words if w[0] == " "], np.int32)
        pool = np.concatenate([self.a["ids"], merged, special])
        begin, count = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        seen = np.flatnonzero(number >= 0)
        begin[seen], count[seen] = self.a["ids_at"][number[seen]], np.diff(self.a["ids_at"])[number[seen]]
        begin[unseen], count[unseen] = len(self.a["ids"]) + merged_at[:-1], np.diff(merged_at)
        begin[number == -2] = len(self.a["ids"]) + len(merged) + np.arange(len(special))
        return pool[spread(begin, count)], np.concatenate([[0], np.cumsum(count)])

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids: the tokens, one space between them."""
        begin = self.a["names_at"][ids]
        length = self.a["names_at"][ids + 1] - begin
        data = self.a["names"][spread(begin, length)].tobytes()
        ends = np.concatenate([[0], np.cumsum(length)])[at]
        return [data[b : max(b, e - 1)] for b, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def pack(arrays: dict[str, np.ndarray], **facts) -> bytes:
    """One file: a length, a JSON header, and the arrays at 16-byte steps."""
    places, body, at = {}, [], 0
    for name, x in arrays.items():
        raw = np.ascontiguousarray(x).tobytes()
        raw += bytes(-len(raw) % 16)
        places[name] = (at, len(x), x.dtype.str)
        body.append(raw)
        at += len(raw)
    head = json.dumps({"places": places, **facts}).encode()
    head += b" " * (-(len(head) + 8) % 16)
    return len(head).to_bytes(8, "little") + head + b"".join(body)


_OPENED: dict[str, Codec] = {}


def opened(name: str) -> Codec:
    """The codec of a lexicon file that the executors have fetched, mapped into memory once per process."""
    if name not in _OPENED:
        with open(SparkFiles.get(name), "rb") as f:
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(view[:8], "little")
        head = json.loads(view[8 : 8 + size])
        arrays = {n: np.frombuffer(view, np.dtype(kind), count, 8 + size + at) for n, (at, count, kind) in head["places"].items()}
        _OPENED[name] = Codec(arrays, head["pattern"], head["specials"])
    return _OPENED[name]


def word_counts(docs: DataFrame, pattern: str, specials: dict[str, int], text_col: str = "text") -> DataFrame:
    """``word, n``: how often each word of the tokenizer occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen, tally = Splitter(pattern, specials), Chunks(), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            total: dict[str, int] = {}
            for chunk, n in zip(seen, tally.tolist()):
                for w in split.words(chunk) if chunk[0] != " " else ():
                    total[w] = total.get(w, 0) + n
            return pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

        for piece in pieces(batches):
            codes: list[int] = []
            for text in piece.column("text").to_pylist():
                codes.extend(map(seen.__getitem__, split.chunks(text or "")))
            here = np.bincount(codes, minlength=len(seen)) if codes else np.zeros(len(seen), np.int64)
            here[: len(tally)] += tally
            tally = here
            if len(seen) > REMEMBERED:
                yield flush()
                seen, tally = Chunks(), np.zeros(0, np.int64)
        yield flush()

    counted = in_arrow(docs.select(F.col(text_col).alias("text")), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, words: int) -> DataFrame:
    """At most ``words`` of the most frequent words, cut at a step of a fine logarithmic scale of frequencies.

    A cut by frequency leaves the choice to each task; a global top-k would send that many words from every task.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    scale = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, total = 0, 0
    for row in sorted(scale, key=lambda r: -r["step"]):
        total += row["words"]
        if total > words:
            least = row["step"] + 1
            break
    return counts.filter(step >= least).select("word")


def compiled(docs: DataFrame, path: str, words: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Compile the most frequent words of ``docs`` and hand the lexicon file to the executors; its name."""
    spark = docs.sparkSession
    rules = Rules(path)
    counts = settled(word_counts(docs, rules.pattern, rules.specials, text_col), "word-counts")
    chosen = sorted(r["word"].encode() for r in most_frequent(counts, words).collect())
    merger = Merger(rules.keys, rules.ranks, rules.made, rules.first, rules.last)
    at = np.concatenate([[0], np.cumsum([len(w) for w in chosen])]).astype(np.int64)
    ids, ids_at = merger.merge(np.frombuffer(b"".join(chosen), np.uint8), at)
    parts = ("keys", "ranks", "made", "first", "last", "names", "names_at")
    arrays = {**automaton(chosen), "ids": ids, "ids_at": ids_at, **{k: getattr(rules, k) for k in parts}}
    blob = pack(arrays, pattern=rules.pattern, specials=rules.specials)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(put(spark, name, blob))
    return name


def encoded(docs: DataFrame, lexicon: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids, at = opened(lexicon).encode([t or "" for t in piece.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), encode, f"doc_id {kind}, ids array<int>")


def decoded(df: DataFrame, lexicon: str, ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of ``doc_id`` and ids; null ids give a null text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x if x is not None else [] for x in batch.column("ids").to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            texts = opened(lexicon).decode(np.array([i for x in lists for i in x], np.int64), at)
            there = batch.column("ids").is_valid().to_pylist()
            column = pa.array([t.decode() if ok else None for t, ok in zip(texts, there)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "text"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return in_arrow(df.select("doc_id", F.col(ids_col).alias("ids")), decode, f"doc_id {kind}, text string")


def digest(docs: DataFrame, path: str, words: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, encoded and decoded in one pass, and ``ids`` if kept."""
    lexicon = compiled(docs, path, words)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            codec = opened(lexicon)
            ids, at = codec.encode([t or "" for t in piece.column("text").to_pylist()])
            raw = ids.astype("<u4")
            parts = [hashlib.sha256(raw[b:e].tobytes()).hexdigest() for b, e in zip(at[:-1].tolist(), at[1:].tolist())]
            texts = [hashlib.sha256(t).hexdigest() for t in codec.decode(ids, at)]
            columns = [piece.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(parts, pa.string()), pa.array(texts, pa.string())]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return in_arrow(docs.select("doc_id", "text"), digests, schema)
