"""Token counts that follow edits: segment trees over pre-tokens, re-encoding only what an edit touches.

A document's text is cut into pre-tokens (the pieces a byte-level BPE never merges across); every ``LEAF`` of them make a
leaf with its characters and its tokens, and a binary tree over the leaves holds sums. An edit replaces a range of
characters. Where a piece begins depends on the text to its right only, so cutting starts anew two pieces before the
edit, far enough for white space that reaches back, and stops at the first old boundary behind it that is met again:
only leaves between are encoded, all other sums are kept. Replacing leaves by as many updates their paths to the root;
a different number rebuilds the levels above from the leaves' sums, without text.

The tokenizer is a vocabulary file of ranks and its pattern, both parameters; special tokens are ordinary text.

Defined results: a null text is empty and has 0 tokens; positions beyond the end are the end, negative ones the
beginning; a null insertion is empty; a null position or length is 0; repeated rows are counted alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import pieces
from panelwise.llm.common import in_arrow, text_of

#: Pre-tokens of a leaf.
LEAF = 64
#: Distinct pre-tokens a task remembers before it starts anew.
REMEMBERED = 400_000


class Counter:
    """Encodes pieces of text and cuts texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern).finditer
        self.known: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        """The number of tokens of one pre-token."""
        n = self.known.get(piece)
        if n is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            n = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class Tree:
    """Leaves of pre-tokens with their characters and tokens, and sums over ranges of leaves."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text, self.encoded = counter, text, 0
        self.leaves = self._leaves(0, None)
        self._sums()

    def _leaves(self, begin: int, stop: list[int] | None) -> list[tuple[list[int], int]]:
        """Leaves from ``begin`` on, each as its pieces' lengths and its tokens; ends at a boundary in ``stop``."""
        out, lengths, at, known = [], [], begin, set(stop or ())
        for found in self.counter.cut(self.text, begin):
            if at in known and at > begin:
                break
            lengths.append(found.end() - at)
            at = found.end()
            if len(lengths) == LEAF:
                out.append(self._leaf(lengths, at))
                lengths = []
        if lengths:
            out.append(self._leaf(lengths, at))
        return out

    def _leaf(self, lengths: list[int], end: int) -> tuple[list[int], int]:
        size = sum(lengths)
        self.encoded += size
        at, total = end - size, 0
        for n in lengths:
            total += self.counter.tokens(self.text[at : at + n])
            at += n
        return lengths, total

    def _sums(self) -> None:
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        pad = [0] * (self.size - len(self.leaves))
        self.chars = [0] * self.size + [sum(x) for x, _ in self.leaves] + pad
        self.tokens = [0] * self.size + [n for _, n in self.leaves] + pad
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1] if len(self.tokens) > 1 else 0

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character and where the leaf begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if place >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def edit(self, place: int, length: int, text: str) -> None:
        """Replace ``length`` characters from ``place`` by ``text``."""
        place = min(max(0, place), len(self.text))
        length = min(max(0, length), len(self.text) - place)
        if not self.leaves:
            self.text = text
            self.leaves = self._leaves(0, None)
            return self._sums()
        first, begin = self._find(max(0, place - 1))
        starts = _starts(begin, self.leaves[first][0])
        piece = bisect_right(starts, max(0, place - 1)) - 1
        while piece < 2 and first > 0:
            first -= 1
            begin -= sum(self.leaves[first][0])
            starts = _starts(begin, self.leaves[first][0]) + starts
            piece += len(self.leaves[first][0])
        head = starts[max(0, piece - 2)]
        kept = max(0, piece - 2)
        shift = len(text) - length
        last, behind = self._find(min(place + length, len(self.text) - 1))
        self.text = self.text[:place] + text + self.text[place + length :]
        while True:  # old boundaries behind the edit, one leaf further at a time
            old = [s + shift for s in _starts(behind, self.leaves[last][0]) if s >= place + length]
            fresh, met = self._recut(head, old, place + len(text), last + 1 == len(self.leaves))
            if met is not None or last + 1 == len(self.leaves):
                break
            behind += sum(self.leaves[last][0])
            last += 1
        rest: list[int] = []
        if met is not None:
            where = met - shift - behind
            at = 0
            for k, n in enumerate(self.leaves[last][0]):
                if at == where:
                    rest = self.leaves[last][0][k:]
                    break
                at += n
        before = [b - a for a, b in zip(starts[:kept], [*starts[1:kept], head])]
        start = head - sum(before)
        new = self._packed(start, [*before, *fresh, *rest])
        same = len(new) == last + 1 - first
        self.leaves[first : last + 1] = new
        if same:
            for k in range(first, last + 1):
                self._update(k)
        else:
            self._sums()

    def _recut(self, head: int, old: list[int], clear: int, final: bool) -> tuple[list[int], int | None]:
        """Lengths of pieces from ``head`` to the first old boundary at or behind ``clear``, and that boundary.

        Without one, it gives up behind the last old boundary, or goes on to the end if ``final``.
        """
        known, lengths, at = set(old), [], head
        for found in self.counter.cut(self.text, head):
            if at >= clear and at in known and at > head:
                return lengths, at
            if not final and at > max(clear, old[-1] if old else 0):
                return lengths, None
            lengths.append(found.end() - at)
            at = found.end()
        return lengths, None

    def _packed(self, start: int, lengths: list[int]) -> list[tuple[list[int], int]]:
        out, at = [], start
        for k in range(0, len(lengths), LEAF):
            part = lengths[k : k + LEAF]
            at += sum(part)
            out.append(self._leaf(part, at))
        return out

    def _update(self, leaf: int) -> None:
        node = leaf + self.size
        self.chars[node], self.tokens[node] = sum(self.leaves[leaf][0]), self.leaves[leaf][1]
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


def _starts(begin: int, lengths: list[int]) -> list[int]:
    out = []
    for n in lengths:
        out.append(begin)
        begin += n
    return out


_COUNTERS: dict[tuple[int, str], Counter] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def counted(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, edited_tokens, encoded_chars, edited_chars``.

    ``rows`` has ``doc_id, text, edits``, an array of ``place, length, text`` that apply one after another. ``encoded_chars``
    are the characters that the edits made it encode again, ``edited_chars`` those of the text after them.
    """
    sent = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (id(sent), pattern)
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, Counter(sent.value, pattern))
        for piece in pieces(batches):
            out = []
            for text, edits in zip(piece.column("text").to_pylist(), piece.column("edits").to_pylist()):
                tree = Tree(counter, text or "")
                before, tree.encoded = tree.total, 0
                for e in edits or ():
                    tree.edit(e["place"] or 0, e["length"] or 0, e["text"] or "")
                out.append((before, tree.total, tree.encoded, len(tree.text)))
            columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], ["doc_id", "n_tokens", "edited_tokens", "encoded_chars", "edited_chars"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows.select("doc_id", "text", "edits"), work, f"doc_id {kind}, n_tokens long, edited_tokens long, encoded_chars long, edited_chars long")


def edited(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edits``: three edits of each document, derived from it: a cut, a replacement and an insertion."""
    n = F.char_length(text_of()).cast("long")
    place = [F.pmod(F.xxhash64(F.col("doc_id"), F.lit(k)), F.greatest(n, F.lit(1))) for k in range(3)]

    def one(at, length: int, text):
        return F.struct(at.alias("place"), F.lit(length).cast("long").alias("length"), text.alias("text"))

    edits = F.array(one(place[0], 40, F.lit("")), one(place[1], 25, F.substring(text_of(), 1, 30)), one(place[2], 0, F.lit("\n  an added line\n")))
    return docs.select("doc_id", "text", edits.alias("edits"))
