"""Personal data in texts: patterns, and a skip-chain conditional random field that adds what patterns miss.

Patterns find e-mail addresses, IP addresses, card and phone numbers; their spans always stay. The field decides about
the other words that hold a digit or an at sign (all other words are outside by definition): a phone number without its
plus sign, a card number that a neighbouring number spoils for the pattern, an address without its last part.

* Nodes are such words, with five labels (outside, and the four kinds). Words inside a pattern's span are observed.
* Chain potentials join neighbours with nothing but blanks between them.
* Skip potentials join a word to the next word of the document, however far, that repeats it or resembles it (the
  same last seven digits, or the same name before an at sign). Links run from mention to mention, so a word that stands
  a thousand times has a thousand links.
* Sum-product messages pass ``ROUNDS`` times over both, for all documents of a piece of a batch at once. A word takes
  a label that its belief gives at least ``SURE``, and a span must be well formed for its kind.

Weights are learned by pseudo-likelihood from about ``SAMPLE`` documents (a bound on the rows that weights are fitted to;
drawn by a hash of id and text), in which the patterns' spans are the labels. Each of them is seen a second time with
its mentions made harder (``weakened``), so that neighbours, shapes and other mentions have to explain them. Spark
counts the distinct situations; the driver fits to their counts.

Defined results: a null text is empty and has no spans; rows without id are kept as rows; repeated rows give equal
rows; columns other than id and text are ignored; an empty table gives no rows. Every pattern takes time in proportion
to the text, whatever it holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import pieces
from panelwise.llm.common import in_arrow, text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0 is outside
#: Documents that the weights are fitted to, about.
SAMPLE = 20_000
ROUNDS = 12
SURE = 0.9
#: Weight of the penalty on squared weights, and steps of the fit.
PENALTY, STEPS = 0.01, 400

NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SPACE = frozenset(" \t\n\v\f\r")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BARE_PHONE = re.compile(r"[+(]?[0-9][\x20().0-9-]+[0-9]")
CUE = re.compile("[0-9@]")
END = re.compile(r"[\x20\x09-\x0D]")
OTHER = re.compile("[^0-9]+")
PLAIN = re.compile("[^a-z0-9]+")


def digits(text: str) -> str:
    return OTHER.sub("", text)


def luhn(number: str) -> bool:
    values = [int(c) for c in reversed(number)]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def is_card(text: str) -> bool:
    number = digits(text)
    return 13 <= len(number) <= 19 and luhn(number)


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)


def is_phone(text: str) -> bool:
    return 9 <= len(digits(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the name that ends at it; a name reaches back to the last address at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in NAME:
            begin -= 1
        host = HOST.match(text, at + 1) if begin < at else None
        if host:
            yield begin, host.end()
            done = host.end()
        else:
            done = at + 1  # no name can reach over an at sign
        at = text.find("@", done)


def patterns(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of every pattern's spans, by kind, then start."""
    found = [(0, b, e) for b, e in emails(text)] if "@" in text else []
    for kind, pattern, holds in ((1, IP, is_ip), (2, CARD, is_card), (3, PHONE, is_phone)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m.group())]
    return found


@dataclass
class Words:
    """The words of one text that hold a digit or an at sign."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    codes: list[tuple[int, ...]] = field(default_factory=list)  # features that hold
    labels: list[int] = field(default_factory=list)  # 0 also where nothing is observed
    chain: list[tuple[int, int]] = field(default_factory=list)
    skips: list[tuple[int, int, int]] = field(default_factory=list)  # class, word, later word


#: Names of the features of a word; a feature holds or not.
SIZES = (1, 3, 4, 5, 7, 8, 10, 13, 20)  # numbers of digits where a new class begins
FEATURES = (
    *(f"digits{i}" for i in range(len(SIZES) + 1)), "letters", "at", "at_host", "four_parts", "luhn", "plus", "bracket",
    "hyphen", "assigned", "left_few", "left_many", "right_few", "right_many", "island_phone", "island_long",
)
FEATURE = {n: i for i, n in enumerate(FEATURES)}
WHOLE = frozenset(FEATURE[n] for n in ("at_host", "four_parts", "luhn"))
REPEATED, SHORT, SIMILAR = range(3)


def _trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    b, e = begin, end
    while b < e and not (text[b].isalnum() or text[b] in "+("):
        b += 1
    while e > b and not (text[e - 1].isalnum() or text[e - 1] == ")"):
        e -= 1
    return (b, e) if b < e else (begin, end)


def words_of(text: str, known: list[tuple[int, int, int]]) -> Words:
    """The words, their features and links; a word inside a known span has its label."""
    out, at, last = Words(), 0, 0
    whole: list[tuple[int, int]] = []
    while cue := CUE.search(text, at):
        begin = cue.start()
        while begin > last and text[begin - 1] not in SPACE:
            begin -= 1
        stop = END.search(text, cue.end())
        last = at = stop.start() if stop else len(text)
        whole.append((begin, at))
        out.spans.append(_trimmed(text, begin, at))
    if not whole:
        return out
    out.labels = [0] * len(whole)
    begins = np.array([b for b, _ in whole])
    for kind, b, e in known:
        i = max(0, int(np.searchsorted(begins, b, side="right")) - 1)
        while i < len(whole) and whole[i][0] < e:
            if whole[i][1] > b and not out.labels[i]:
                out.labels[i] = 1 + kind
            i += 1
    cores = [text[b:e] for b, e in out.spans]
    numbers = [digits(c) for c in cores]
    joined = [
        i > 0 and whole[i][0] - whole[i - 1][1] <= 2 and "\n" not in text[whole[i - 1][1] : whole[i][0]] for i in range(len(whole))
    ]
    island, total = [], []
    for i, n in enumerate(numbers):
        if not joined[i]:
            total.append(0)
        total[-1] += len(n)
        island.append(len(total) - 1)
    seen: dict[tuple, int] = {}
    for i, core in enumerate(cores):
        out.codes.append(_features(text, whole[i], core, numbers, joined, i, total[island[i]]))
        if joined[i]:
            out.chain.append((i - 1, i))
        plain = PLAIN.sub("", core.lower())
        keys = [(REPEATED if len(plain) >= 5 else SHORT, plain)]
        if len(numbers[i]) >= 7 and numbers[i] == plain:
            keys.append((SIMILAR, numbers[i][-7:]))
        if "@" in core[1:]:
            keys.append((SIMILAR, core[: core.index("@", 1)].lower() + "@"))
        for key in keys:
            before = seen.get(key)
            if before is not None and not (key[0] == SIMILAR and cores[before] == core):
                out.skips.append((key[0], before, i))
            seen[key] = i
    return out


def _features(text: str, whole: tuple[int, int], core: str, numbers: list[str], joined: list[bool], i: int, island: int) -> tuple[int, ...]:
    number = numbers[i]
    name, sign, host = core.partition("@")
    holds = [] if name and host else [f"digits{sum(len(number) >= s for s in SIZES)}"]
    word = text[whole[0] : whole[1]]
    before = text[max(0, whole[0] - 3) : whole[0]].rstrip()
    left = len(numbers[i - 1]) if joined[i] else 0
    right = len(numbers[i + 1]) if i + 1 < len(numbers) and joined[i + 1] else 0
    for feature, true in (
        ("letters", any(c.isalpha() for c in name)), ("at", sign and name and host), ("at_host", sign and name and "." in host.strip(".")),
        ("four_parts", IP.fullmatch(core) and is_ip(core)), ("luhn", CARD.fullmatch(core) and is_card(core)), ("plus", core[0] == "+"), ("bracket", core[0] == "("),
        ("hyphen", "-" in core), ("assigned", "=" in word or before[-1:] in ("=", ":")),
        ("left_few", 0 < left < 4), ("left_many", left >= 4), ("right_few", 0 < right < 4), ("right_many", right >= 4),
        ("island_phone", 9 <= island <= 15), ("island_long", island > 15),
    ):
        if true:
            holds.append(feature)
    return tuple(FEATURE[h] for h in holds)


def weakened(text: str, known: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its mentions made harder, and where the spans then are.

    Every other phone number loses its plus sign, cards get a number behind them. At the end phone numbers and
    addresses stand once more, as bare digits and without the end of the host, each beside a decoy: its mirror image,
    which is no personal data. Only the link to the first mention tells the two apart.
    """
    parts, spans, echoes, at, turn, length = [], [], [], 0, 0, 0

    def put(piece: str, kind: int | None = None) -> None:
        nonlocal length
        if kind is not None:
            spans.append((kind, length, length + len(piece)))
        parts.append(piece)
        length += len(piece)

    for kind, b, e in sorted(known, key=lambda s: (s[1], s[2])):
        if b < at:
            continue
        mention, name = text[b:e], KINDS[kind]
        put(text[at:b])
        turn += 1
        put(mention[1:] if name == "phone" and turn % 2 else mention, kind)
        if name == "card":
            put(" 27")
        elif name == "phone":
            number = digits(mention)[-10:]
            echoes += [(number, kind), (number[::-1], None)]
        elif name == "email":
            user, host = mention.split("@")
            host = host.split(".")[0]
            echoes += [(f"{user}@{host}", kind), (f"{user[::-1]}@{host[::-1]}", None)]
        at = e
    put(text[at:])
    for echo, kind in echoes:
        put(" ; ")
        put(echo, kind)
    return "".join(parts), spans


def situations(words: Words) -> Iterator[tuple[str, int]]:
    """For each word, its features and its neighbours' labels as text, and its label.

    A word outside all spans that is well formed by itself may be spoilt by its neighbours: its label is unknown.
    """
    n = len(words.spans)
    left, right = [0] * n, [0] * n  # 0: none, 1 + label
    near: list[list[str]] = [[] for _ in range(n)]
    for a, b in words.chain:
        left[b], right[a] = 1 + words.labels[a], 1 + words.labels[b]
    for kind, a, b in words.skips:
        near[a].append(f"{kind}.{words.labels[b]}")
        near[b].append(f"{kind}.{words.labels[a]}")
    for i in range(n):
        if not words.labels[i] and not WHOLE.isdisjoint(words.codes[i]):
            continue
        yield f"{' '.join(map(str, words.codes[i]))}|{left[i]}|{right[i]}|{' '.join(sorted(near[i]))}", words.labels[i]


@dataclass
class Field:
    """Weights: features by label, left by right label, and agreement by class of link and label."""

    unary: np.ndarray = field(default_factory=lambda: np.zeros((len(FEATURES), LABELS)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    skip: np.ndarray = field(default_factory=lambda: np.zeros((3, LABELS)))

    def potentials(self, codes: list[tuple[int, ...]], labels: np.ndarray) -> np.ndarray:
        """Scores of the labels of each word; an observed word has no choice."""
        size = np.array([len(c) for c in codes])
        flat = np.concatenate([np.array(c) for c in codes])
        scores = np.add.reduceat(self.unary[flat], np.r_[0, np.cumsum(size)[:-1]])
        seen = labels > 0
        scores[seen] = -1e6
        scores[seen, labels[seen]] = 0.0
        return scores

    def beliefs(self, scores: np.ndarray, left: np.ndarray, right: np.ndarray, kinds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Marginals by loopy sum-product; ``kinds`` is -1 for a chain link, else the class of a skip link."""
        tables = np.concatenate([[np.diag(s) for s in self.skip], [self.chain]])[kinds]
        source, target = np.r_[left, right], np.r_[right, left]
        back = np.r_[np.arange(len(left)) + len(left), np.arange(len(left))]
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        sent = np.zeros((len(source), LABELS))
        for _ in range(rounds if len(source) else 0):
            cavity = _gathered(scores, target, sent)[source] - sent[back]
            paths = cavity[:, :, None] + tables
            top = paths.max(axis=1, keepdims=True)
            sent = np.log(np.exp(paths - top).sum(axis=1)) + top[:, 0]
            sent -= sent.max(axis=1, keepdims=True)
        total = _gathered(scores, target, sent)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)


def _gathered(scores: np.ndarray, target: np.ndarray, sent: np.ndarray) -> np.ndarray:
    return scores + np.stack([np.bincount(target, sent[:, k], len(scores)) for k in range(LABELS)], axis=1)


def fit(counts: list[tuple[str, int, int]]) -> Field:
    """Penalised pseudo-likelihood: each situation's label given its features and its neighbours' labels."""
    out = Field()
    if not counts:
        return out
    counts = sorted(counts)
    n = len(counts)
    x = np.zeros((n, len(FEATURES)))
    before, after, near = np.zeros((n, LABELS)), np.zeros((n, LABELS)), np.zeros((n, 3, LABELS))
    for i, (situation, _, _) in enumerate(counts):
        codes, left, right, links = situation.split("|")
        x[i, [int(c) for c in codes.split()]] = 1
        for column, label in ((before, int(left)), (after, int(right))):
            if label:
                column[i, label - 1] = 1
        for link in links.split():
            kind, label = link.split(".")
            near[i, int(kind), int(label)] += 1
    truth = np.eye(LABELS)[[label for _, label, _ in counts]]
    weight = np.array([c for _, _, c in counts], float)[:, None]
    values = [out.unary, out.chain, out.skip]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        scores = x @ out.unary + before @ out.chain + after @ out.chain.T + (near * out.skip).sum(axis=1)
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        wrong = weight * (truth - p / p.sum(axis=1, keepdims=True))
        slopes = [x.T @ wrong, before.T @ wrong + wrong.T @ after, (near * wrong[:, None]).sum(axis=0)]
        for v, g, m, s in zip(values, slopes, first, second):
            g = (g - PENALTY * v) / weight.sum()
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    return out


def fitted(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Weights from about ``sample`` documents of the table."""
    rows = docs.select("doc_id", text_of().alias("_text"))
    total = rows.count()
    share = min(1.0, sample / total) if total else 0.0
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id", "_text"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            seen: Counter = Counter()
            for text in piece.column("_text").to_pylist():
                if not CUE.search(text):
                    continue
                known = patterns(text)
                seen.update(situations(words_of(text, known)))
                if known:
                    seen.update(situations(words_of(*weakened(text, known))))
            rows = list(seen.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for (s, _), _ in rows], pa.string()), pa.array([k for (_, k), _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())],
                ["situation", "label", "n"],
            )

    counted = in_arrow(drawn.select("_text"), task, "situation string, label int, n long")
    counts = counted.groupBy("situation", "label").agg(F.sum("n").alias("n"))
    return fit([tuple(r) for r in counts.collect()])


def _well_formed(kind: int, text: str) -> bool:
    if kind == 0:
        name, sign, host = text.partition("@")
        return bool(sign and name and host) and "@" not in host
    form, holds = ((IP, is_ip), (CARD, is_card), (BARE_PHONE, is_phone))[kind - 1]
    return bool(form.fullmatch(text)) and holds(text)


def added(text: str, words: Words, labels: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the hidden words' labels: neighbours of one kind together if that is well formed, else each alone."""
    out, i, follows = [], 0, {b for _, b in words.chain}
    while i < len(labels):
        j = i + 1
        if labels[i] > 0:
            while j < len(labels) and labels[j] == labels[i] and j in follows:
                j += 1
            kind = int(labels[i]) - 1
            b, e = words.spans[i][0], words.spans[j - 1][1]
            spans = [(b, e)] if _well_formed(kind, text[b:e]) else [s for s in words.spans[i:j] if _well_formed(kind, text[s[0] : s[1]])]
            out += [(kind, b, e) for b, e in spans]
        i = j
    return out


def spotted(texts: list[str], model: Field) -> list[list[tuple[int, int, int, bool]]]:
    """``(kind, start, end, by pattern)`` of every text, by kind, then start; one graph for all texts."""
    known = [patterns(t) if CUE.search(t) else [] for t in texts]
    every = [words_of(t, k) if CUE.search(t) else Words() for t, k in zip(texts, known)]
    open_ = [i for i, w in enumerate(every) if not all(w.labels)]
    extra: dict[int, list[tuple[int, int, int]]] = {}
    if open_:
        first = np.cumsum([0, *(len(every[i].spans) for i in open_)])
        links = [(a + f, b + f, -1) for i, f in zip(open_, first) for a, b in every[i].chain]
        links += [(a + f, b + f, k) for i, f in zip(open_, first) for k, a, b in every[i].skips]
        left, right, kinds = np.array(links, np.int64).reshape(-1, 3).T
        labels = np.concatenate([every[i].labels for i in open_]).astype(np.int64)
        scores = model.potentials([c for i in open_ for c in every[i].codes], labels)
        belief = model.beliefs(scores, left, right, kinds)
        chosen = np.where((belief.max(axis=1) >= SURE) & (labels == 0), belief.argmax(axis=1), 0)
        for i, f in zip(open_, first):
            extra[i] = added(texts[i], every[i], chosen[f : f + len(every[i].spans)])
    return [
        sorted([(*s, True) for s in base] + [(*s, False) for s in extra.get(i, ()) if not any(s[0] == k and s[1] < e and b < s[2] for k, b, e in base)])
        for i, base in enumerate(known)
    ]


def spans(docs: DataFrame, model: Field) -> DataFrame:
    """``doc_id, spans``: kind, start, end (code points) and whether a pattern found it."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            found = spotted(piece.column("_text").to_pylist(), sent.value)
            lists = [[{"kind": KINDS[k], "start": b, "end": e, "base": p} for k, b, e, p in x] for x in found]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lists, kind)], ["doc_id", "spans"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return in_arrow(docs.select("doc_id", text_of().alias("_text")), task, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: the patterns' spans by kind and as a digest, and all spans as text."""
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.base)"
    numbers = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return spans(docs, fitted(docs)).select(
        "doc_id", *numbers, F.sha2(F.expr(listed.format(base)), 256).alias("base_sha256"), F.expr(listed.format("spans")).alias("spans")
    )
