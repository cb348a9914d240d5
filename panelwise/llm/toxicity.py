"""Toxic passages as maximum-scoring segments of token log-odds.

Features of a word are the word and its first four, five and six letters, so that inflected forms share evidence. A
feature's log-odds compare its frequency in toxic and in other labelled documents, smoothed with a Dirichlet prior of
``PRIOR`` words spread like the frequencies of the whole corpus; its score is the lower end of their confidence
interval, and features below ``LEAST_SCORE`` score nothing. A feature that occurs ``t`` times in a document counts
``1 + floor(log2 t)`` times, so that one repetitive document says little. A word scores like its best feature, any
other word ``-GAP``. The linear-time scan of Ruzzo and Tompa gives all maximal scoring segments.

Local maxima of such a walk follow an extreme-value law: with ``lambda`` the root of ``E[exp(lambda * score)] = 1``
for ordinary text, ``exp(-lambda * S) * n`` is in proportion to the number of segments of score ``S`` to expect by
chance among ``n`` words. Segments with ``lambda * S - ln n >= SIGNIFICANT`` are reported; the logarithm of the sum
of ``exp(lambda * S) / n`` over all segments of a document is its evidence, which a logistic curve turns into a
probability. Texts without any segment have one score, the smoothed share of toxic ones among them.

Fitting: log-odds and curve use all labelled documents that are not held out; the prior uses all documents. Only the features of a bounded lexicon (``LEXICON``) travel to the executors.

Defined results: a null or empty text has no segment and scores like a text without toxic words; labels that are
null are not learned from, of several labels for a document the largest counts; without any toxic or any other
labelled document every score is 0.5; a null id is never held out; repeated rows are scored alike; other columns are
ignored; an empty table gives no rows. No label, language, source or id enters a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.batches import pieces
from panelwise.llm.common import in_arrow, sent, settled, shielded

#: So many labels are broadcast to the documents, more of them meet in a shuffle.
BROADCAST = 200_000
LEXICON = 50_000
PRIOR = 20_000.0
LEAST_SCORE = 1.0
CAUTION = 1.28
GAP = 0.05
SIGNIFICANT = 3.0
#: Evidence of a text without any scoring word, and the range of all other evidence.
NOTHING, LOW, HIGH = -12.0, -10.0, 60.0
REJECT = 0.7
#: Words and features that a task remembers.
WORDS_HELD, FEATURES_HELD = 100_000, 400_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def features(chunk: str) -> tuple[str, ...]:
    """The features of a lower-case white-space chunk: the word without surrounding signs, and its beginnings."""
    word = EDGES.sub("", chunk)
    if not word:
        return ()
    return (word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n))


def labelled(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labelled documents to learn from: all that are not held out."""
    kept = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out())
    return kept.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _counted(docs: DataFrame, wanted: set[str] | None) -> DataFrame:
    """``feature, toxic, other, held``: damped counts in documents with ``toxic`` 1 and 0, and toxic documents that hold it.

    The row of the empty feature holds the counts of all words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        place: dict[str, int] = {}
        counts: tuple[list[int], ...] = ([], [], [])  # other, toxic, held

        def placed(f: str) -> int:
            at = place.setdefault(f, len(place))
            if at == len(counts[0]):
                for column in counts:
                    column.append(0)
            return at

        def flush() -> pa.RecordBatch:
            columns = [pa.array(counts[k], pa.int64()) for k in (1, 0, 2)]
            return pa.RecordBatch.from_arrays([pa.array(place, pa.string()), *columns], ["feature", "toxic", "other", "held"])

        placed("")
        for piece in pieces(batches):
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                here: dict[int, int] = {}
                words = 0
                for chunk, n in Counter((text or "").lower().split()).items():
                    if (places := known.get(chunk)) is None:
                        places = known[chunk] = tuple(placed(f) for f in features(chunk) if wanted is None or f in wanted)
                    words += n.bit_length()
                    for f in places:
                        here[f] = here.get(f, 0) + n
                counted, held = counts[toxic], counts[2]
                for f, n in here.items():
                    counted[f] += n.bit_length()
                    held[f] += toxic
                counted[0] += words
                held[0] += toxic
            if len(place) > FEATURES_HELD:
                yield flush()
                place.clear()
                for column in counts:
                    column.clear()
                placed("")
                known.clear()
            elif len(known) > WORDS_HELD:
                known.clear()
        yield flush()

    counted = in_arrow(docs.select("text", "toxic"), count, "feature string, toxic long, other long, held long")
    return counted.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("toxic", "other", "held")))


def log_odds(y: float, z: float, toxic: float, other: float, share: float) -> tuple[float, float]:
    """Log-odds ratio of a feature with ``y`` of ``toxic`` and ``z`` of ``other`` words, and its standard deviation."""
    a = PRIOR * share
    odds = math.log((y + a) / max(1.0, toxic + PRIOR - y - a)) - math.log((z + a) / max(1.0, other + PRIOR - z - a))
    return odds, math.sqrt(1 / (y + a) + 1 / (z + a))


def segments(hits: list[tuple[int, float]], gap: float = GAP) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a walk with ``hits`` (place, score), ``-gap`` elsewhere."""
    out: list[list[float]] = []  # first, last, sum before the first, sum after the last
    total, before = 0.0, -1
    for place, score in hits:
        total -= gap * (place - before - 1)
        before = place
        new = [place, place, total, total + score]
        total += score
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j -= 1
            if j < 0 or out[j][3] >= new[3]:
                out.append(new)
                break
            new = [out[j][0], new[1], out[j][2], new[3]]
            del out[j:]
    return [(int(f), int(e), r - s) for f, e, s, r in out]


def decay(scores: np.ndarray, rates: np.ndarray, gap: float = GAP) -> float:
    """The positive root ``lambda`` of the mean of ``exp(lambda * score)`` being 1 in ordinary text."""
    rest = max(1e-9, 1.0 - rates.sum())
    mean = lambda x: float((rates * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * gap)) - 1.0
    low, high = 1e-6, 1.0
    if mean(low) >= 0:
        return low
    while mean(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return (low + high) / 2


def evidence(found: list[tuple[int, int, float]], words: int, rate: float) -> float:
    """Logarithm of the sum of ``exp(rate * score) / words`` over all segments, within fixed limits."""
    if not found:
        return NOTHING
    bits = [rate * s for _, _, s in found]
    top = max(bits)
    return min(HIGH, max(LOW, top + math.log(sum(math.exp(b - top) for b in bits)) - math.log(words + 1)))


class Model:
    """Scores of features, the decay rate of chance segments, the logistic curve, and the score of other texts."""

    def __init__(self, scores: dict[str, float], rate: float, curve: tuple[float, float] = (0.0, 0.0), bare: float = 0.5):
        self.scores, self.rate, self.curve, self.bare = scores, rate, curve, bare
        self.words: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "words": {}}

    def hits(self, text: str) -> tuple[list[tuple[int, float]], int]:
        known, scores = self.words, self.scores
        if len(known) > WORDS_HELD:
            known.clear()
        chunks = text.lower().split()
        for c in [c for c in set(chunks) if c not in known]:
            known[c] = max((scores.get(f, 0.0) for f in features(c)), default=0.0)
        return [(i, s) for i, s in enumerate(map(known.__getitem__, chunks)) if s], len(chunks)

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], float]:
        """Significant segments ``(first word, last word, lambda * S - ln n)`` and the evidence of a text."""
        hits, words = self.hits(text or "")
        found = segments(hits)
        strong = [(f, e, x) for f, e, s in found if (x := self.rate * s - math.log(words + 1)) >= SIGNIFICANT]
        return strong, evidence(found, words, self.rate)

    def probability(self, x: np.ndarray) -> np.ndarray:
        curve = 1.0 / (1.0 + np.exp(-np.clip(self.curve[0] + self.curve[1] * x, -30, 30)))
        return np.where(x <= NOTHING, self.bare, curve)


def logistic(x: np.ndarray, positive: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Intercept and slope fitted to counts by Newton's method; the slope is held back a little and never negative."""
    design = np.stack([np.ones(len(x)), x / 10.0], axis=1)
    penalty = np.diag([1e-6, ridge])
    w = np.zeros(2)
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (positive - n * p) - penalty @ w
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + penalty, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1]) / 10.0)


def fitted(docs: DataFrame, labels: DataFrame, lexicon: int = LEXICON) -> Model:
    """Learn feature scores, the chance rate and the curve."""
    chosen = settled(labelled(labels), "toxicity-labels")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST else chosen.hint("merge")
    train = settled(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic"), "toxicity-train")
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Model({}, 1.0)
    counts = settled(_counted(train, None), "toxicity-counts")
    of = counts.filter("feature = ''").first()
    y_all, z_all = of["toxic"], of["other"]
    leaning = (counts.feature != "") & (F.col("held") >= 3) & (F.col("toxic") * z_all > 2 * F.col("other") * y_all)
    likely = counts.filter(leaning).orderBy((F.col("toxic") / (F.col("other") + 1)).desc(), F.col("toxic").desc(), "feature").limit(lexicon)
    seen = {r["feature"]: (r["toxic"], r["other"]) for r in likely.collect()}
    corpus = {r["feature"]: r["other"] for r in _counted(docs.select("text", F.lit(0).alias("toxic")), set(seen)).collect()}
    scores, rates = {}, []
    for name, (y, z) in sorted(seen.items()):
        share = corpus.get(name, 1) / max(1, corpus[""])
        odds, deviation = log_odds(y, z, y_all, z_all, share)
        if (score := odds - CAUTION * deviation) >= LEAST_SCORE:
            scores[name] = score
            rates.append((score, (z + PRIOR * share) / (z_all + PRIOR)))
    at = np.array(rates, float).reshape(-1, 2)
    model = Model(scores, decay(at[:, 0], at[:, 1]))
    bins = scored(train, model, ["toxic"]).groupBy("toxic", F.round("evidence", 1).alias("x")).agg(F.count(F.lit(1)).alias("n")).collect()
    x = np.array([r["x"] for r in bins])
    n = np.array([r["n"] for r in bins], float)
    positive = n * np.array([r["toxic"] for r in bins])
    bare = x <= NOTHING
    model.bare = float((positive[bare].sum() + toxic / (toxic + other)) / (n[bare].sum() + 1))
    if not bare.all():
        model.curve = logistic(x[~bare], positive[~bare], n[~bare])
    return model


def scored(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score``, ``evidence`` and ``passages`` (first and last word, strength)."""
    text = text_col if text_col in keep else "_text"  # a kept text travels once
    held = sent(docs.sparkSession, model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("strength", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for piece in pieces(batches, text):
            got = [known.passages(t) for t in piece.column(text).to_pylist()]
            x = np.array([e for _, e in got])
            lists = pa.array([[{"first": f, "last": e, "strength": s} for f, e, s in strong] for strong, _ in got], kind)
            values = [*(piece.column(c) for c in keep), pa.array(known.probability(x)), pa.array(x), lists]
            yield pa.RecordBatch.from_arrays(values, [*keep, "score", "evidence", "passages"])

    types = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"{types}score double, evidence double, passages array<struct<first:int,last:int,strength:double>>"
    rows = docs.select(*keep) if text == text_col else docs.select(*keep, F.col(text_col).alias(text))
    return in_arrow(rows, score, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` of every document."""
    got = scored(docs, fitted(docs, labels), ["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"), "passages")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    plain, back = shielded(docs, "doc_id", "text")
    return back(scored(plain, fitted(plain, labels), plain.columns).filter(F.col("score") < REJECT))
