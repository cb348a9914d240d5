"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document's terms are its words (A-Z and other letters lowered, split at ASCII white space), weighted by how often they
occur. For each of ``SAMPLES`` places every term draws, from a hash of term and place, two gamma(2, 1) variates ``r`` and
``c`` and a uniform ``b``; with ``t = floor(ln w / r + b)`` its draw is ``ln a = ln c - r (t - b) - r``, and the place takes
the term, with its ``t``, of the smallest draw. Two documents agree in a place with a probability equal to the generalised
Jaccard similarity ``sum(min(w, w')) / sum(max(w, w'))``. A gamma variate is ``-ln(u v)`` of two uniforms.

Word counts of a document are runs of its sorted word hashes, so no row of a word leaves its task: places are minima,
kept per document next to where its text was read. Hashes are 64 bits of a word, 32 bits of a place in the fingerprint.

``edited`` replaces the second half of each text by the beginning of the next document's. The order of documents comes
from ids alone, range-partitioned, with one small table of partition heads; only the needed beginnings of texts are
sent to their predecessors.

Defined results: a null text is empty; texts without words share one fingerprint, like to each other by 1; rows equal in
id and text count as one document in the order and each get its result; a null id comes last; the only document follows
itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.llm.common import settled, text_of

SAMPLES = 64
#: So many neighbouring places share a number that is hashed with what they take.
TOGETHER = 4
#: A place's smallest draw of a text is above ``SURELY`` by its number of words with a probability of ``exp(-SURELY)``.
SURELY = 20.0


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``places``, an array of ``samples`` numbers, for each row of ``keys, text`` (keys are unique, and not wide).

    Texts that have a place without a draw below their limit, if any, are drawn once more without limit.
    """
    first = settled(_drawn(texts, keys, samples, SURELY), "sampling-draws")
    if first.filter("lost").isEmpty():
        return first.drop("lost")
    again = texts.join(first.filter("lost").select(*keys), keys, "left_semi")
    return settled(first.filter("NOT lost").unionByName(_drawn(again, keys, samples, None)).drop("lost"), "sampling-prints")


def _drawn(texts: DataFrame, keys: list[str], samples: int, surely: float | None) -> DataFrame:
    """``keys, places`` and whether a place is ``lost``, because no draw of the text is below ``surely`` by its number of words.

    A minimum of exponential variates of rates ``w`` is one of the rate ``sum(w)``. What cannot be below the limit is left
    out before its logarithms are taken: with ``y`` and ``z`` the products of uniforms behind ``c`` and ``r``, ``c`` is at
    least ``2 (1 - y) / (1 + y)``, and ``exp(ln c - r (t - b) - r)`` at least ``c z / w``, for single words at least
    ``c z / (z + (1 - b) (1 - z))``.
    """
    hashed = F.transform(F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    terms = texts.select(*keys, F.sort_array(hashed).alias("_s"))
    ends = F.expr("if(size(_s) > 0, filter(sequence(0, size(_s) - 1), i -> i = size(_s) - 1 OR _s[i] <> _s[i + 1]), array())")
    terms = terms.select(*keys, "_s", ends.alias("_e"))
    runs = F.expr("transform(_e, (e, j) -> struct(_s[e] AS _w, e - if(j = 0, -1, _e[j - 1]) AS _n))")
    # a term that is null stands in every place, so that each has a row; in a text without words it is the only one
    runs = F.concat(runs, F.expr("array(struct(cast(NULL AS bigint) AS _w, size(_s) AS _n))"))
    limit = F.lit(surely) / F.size("_s") if surely else F.lit(float("inf"))
    terms = terms.select(*keys, F.when(F.size("_s") > 0, limit).alias("_limit"), F.inline(runs))
    terms = terms.select(*keys, "_limit", F.log("_limit").alias("_most"), "_w", F.col("_n").cast("double").alias("_n"), F.log(F.greatest("_n", F.lit(1)).cast("double")).alias("_lw"))
    terms = terms.withColumn("_g", F.explode(F.expr(f"sequence(0, {samples - 1})")))
    # one step a projection: every value is worked out once, in methods short enough to be compiled
    drawn = terms.select("*", *(F.expr(f"xxhash64(_w, _g, '{side}')").alias(f"_{side}") for side in "ab"))
    steps = (
        ("z", "((_a & 2097151) + 0.5D) * ((shiftrightunsigned(_a, 21) & 2097151) + 0.5D) / 4398046511104D"),
        ("u", "shiftrightunsigned(_a, 42) / 2097152D"),
        ("y", "((_b & 4294967295) + 0.5D) * (shiftrightunsigned(_b, 32) + 0.5D) / 18446744073709551616D"),
        ("x", "_b & 262143L"),
        # not deterministic, so that a filter stays behind its step, whose values are not worked out twice
        ("here", "spark_partition_id()"),
    )
    drawn = drawn.select(*keys, "_g", "_limit", "_most", "_w", "_n", "_lw", *(F.expr(e).alias(f"_{n}") for n, e in steps))
    if surely:
        drawn = drawn.filter("_here >= 0 AND (_w IS NULL OR 2 * (1 - _y) * _z <= 1.000001D * _limit * (1 + _y) * if(_n = 1, _z + (1 + floor(_u) - _u) * (1 - _z), _n))")
    drawn = drawn.select("*", F.expr("-ln(_z)").alias("_r"), F.expr("ln(-ln(_y))").alias("_c"))
    drawn = drawn.select("*", F.expr("floor(_lw / _r + _u)").alias("_t"))
    drawn = drawn.select(*keys, "_g", "_n", "_w", "_x", "_most", "_t", F.expr("_c - _r * (_t - _u + 1)").alias("_d"), F.expr("spark_partition_id()").alias("_here"))
    drawn = drawn.filter("_here >= 0 AND (_w IS NULL OR _d < _most)")
    place = "if(_w IS NULL, if(_n = 0, -1L, NULL), shiftleft(cast((_d + 64D) * 67108864D AS long), 26) | shiftleft(_x, 8) | (_t & 255L))"
    parts = drawn.groupBy(*keys, "_g").agg(F.min(F.expr(place)).alias("_m"))
    found = F.expr(f"coalesce(hash(cast(_g div {TOGETHER} AS int), nullif(_m, -1L)), 0)")
    parts = parts.select(*keys, F.struct("_g", found.alias("p")).alias("part"), F.col("_m").isNull().alias("_lost"))
    whole = parts.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"), F.max("_lost").alias("lost"))
    return whole.select(*keys, F.col("parts.p").alias("places"), "lost")


def likeness(a, b, samples: int = SAMPLES):
    """The share of places in which two fingerprints agree."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(samples))


def written(places):
    """A fingerprint as a string: eight hexadecimal digits a place."""
    return F.array_join(F.transform(places, lambda p: F.lower(F.lpad(F.hex(p.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def ordered(documents: DataFrame) -> DataFrame:
    """``k, n, next_k, prev_k, prev_n`` of ``k, doc_id, h, n``: documents in order, the last followed by the first."""
    parts = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = documents.repartitionByRange(parts, F.col("doc_id").asc_nulls_last(), "h").withColumn("p", F.spark_partition_id())
    ranged = settled(ranged, "sampling-order")
    this = F.struct("k", "n")
    inside = W.partitionBy("p").orderBy(F.col("doc_id").asc_nulls_last(), "h")
    chained = ranged.select("p", "k", "n", F.lead(this).over(inside).alias("after"), F.lag(this).over(inside).alias("before"))
    chained = settled(chained, "sampling-chain")
    heads = chained.filter("before IS NULL").select("p", this.alias("head"))
    tails = chained.filter("after IS NULL").select("p", this.alias("tail"))
    around = W.orderBy("p")  # one row per partition
    whole = around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = heads.join(tails, "p").select(
        "p",
        F.coalesce(F.lead("head").over(around), F.first("head").over(whole)).alias("next_head"),
        F.coalesce(F.lag("tail").over(around), F.last("tail").over(whole)).alias("prev_tail"),
    )
    after, before = F.coalesce("after", "next_head"), F.coalesce("before", "prev_tail")
    return chained.join(ends, "p").select("k", "n", after["k"].alias("next_k"), before["k"].alias("prev_k"), before["n"].alias("prev_n"))


def digest(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    Documents are joined by ``k``, a hash of id and text; all draws of a document are made where its text arrives.
    """
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "h"))
    found = rows.groupBy("k").agg(
        F.max("doc_id").alias("doc_id"), F.max("h").alias("h"), F.count(F.lit(1)).alias("times"), F.max(F.char_length("text")).cast("long").alias("n")
    )
    found = settled(found, "sampling-documents")
    chain = settled(ordered(found.drop("times")), "sampling-neighbours")
    if found.agg(F.max("times")).first()[0] not in (None, 1):
        rows = rows.dropDuplicates(["k"])
    whole = rows.select("k", "text").join(chain, "k")
    gift = whole.select(F.col("prev_k").alias("k"), F.expr("substr(text, 1, cast(prev_n div 2 AS int))").alias("gift"))
    edited = F.concat(F.expr("substr(text, 1, cast(n - n div 2 AS int))"), F.expr("substr(gift, 1, cast(n div 2 AS int))"))
    both = whole.join(gift, "k").withColumn("edited", edited)
    both = both.withColumn("sum", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    versions = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    both = both.select("k", "next_k", "sum", versions.alias("v")).select("k", "next_k", "sum", "v.kind", "v.text")
    prints = fingerprints(both, ["k", "next_k", "sum", "kind"], samples)
    plain = prints.filter("kind = 0").select("k", "next_k", "places")
    other = prints.filter("kind = 1").select("k", "sum", F.col("places").alias("e_places"))
    after = prints.filter("kind = 0").select(F.col("k").alias("next_k"), F.col("places").alias("n_places"))
    out = plain.join(other, "k").join(found.select("k", "doc_id", "n", "times"), "k").join(after, "next_k")
    out = out.select(
        "doc_id",
        F.col("n").alias("n_chars"),
        F.lower(F.hex("sum")).alias("edited_sha256"),
        written(F.col("places")).alias("fingerprint"),
        written(F.col("e_places")).alias("edited_fingerprint"),
        likeness(F.col("places"), F.col("e_places"), samples).alias("near_edited"),
        likeness(F.col("places"), F.col("n_places"), samples).alias("near_next"),
        "times",
    )
    return out.withColumn("_copy", F.explode(F.expr("sequence(1L, times)"))).drop("times", "_copy")
