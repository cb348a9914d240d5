"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is laid out as one stream of words: its documents in hash order, cut into blocks of equally many
words. A schedule of slots decides which source speaks next: slot ``i`` is the golden-ratio point
``frac(i * phi)``, looked up in the cumulative weights, so that any stretch of the schedule holds each source in
proportion. The slots of a source are ranked; the slot of rank ``r`` takes block ``r`` of that source, starting
again from its first block when the stream is used up. The last slot of a source is cut so that the source gives
exactly the whole part of its target.

A running sum over one source would be one task, so it is built in two levels: sums per hash bucket (about
``ROWS_PER_BUCKET`` rows) are cumulated per source, rows only within their bucket. Ranks of slots likewise.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own, the last;
an empty table gives no rows; repeated rows each keep their own row; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.llm.common import WORD, settled, shielded

#: Weights by position of the source, repeating.
WEIGHTS = (3, 1, 2)
#: Slots of the schedule; more slots mean smaller blocks.
SLOTS = 1 << 18
ROWS_PER_BUCKET = 4096
GOLDEN = 0.6180339887498949
#: Cells in which points look up their source.
CELLS = 4096


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size``: the number of words of each document."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: ``source_key, source, n, source_size, weight, target``.

    Targets share ``share`` of all sizes by weight, none above ``cap`` times its source; what a source cannot take
    is shared again among the others. Sources in the order of ``cap / weight`` fill up one after another, so the
    level at which the rest stands is a ratio of two running sums.
    """
    per = sized.groupBy(source_key().alias("source_key"), "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    per = per.withColumn("seq", (F.row_number().over(by_name) - 1).cast("long"))
    per = per.withColumn("weight", F.element_at(cycle, (F.col("seq") % len(weights) + 1).cast("int")).cast("double"))
    per = per.withColumn("most", cap * F.col("source_size"))
    filling = W.orderBy(F.col("most") / F.col("weight"), "seq")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    rest = filling.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("total", share * F.sum("source_size").over(everything))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    full = F.col("most") <= F.col("level") * F.col("weight")
    per = per.withColumn("level", F.first(F.when(~full, F.col("level")), ignorenulls=True).over(everything))
    per = per.withColumn("target", F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight"))))
    return per.select("source_key", "source", "seq", "n", "source_size", "weight", "target")


def source_key():
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def streams(sized: DataFrame, seed: int = 7) -> DataFrame:
    """``sized`` with ``source_key, start, bucket, seat``: where each document begins in its source's shuffled stream."""
    rows = sized.count()
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    hashed = sized.select("*", source_key().alias("source_key"), F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("h"))
    hashed = hashed.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    sums = hashed.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("source_key", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source_key", "bucket").orderBy("h", "doc_id", "size")
    placed = hashed.withColumn("seat", F.row_number().over(inside))
    placed = placed.withColumn("run", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return placed.join(offsets, ["source_key", "bucket"]).select(
        "doc_id", "source_key", "size", "bucket", "seat", (F.col("offset") + F.col("run") - F.col("size")).alias("start")
    )


def blocked(per_source: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Sources with ``block`` (words of a block), ``blocks``, ``quota`` (whole words to take) and ``turns`` (slots needed)."""
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cut = per_source.withColumn("block", F.greatest(F.lit(1), F.ceil(F.sum("target").over(everything) / slots)).cast("long"))
    cut = cut.withColumn("quota", F.floor(F.col("target") + 1e-6).cast("long"))
    cut = cut.withColumn("blocks", F.expr("(source_size + block - 1) div block"))
    turns = F.expr("CASE WHEN source_size = 0 THEN 0 ELSE (quota div source_size) * blocks + (quota % source_size + block - 1) div block END")
    return cut.withColumn("turns", turns)


def schedule(cut: DataFrame, slots: int) -> DataFrame:
    """``slot, source_key, turn``: every turn of every source once, in low-discrepancy order.

    The points alone miss the wanted number of turns of a source by a few: turns beyond it are dropped, missing
    ones follow at the end.
    """
    spark = cut.sparkSession
    upto = W.orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    lanes = cut.filter("turns > 0").select("source_key", "seq", "turns", F.coalesce(F.sum("turns").over(upto), F.lit(0)).alias("low"))
    lanes = lanes.withColumn("all_turns", F.lit(slots).cast("long"))
    cell = f"{CELLS} div all_turns"
    cells = lanes.withColumn("cell", F.explode(F.expr(f"sequence(low * {cell}, (low + turns - 1) * {cell})")))
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") * GOLDEN).alias("x"))
    points = points.select("slot", F.floor((F.col("x") - F.floor("x")) * slots).cast("long").alias("q"))
    points = points.withColumn("cell", F.expr(f"q * {CELLS} div {max(1, slots)}"))
    landed = points.join(cells, "cell").filter("q >= low AND q < low + turns").select("slot", "source_key", F.expr("slot div 4096").alias("chunk"))
    per_chunk = landed.groupBy("source_key", "chunk").agg(F.count(F.lit(1)).alias("here"))
    before = W.partitionBy("source_key").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_chunk.select("source_key", "chunk", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source_key", "chunk").orderBy("slot")
    ranked = landed.withColumn("seat", F.row_number().over(inside) - 1).join(offsets, ["source_key", "chunk"])
    ranked = ranked.select("slot", "source_key", (F.col("offset") + F.col("seat")).alias("turn"))
    ranked = ranked.join(lanes.select("source_key", "turns"), "source_key").filter("turn < turns").drop("turns")
    reached = per_chunk.groupBy("source_key").agg(F.sum("here").alias("got"))
    late = lanes.join(reached, "source_key", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < turns")
    late = late.withColumn("turn", F.explode(F.expr("sequence(got, turns - 1)")))
    late = late.select((F.col("low") + F.col("turn") + slots).alias("slot"), "source_key", "turn")
    return ranked.unionByName(late)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, slots: int = SLOTS, seed: int = 7) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_slot``: how many words of each document the mix takes, repeats counted.

    ``first_slot`` is the place in the schedule where the document first speaks (null if it is not taken).
    """
    sized = settled(sizes(docs), "mix-sizes")
    cut = settled(blocked(targets(sized, weights, share, cap), slots), "mix-sources")
    placed = streams(sized, seed).join(cut.select("source_key", "source_size", "target", "block"), "source_key")
    turns = cut.agg(F.coalesce(F.sum("turns"), F.lit(0))).first()[0]
    plan = schedule(cut, turns).join(cut.select("source_key", "source_size", "block", "blocks", "quota"), "source_key")
    plan = plan.withColumn("b", F.expr("turn % blocks"))
    plan = plan.withColumn("spent", F.expr("(turn div blocks) * source_size + b * block"))
    plan = plan.select(
        "source_key", "b", "slot", F.expr("greatest(0L, least(quota - spent, block, source_size - b * block))").alias("take")
    ).filter("take > 0")
    parts = placed.withColumn("b", F.explode(F.expr("sequence(start div block, greatest(start, start + size - 1) div block)")))
    met = parts.join(plan, ["source_key", "b"], "left").withColumn("take", F.coalesce("take", F.lit(0)))
    taken = F.expr("greatest(0L, least(start + size, b * block + take) - greatest(start, b * block))")
    met = met.withColumn("part", taken)
    per_doc = met.groupBy("source_key", "bucket", "seat", "doc_id", "size", "source_size", "target").agg(
        F.sum("part").alias("taken"), F.min(F.when(F.col("part") > 0, F.col("slot"))).alias("first_slot")
    )
    return per_doc.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, to the nearest whole number (rows of one id alike)."""
    docs, back = shielded(docs, "doc_id", "text", "source")
    got = mix(docs, **options).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    times = got.select(F.col("doc_id").alias("_id"), F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int").alias("_times"))
    joined = docs.join(times.filter("_times > 0"), F.col("doc_id").eqNullSafe(F.col("_id")))
    return back(joined.withColumn("_copy", F.explode(F.expr("sequence(1, _times)"))))
