"""Mixing sources to target weights by a low-discrepancy schedule.

The mix has as many words as the input.  It is cut into slots of equal length;
slot i falls to the source whose share of the unit interval holds the i-th point
of a golden-ratio sequence, so every stretch of the mix is close to the targets.
A source with less than LEAST_SLOTS of those slots gets shorter ones (a power of two
of words), in a schedule with all sources of that length: whatever the size of the
corpus, a source's words come within a few slots of its target.
Each source's documents, shuffled by hash, form a stream that may be read three
times over and is cut into blocks as long as a slot: the r-th slot of a source
takes its r-th block.

Targets: sources in code point order, null last, weigh 5, 2, 1, 5, ... and share
all words by weight.  A target stops at three times its source's words; what is
over goes to the others by weight.  All of it is DataFrame functions.

A null text has no words; documents without words take no part.  Each row counts
for itself, also if rows or ids repeat.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Slots of a mix, as a power of two, as long as a slot has between 1 and LONGEST words.
SLOTS_LOG2, LONGEST = 21, 4096
#: The golden ratio's fraction in 31 bits, odd: i * GOLDEN modulo 2**31 visits every point once.
GOLDEN, POINTS = 1327217885, 1 << 31
#: Slots that a source has at least, as long as they have a word each.
LEAST_SLOTS = 256
CELLS, CHUNK, SHUFFLED_TOGETHER = 1024, 1 << 16, 10_000


def shares(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source of ``sizes(source, size)``: number s, words, target, and its part [low, high) of the unit interval."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    all_of_them = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("s") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats).withColumn("total", F.sum("source_size").over(all_of_them))
    # sources fill up in order of cap by weight; the level is where the rest can share what is left by weight
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - before) / rest)
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(all_of_them)
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))
    part = F.try_divide(F.sum("target").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.sum("target").over(all_of_them))
    per = per.withColumn("low", F.coalesce(part, F.lit(0.0)))
    return per.withColumn("high", F.lead("low", 1, 1.0).over(Window.orderBy("s"))).select("s", "source", "source_size", "target", "low", "high", "total")


def schedule(parts: DataFrame, slots: int) -> DataFrame:
    """``(s, rank, slot)``: which source each slot falls to, and how many slots of that source come before it."""
    spark = parts.sparkSession
    points = spark.range(0, slots, 1, max(spark.sparkContext.defaultParallelism, -(-slots // (1 << 20)))).withColumnRenamed("id", "slot")
    point = (F.pmod(F.pmod(F.col("slot"), F.lit(POINTS)) * GOLDEN, F.lit(POINTS)) + 0.5) / POINTS
    points = points.withColumn("point", point).withColumn("cell", F.floor(F.col("point") * CELLS))
    cells = parts.where("low < high").select("s", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    fallen = points.join(cells, "cell").where("point >= low AND point < high").select("s", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = fallen.groupBy("s", "chunk").agg(F.count("*").alias("n"))
    until = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("s", "chunk", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("s", "chunk").orderBy("slot")) - 1
    return fallen.withColumn("within", within).join(starts, ["s", "chunk"]).select("s", (F.col("before") + F.col("within")).alias("rank"), "slot")


def shuffled(sizes: DataFrame, parts: DataFrame) -> DataFrame:
    """``sizes`` with each document's place in its source's stream, in hash order; no group grows with a source."""
    groups = -(-sizes.count() // SHUFFLED_TOGETHER) + 1
    rows = sizes.join(parts.select("s", F.col("source").alias("own")), F.col("source").eqNullSafe(F.col("own"))).withColumn("group", F.pmod(F.col("order"), F.lit(groups)))
    sums = rows.groupBy("s", "group").agg(F.sum("size").alias("words"))
    until = Window.partitionBy("s").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("s", "group", F.coalesce(F.sum("words").over(until), F.lit(0)).alias("before"))
    so_far = F.sum("size").over(Window.partitionBy("s", "group").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("so_far", F.coalesce(so_far, F.lit(0))).join(starts, ["s", "group"]).select("row", "id", "s", "size", (F.col("before") + F.col("so_far")).alias("start"))


def blocks_of(placed: DataFrame, parts: DataFrame, length: int, repeats: int = REPEATS) -> DataFrame:
    """``(s, rank, row, words)``: the documents' pieces in the blocks of their source's stream, read over as far as the target asks."""
    rows = placed.where("size > 0").join(parts.select("s", "source_size", "target"), "s")
    # a source gets few slots more than its target asks; blocks past those meet no slot
    turns = F.least(F.lit(repeats - 1), F.floor((F.col("target") + 16 * length) / F.col("source_size")))
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), turns.cast("long"))))
    rows = rows.withColumn("from", F.col("start") + F.col("turn") * F.col("source_size")).withColumn("to", F.col("from") + F.col("size"))
    rows = rows.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / length), F.floor((F.col("to") - 1) / length))))
    return rows.select("s", "rank", "row", (F.least("to", (F.col("rank") + 1) * length) - F.greatest("from", F.col("rank") * length)).alias("words"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Words, source and shuffling order of each row, written once: the texts are read no more."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.xxhash64(F.lit("mix"), id_col, text_col).alias("order"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as ``(length, slot, s, rank, row, words)``, the placed documents, and the sources' shares.

    There is one schedule for each length of slots; ``low`` and ``high`` are a source's part of its own."""
    sizes = measured(docs, id_col, text_col, source_col)
    parts = stored(shares(sizes), "mix-shares")
    total = parts.agg(F.max("total")).first()[0] or 0
    length = min(LONGEST, max(1, total >> SLOTS_LOG2))
    placed = stored(shuffled(sizes, parts), "mix-placed")
    shorter = F.expr(f"shiftleft(1L, cast(floor(log2(greatest(target / {LEAST_SLOTS}, 1.0D))) AS int))")
    parts = parts.withColumn("length", F.least(F.lit(length).cast("long"), shorter))
    alike = Window.partitionBy("length")
    until = F.sum("target").over(alike.orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("low", F.coalesce(F.try_divide(until, F.sum("target").over(alike)), F.lit(0.0))).withColumn("high", F.lead("low", 1, 1.0).over(alike.orderBy("s")))
    parts = stored(parts, "mix-parts")
    # at most as many lengths as there are powers of two up to LONGEST
    lengths = parts.groupBy("length").agg(F.ceil(F.round(F.sum("target") / F.col("length"), 6)).alias("slots")).orderBy("length").collect()
    mixes = []
    for r in lengths:
        own = parts.where(F.col("length") == r["length"])
        mixes.append(schedule(own, r["slots"]).join(blocks_of(placed, own, r["length"]), ["s", "rank"]).withColumn("length", F.lit(r["length"])))
    if not mixes:
        mixes = [schedule(parts, 0).join(blocks_of(placed, parts, 1), ["s", "rank"]).withColumn("length", F.lit(1).cast("long"))]
    return reduce(DataFrame.unionByName, mixes), placed, parts


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: its words, its source's words and target, and how many of its words the mix takes, repeats counted."""
    mix, placed, parts = mixture(docs, id_col, text_col, source_col)
    taken = mix.groupBy("row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "row", "left").join(parts.select("s", "source_size", "target"), "s").select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
