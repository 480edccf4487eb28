"""Distinct people over any period, from mergeable day nodes (AG2, AG3, JN14).

A *node* is a dyadic span of days: node ``n`` of level ``l`` holds the days ``n * 2**l`` up to ``(n + 1) * 2**l - 1`` since
1970.  For each node and each bucket of 32,768 person ids it keeps

* ``people``: a bitmap of the ids seen (``bitmap_construct_agg``), merged by ``bitmap_or_agg``; or, only when a caller asks
  for estimates, a HyperLogLog sketch merged by ``hll_union_agg``;
* ``visits``: how many visits, merged by ``sum``; ``first`` and ``last``: their least and greatest time.

A period is cut into at most two nodes a level (all nodes of the highest) plus at most two partial days, so its work does
not depend on its length.  A partial day whose visits all lie in the period is a node like any other; otherwise just that
day's visits are read.  Counts are exact: distinct people of a period are the bits of its merged nodes, never a sum of
sub-periods.

``period_figures`` does all that in one plan over visits.  ``DayCube`` stores the nodes and the visits by day, and answers
from them alone.  A batch of visits is appended as its own nodes of every level, since nodes merge; a replayed batch
overwrites itself, and readers see a batch only once its single write has committed.

Visits are shuffled as narrow rows by (day, bucket) before bitmaps are built, so no bitmap of a single visit is ever
written.  Visits without a person count as visits and as nobody; visits without a time, and periods without a bound or
that end before they start, hold nothing.  Dimensions are further columns of the visits; null is a value of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import written

#: Highest level: nodes of 2**11 days.  Longer periods take several of those.
TOP = 11
#: Levels that one pass merges from the level below; a pass reads 2**-4 of what the pass before it read.
STEP = 4
SKETCH_LOG2 = 14
#: Tasks a core for work whose rows are few bytes until bitmaps come of them.  AQE would join its tasks by those bytes.
TASKS = 16
#: The nodes of a span that many periods take meet those in as many tasks.
SALTS = 16


def _tasks(df: DataFrame) -> int:
    return TASKS * df.sparkSession.sparkContext.defaultParallelism


def day_number(ts: Column | str) -> Column:
    return F.unix_date(F.to_date(ts)).cast("long")


def _midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


class _Measure:
    """How people are held, merged and counted."""

    def __init__(self, exact: bool) -> None:
        self.exact = exact

    def bucket(self) -> Column:
        return F.bitmap_bucket_number(F.col("person_id").cast("long")) if self.exact else F.lit(0).cast("long")

    def of_visits(self) -> Column:
        return F.bitmap_construct_agg(F.bitmap_bit_position("person_id")) if self.exact else F.hll_sketch_agg("person_id", SKETCH_LOG2)

    def merged(self) -> Column:
        return F.bitmap_or_agg("people") if self.exact else F.hll_union_agg("people")

    def counted(self) -> Column:
        return F.sum(F.bitmap_count("people")) if self.exact else F.sum(F.hll_sketch_estimate("people"))


def day_nodes(visits: DataFrame, dims: tuple[str, ...] = (), exact: bool = True) -> DataFrame:
    """Nodes of level 0: ``(level, node, *dims, bucket, people, visits, first, last)``."""
    m = _Measure(exact)
    rows = visits.where(F.col("timestamp").isNotNull()).select(
        day_number("timestamp").alias("node"), *dims, m.bucket().alias("bucket"), F.col("person_id").cast("long").alias("person_id"), "timestamp")
    keys = ["node", *dims, "bucket"]
    # narrow rows go over the wire; both halves of the aggregate then run where they arrive, with the neighbours that the
    # nodes are merged with next
    rows = rows.withColumn("span", F.expr(f"shiftright(node, {STEP})"))
    met = rows.repartition(_tasks(rows), "span", *dims, "bucket") if exact else rows
    return (met.groupBy("span", *keys)
            .agg(m.of_visits().alias("people"), F.count(F.lit(1)).alias("visits"),
                 F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
            .select(F.lit(0).alias("level"), *keys, "people", "visits", "first", "last"))


def raised(nodes: DataFrame, low: int, high: int, dims: tuple[str, ...] = (), exact: bool = True) -> DataFrame:
    """Nodes of levels ``low + 1`` to ``high`` from those of level ``low``."""
    m = _Measure(exact)
    up = (nodes.withColumn("level", F.explode(F.sequence(F.lit(low + 1), F.lit(high))))
          .withColumn("node", F.expr(f"shiftright(node, level - {low})")))
    return (up.groupBy("level", "node", *dims, "bucket")
            .agg(m.merged().alias("people"), F.sum("visits").alias("visits"),
                 F.min("first").alias("first"), F.max("last").alias("last")))


def cover(spans: DataFrame, top: int = TOP) -> DataFrame:
    """``spans(low, high, ...)`` of whole days, both ends included -> one row per dyadic node ``(level, node, ...)``."""
    rest = [c for c in spans.columns if c not in ("low", "high")]
    at = (spans.where("low <= high").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
          # what is left of the span at a level: nodes l up to r - 1, after odd ends went to lower levels
          .withColumn("l", F.expr("shiftright(low + shiftleft(1L, level) - 1, level)"))
          .withColumn("r", F.expr("shiftright(high + 1, level)")).where("l < r"))
    ends = F.expr("filter(array(if(l & 1 = 1, l, null), if(r & 1 = 1, r - 1, null)), x -> x IS NOT NULL)")
    nodes = F.when(F.col("level") == top, F.expr("sequence(l, r - 1)")).otherwise(ends)
    return at.select(*rest, "level", F.explode(nodes).alias("node"))


def _answers(periods: DataFrame, nodes: DataFrame, visits: DataFrame, dims: tuple[str, ...], exact: bool) -> DataFrame:
    """Figures of distinct ``periods(start, end)`` from nodes of every level and, for partial days, visits by day."""
    m = _Measure(exact)
    low, high = F.to_date("start"), F.to_date("end")
    from_midnight = F.col("start") == _midnight(low)
    to_midnight = F.col("end") >= _midnight(F.date_add(high, 1)) - F.expr("INTERVAL '0.000001' SECOND")
    asked = periods.where(F.col("start") <= F.col("end")).select(
        "start", "end",
        (day_number("start") + F.when(from_midnight, 0).otherwise(1)).alias("low"),
        (day_number("end") - F.when(to_midnight, 0).otherwise(1)).alias("high"),
        F.array_distinct(F.filter(F.array(F.when(~from_midnight, day_number("start")), F.when(~to_midnight, day_number("end"))),
                                  lambda z: z.isNotNull())).alias("edges"))
    inner = cover(asked.select("start", "end", "low", "high"))
    # a partial day with no visit outside the period is a whole one
    days = (nodes.where("level = 0").groupBy(F.col("node").alias("day"))
            .agg(F.min("first").alias("first"), F.max("last").alias("last")))
    edges = (asked.select("start", "end", F.explode("edges").alias("day")).join(days, "day")
             .withColumn("whole", (F.col("first") >= F.col("start")) & (F.col("last") <= F.col("end"))))
    spans = inner.unionByName(edges.where("whole").select("start", "end", F.lit(0).alias("level"), F.col("day").alias("node")))
    keys = ["start", "end", *dims, "bucket"]
    # a span that most periods take has many of its buckets' bitmaps copied: by buckets to different tasks
    salted = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) if exact else spans.withColumn("salt", F.lit(0))
    dealt = nodes.withColumn("salt", F.pmod(F.hash("bucket"), F.lit(SALTS)) if exact else F.lit(0)).select("level", "node", "salt", *dims, "bucket", "people", "visits")
    met = dealt.repartition(_tasks(nodes), "level", "node", "salt") if exact else dealt
    from_nodes = salted.join(met, ["level", "node", "salt"]).select(*keys, "people", "visits")
    cut = edges.where("NOT whole").select("start", "end", "day")
    some = (cut.join(visits.withColumn("day", day_number("timestamp")), "day")
            .where(F.col("timestamp").between(F.col("start"), F.col("end")))
            .withColumn("bucket", m.bucket()).select(*keys, "person_id"))
    from_visits = ((some.repartition(*keys) if exact else some).groupBy(*keys)
                   .agg(m.of_visits().alias("people"), F.count(F.lit(1)).alias("visits")))
    merged = (from_nodes.unionByName(from_visits).groupBy(*keys)
              .agg(m.merged().alias("people"), F.sum("visits").alias("visits")))
    found = (merged.groupBy("start", "end", *dims)
             .agg(F.sum("visits").cast("bigint").alias("visits"), m.counted().cast("bigint").alias("clients")))
    if dims:
        return found
    return (periods.join(found, ["start", "end"], "left")
            .select("start", "end", F.coalesce("visits", F.lit(0)).cast("bigint").alias("visits"),
                    F.coalesce("clients", F.lit(0)).cast("bigint").alias("clients")))


def period_figures(visits: DataFrame, periods: DataFrame, dims: tuple[str, ...] = (), exact: bool = True) -> DataFrame:
    """``(start, end, *dims, visits, clients)`` of all different ``periods(start, end)``, in one plan over ``visits``.

    Without dimensions every period has a row, else every period and value with visits."""
    days = day_nodes(visits, dims, exact)
    nodes = days.unionByName(raised(days, 0, TOP, dims, exact))
    return _answers(periods.select("start", "end").distinct(), nodes, visits, dims, exact)


class DayCube:
    """Stored nodes and visits by day.  ``root`` is a folder that all executors share."""

    EDGE = -1

    def __init__(self, spark: SparkSession, root: str, dims: tuple[str, ...] = (), exact: bool = True) -> None:
        self.spark, self.root, self.dims, self.exact = spark, root.rstrip("/"), tuple(dims), exact

    def append(self, visits: DataFrame, batch: str) -> None:
        """Adds a batch of visits, each in one batch only.  The same batch again replaces itself."""
        dims = self.dims
        visits = visits.select("person_id", "timestamp", *dims)
        steps = [written(self.spark, day_nodes(visits, dims, self.exact), "cube")]
        for low in range(0, TOP, STEP):
            below = steps[-1].where(F.col("level") == low)
            if self.exact:      # small files of bitmaps are read together; here they go apart, neighbours to one task
                below = below.repartition(_tasks(below), F.expr(f"shiftright(node, {STEP})"), *dims, "bucket")
            steps.append(written(self.spark, raised(below, low, min(low + STEP, TOP), dims, self.exact), "cube"))
        rows = reduce(DataFrame.unionByName, steps).withColumn("person_id", F.lit(None).cast("long"))
        edges = visits.where(F.col("timestamp").isNotNull()).select(
            F.lit(self.EDGE).alias("level"), day_number("timestamp").alias("node"), *dims, F.col("timestamp").alias("first"), F.col("person_id").cast("long").alias("person_id"))
        every = rows.unionByName(edges, allowMissingColumns=True).repartitionByRange(_tasks(visits), "level", "node", "bucket").sortWithinPartitions("level", "node")
        every.write.mode("overwrite").partitionBy("level").parquet(f"{self.root}/batch={batch}")

    def _read(self) -> DataFrame:
        return self.spark.read.option("basePath", self.root).parquet(f"{self.root}/batch=*")

    def nodes(self) -> DataFrame:
        return self._read().where(F.col("level") >= 0).select("level", "node", *self.dims, "bucket", "people", "visits", "first", "last")

    def visits(self) -> DataFrame:
        """Visits by day, for partial days."""
        return self._read().where(F.col("level") == self.EDGE).select("person_id", F.col("first").alias("timestamp"), *self.dims)

    def figures(self, periods: DataFrame) -> DataFrame:
        """As :func:`period_figures`, from the stored cube alone."""
        return _answers(periods.select("start", "end").distinct(), self.nodes(), self.visits(), self.dims, self.exact)
