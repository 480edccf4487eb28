"""Suspension refresh by interval endpoints (ST4, SUS1).

Suspensions are kept as their endpoints, sorted by time under a folder per month: ``(person_id, at, delta)``.  The state at
a time is how many suspensions each person has open.  A refresh from ``t1`` to ``t2`` reads only the endpoints in
``(t1, t2]``, adds up their deltas by person and applies them to the state, so its work goes with what happened in between,
not with the history.

The reference tests the end only (Q13): a suspension is open from the beginning until its end.  With ``require_started`` it
opens at its start.  One that ends at a time is over at that time.  Suspensions without an end, without a person or (with
``require_started``) without a start are never open, nor are those that end before or when they start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import written

MONTH = "at_month"


def _month(at):
    return (F.year(at) * 100 + F.month(at)).cast("int")


class OpenSuspensions:
    """Endpoints under ``root``, and the state at one time, moved forward by :meth:`advance`."""

    def __init__(self, spark: SparkSession, root: str, require_started: bool = False) -> None:
        self.spark, self.root, self.require_started = spark, root.rstrip("/"), require_started
        self.at: str | None = None
        self.open: DataFrame | None = None      # (person_id, open), people with at least one
        self.changed: DataFrame | None = None   # (person_id, suspended) of people whose flag the last step turned

    def build(self, suspensions: DataFrame) -> None:
        """Stores the endpoints of ``suspensions(person_id, starttime, endtime)``; the state is that before all of them."""
        s = suspensions.where(F.col("endtime").isNotNull() & F.col("person_id").isNotNull()).select("person_id", "starttime", "endtime")
        ends = s if not self.require_started else s.where("starttime < endtime")
        points = ends.select("person_id", F.col("endtime").alias("at"), F.lit(-1).alias("delta"))
        if self.require_started:
            points = points.unionByName(ends.select("person_id", F.col("starttime").alias("at"), F.lit(1).alias("delta")))
        points = points.groupBy("person_id", "at").agg(F.sum("delta").alias("delta"))
        (points.withColumn(MONTH, _month(F.col("at"))).repartitionByRange(MONTH, "at").sortWithinPartitions(MONTH, "at")
         .write.partitionBy(MONTH).parquet(f"{self.root}/endpoints"))
        none = points.select("person_id", F.lit(0).cast("long").alias("open")).limit(0)
        before = none if self.require_started else s.groupBy("person_id").agg(F.count(F.lit(1)).alias("open"))
        self.at, self.open, self.changed = None, written(self.spark, before, "open_suspensions"), None

    def endpoints(self, after: str | None, until: str) -> DataFrame:
        """Endpoints in ``(after, until]``; folders of other months aren't read."""
        points = self.spark.read.schema(f"person_id long, at timestamp_ntz, delta long, {MONTH} int").parquet(f"{self.root}/endpoints")
        end = F.lit(until).cast("timestamp_ntz")
        points = points.where((F.col(MONTH) <= _month(end)) & (F.col("at") <= end))
        if after is not None:
            start = F.lit(after).cast("timestamp_ntz")
            points = points.where((F.col(MONTH) >= _month(start)) & (F.col("at") > start))
        return points

    def advance(self, until: str) -> DataFrame:
        """The state at a later (or the same) time: ``(person_id, open)`` of people with an open suspension."""
        if self.at is not None and until < self.at:
            raise ValueError(f"{until} lies before {self.at}")
        moved = self.endpoints(self.at, until).groupBy(F.col("person_id").alias("p")).agg(F.sum("delta").alias("delta"))
        both = self.open.join(moved, self.open["person_id"] == moved["p"], "full_outer")
        now = both.select(F.coalesce("person_id", "p").alias("person_id"), F.coalesce("open", F.lit(0)).alias("was"),
                          (F.coalesce("open", F.lit(0)) + F.coalesce("delta", F.lit(0))).alias("open"))
        now = written(self.spark, now, "open_suspensions")
        self.changed = now.where("(was > 0) != (open > 0)").select("person_id", (F.col("open") > 0).alias("suspended"))
        self.at, self.open = until, now.where("open > 0").select("person_id", "open")
        return self.open
