"""Join helpers: broadcast of sides of a specified size and an equi-join form of range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, specified_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` if its schema's specification fixes its number of rows
    (``nation`` has 25 at every scale).  All else is left to Spark's own checks
    of bytes: the planner broadcasts a side whose estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans a shuffle join
    once a side is measured; beyond that it stays a sort-merge join with AQE
    skew splitting."""
    return df if specified_rows is None else F.broadcast(df)


def expand_days(ranges: DataFrame, start: str = "start", end: str = "end", day: str = "day") -> DataFrame:
    """One row per calendar day touched by ``[start, end]``."""
    return ranges.withColumn(
        day, F.explode(F.sequence(F.to_date(F.col(start)), F.to_date(F.col(end)), F.expr("INTERVAL 1 DAY"))))


def range_join(facts: DataFrame, ranges: DataFrame, ts: str = "timestamp",
               start: str = "start", end: str = "end") -> DataFrame:
    """facts ⋈ ranges on ``ts BETWEEN start AND end`` as an equi-join on the
    calendar day plus an exact residual filter (no nested-loop join).

    Spark's size checks decide whether the day-expanded ranges are broadcast; a
    shuffle join on the day has AQE split hot days.  A fact comes once for each
    range that holds it, so callers give distinct ranges.
    """
    r = expand_days(ranges, start, end, "_day")
    f = facts.withColumn("_fday", F.to_date(F.col(ts)))
    return (f.join(r, f["_fday"] == r["_day"])
            .where(F.col(ts).between(F.col(start), F.col(end)))
            .drop("_fday", "_day"))
