"""At-rest layout for the visit fact: month partitions plus a scan helper
that turns a period into a partition filter.

A closed-range filter on the timestamp prunes Parquet row groups, but only a
filter on the partition column lets the file index skip whole directories.
``write_visits_by_month`` stores a ``visit_month`` (yyyyMM integer) partition
column; ``prune_to_period`` adds ``visit_month BETWEEN ym(start) AND ym(end)``
next to the exact timestamp range, so both kinds of pruning apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions.periods import Period

PART_COL = "visit_month"


def month_key(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def write_visits_by_month(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "errorifexists") -> None:
    """Write a visit-like frame partitioned by month.  Rows are range-sorted by
    month and time before the write: each task writes few directories, and a
    month with many visits is split over many tasks."""
    (df.withColumn(PART_COL, month_key(ts))
     .repartitionByRange(PART_COL, ts)
     .write.mode(mode).partitionBy(PART_COL).parquet(path))


def read_visits_by_month(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def prune_to_period(df: DataFrame, p: Period, ts: str = "timestamp") -> DataFrame:
    """Exact period filter plus the implied partition filter."""
    return df.where(p.contains(ts) & F.col(PART_COL).between(month_key(p.start), month_key(p.end)))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: bool = True,
                   mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a catalog table bucketed (and sorted) on ``key``.

    Two tables bucketed on their join key into the same number of buckets
    join bucket-by-bucket with no exchange: e.g. ``orders`` by ``o_orderkey``
    and ``lineitem`` by ``l_orderkey`` make the request ⋈ visit join, the
    largest one in the service, suspension and feature plans, shuffle-free.
    """
    w = df.write.mode(mode).bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
