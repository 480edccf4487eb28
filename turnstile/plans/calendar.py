"""Period and bucket keys: the period algebra over data-derived as-of dates,
bucket breakdowns over whole tables, and many requests served in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.buckets import bucket
from turnstile.functions.periods import RELATIVE_CODES, period_label, resolve_requests
from turnstile.operators import cube
from turnstile.operators.joins import range_join


def period_bounds_grid(b: Binding) -> DataFrame:
    """PER1-PER12, PER15: every distinct visit date as ``as_of`` x every
    relative code, plus that date's own day and month codes."""
    dates = b.visits().select(F.col("timestamp").alias("as_of")).distinct()
    codes = [F.lit(c) for c in RELATIVE_CODES] + [
        F.date_format("as_of", "M/d/yyyy"),
        F.concat(F.lit("YYYYMM"), F.date_format("as_of", "yyyyMM")),
    ]
    req = dates.select("as_of", F.explode(F.array(*codes)).alias("code"))
    return (resolve_requests(req, "code", "as_of", F.lit(b.inception))
            .select("as_of", "code", "start", "end", "bucket"))


def clock_codes(b: Binding) -> DataFrame:
    """``(as_of, code)``: every day of the event visits at a time of day of its own, off midnight, x every code."""
    day = F.to_date("timestamp")
    days = b.event_visits().select(day.alias("day")).where(F.col("day").isNotNull()).distinct()
    seconds = F.pmod(F.unix_date("day") * 7919, F.lit(86399)) + 1
    as_of = F.timestamp_add("SECOND", seconds, F.col("day").cast("timestamp_ntz"))
    codes = [F.lit(c) for c in RELATIVE_CODES] + [F.date_format("day", "M/d/yyyy"), F.concat(F.lit("YYYYMM"), F.date_format("day", "yyyyMM"))]
    return days.select(as_of.alias("as_of"), F.explode(F.array(*codes)).alias("code"))


def clock_figures(b: Binding) -> DataFrame:
    """PER6-8, PER10 and JN14 off midnight: events as visits, in periods that end at any second of a day, so days are
    partial at their ends.  ``(as_of, code, start, end, visits, clients)``."""
    grid = resolve_requests(clock_codes(b), "code", "as_of", F.lit(b.inception)).select("as_of", "code", "start", "end")
    figures = cube.period_figures(b.event_visits().select("person_id", "timestamp"), grid.select("start", "end"))
    return (grid.join(figures, ["start", "end"], "left")
            .select("as_of", "code", "start", "end", F.coalesce("visits", F.lit(0)).alias("visits"), F.coalesce("clients", F.lit(0)).alias("clients")))


def period_labels(b: Binding) -> DataFrame:
    """PER14: friendly label of every code the grid resolves."""
    return period_bounds_grid(b).select("code", period_label(F.col("code")).alias("label")).distinct()


def bucket_counts(b: Binding, fmt: str, source: str = "visits") -> DataFrame:
    """BKT1-5 + AG1: visits per bucket over the whole visit table."""
    v = b.visits() if source == "visits" else b.event_visits()
    return (v.groupBy(bucket(F.col("timestamp"), fmt).alias("period"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("visits")))


# The literal request list of the batch key (one of each kind
# plus one invalid code, which goes to the reject side).
SAMPLE_REQUESTS = [(i + 1, c) for i, c in enumerate(RELATIVE_CODES)] + [
    (11, "3/15/2000"), (12, "YYYYMM199902"), (13, "SOON")]


def requests_frame(b: Binding, requests=SAMPLE_REQUESTS) -> DataFrame:
    df = b.spark.createDataFrame(requests, "request_id long, interval string")
    return df.withColumn("as_of", F.lit(b.as_of_for("visits")).cast("timestamp_ntz"))


def resolve(b: Binding, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) requests with resolved bounds (PER13 in batch)."""
    r = resolve_requests(requests, "interval", "as_of", F.lit(b.inception))
    return r.where(F.col("start").isNotNull()), r.where(F.col("start").isNull())


def requests_x_periods(b: Binding, requests: DataFrame | None = None) -> DataFrame:
    """JN14: all pending requests served in one job: per request, visits and
    distinct people in its own period.  Each different period meets the visits
    once (a range join as a day equi-join), however many requests ask for it."""
    ok, _ = resolve(b, requests_frame(b) if requests is None else requests)
    ok = ok.select("request_id", "interval", "start", "end")
    figures = period_figures(b, ok.select("start", "end").distinct())
    return (ok.join(figures, ["start", "end"], "left")
            .select("request_id", "interval", "start", "end",
                    F.coalesce("visits", F.lit(0)).cast("bigint").alias("visits"),
                    F.coalesce("clients", F.lit(0)).cast("bigint").alias("clients")))


def period_figures(b: Binding, periods: DataFrame) -> DataFrame:
    """(start, end, visits, clients) of each of the different ``periods``."""
    return (range_join(b.visits(), periods).groupBy("start", "end")
            .agg(F.count(F.lit(1)).alias("visits"), F.count_distinct("person_id").alias("clients")))


def grid_figures(b: Binding) -> DataFrame:
    """JN14 at full size: every distinct visit date as ``as_of`` x every code, with the visits and distinct people of its
    period, in one plan whose work does not depend on how long the periods are (dyadic nodes, ``operators/cube.py``)."""
    grid = period_bounds_grid(b)
    figures = cube.period_figures(b.visits(), grid.select("start", "end"))
    return (grid.join(figures, ["start", "end"], "left")
            .select("as_of", "code", "start", "end", F.coalesce("visits", F.lit(0)).alias("visits"), F.coalesce("clients", F.lit(0)).alias("clients")))


def cube_period_clients(b: Binding) -> DataFrame:
    """AG2 from stored nodes alone: distinct people of every different period of the grid.  The cube gets all days but
    the last in one batch, and the last day appended as another."""
    from turnstile.session import scratch_path

    visits = b.visits().select("person_id", "timestamp")
    last = visits.agg(F.max(F.to_date("timestamp"))).scalar()
    stored = cube.DayCube(b.spark, scratch_path(b.spark, "day_cube"))
    stored.append(visits.where(F.to_date("timestamp") < last), "history")
    stored.append(visits.where(F.to_date("timestamp") >= last), "last-day")
    return stored.figures(period_bounds_grid(b).select("start", "end"))


def cube_category_clients(b: Binding, kind: str = "gender") -> DataFrame:
    """AG3 from stored nodes: visits and distinct people of each category in every prior month, quarter and year and every
    given month of the grid."""
    from turnstile.session import scratch_path

    labels = b.person_label(kind).select(F.col("idperson").alias("person_id"), F.col("label").alias("response"))
    visits = b.visits().select("person_id", "timestamp").join(labels, "person_id")
    stored = cube.DayCube(b.spark, scratch_path(b.spark, "category_cube"), dims=("response",))
    stored.append(visits, "all")
    periods = period_bounds_grid(b).where(F.col("code").isin("PM", "PQ", "PY") | F.col("code").startswith("YYYYMM"))
    return stored.figures(periods.select("start", "end"))
