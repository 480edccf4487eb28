"""Summary (RP18), Outline (RP19), the population bundle (RP20) and its
sink (SNK1/SNK2): tabs become output directories plus a manifest table."""

from __future__ import annotations

import copy
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.plans import facts
from turnstile.plans import population as pop
from turnstile.session import written
from turnstile.sources import files
from turnstile.sources.tables import read_if_there


@dataclass(frozen=True)
class Tab:
    ordinal: int
    name: str
    description: str
    df: DataFrame


def _section(df: DataFrame, section: int, name, count: str, order) -> DataFrame:
    """One Summary section; ``order`` = (numeric asc, text asc, text desc)."""
    o0, o1, o2 = order
    return df.select(*[c for c in ("interval",) if c in df.columns], F.lit(section).alias("section"), name.alias("name"),
                     F.col(count).cast("bigint").alias("count"),
                     o0.cast("double").alias("_o0"), o1.cast("string").alias("_o1"),
                     o2.cast("string").alias("_o2"))


def _lab(c: str):
    return F.coalesce(F.col(c), F.lit("Unknown"))   # Q20: a NULL label never breaks the text


def summary(b: Binding, code: str) -> DataFrame:
    """RP18: every period total as (section, name, count), sections in the
    reference's order: clients, services, housing, city, gender, ethnicity,
    status.  Rows within a section keep each report's own order."""
    parts = [
        _section(pop.distinct_clients_total(b, code), 1, F.lit("Total distinct clients in report period"),
                 "clients", [F.lit(0), F.lit(""), F.lit("")]),
        _section(pop.services_total(b, code), 2, F.concat(_lab("servicename"), F.lit(" services delivered.")),
                 "total", [-F.col("total"), F.col("servicename"), F.lit("")]),
        _section(pop.housing_total(b, code), 3, F.concat(F.lit(" Days spent in "), _lab("hresponse")),
                 "total", [F.lit(0), F.col("hresponse"), F.lit("")]),
        _section(pop.city_total(b, code), 4, F.concat(F.lit(" Nights spent in "), _lab("cresponse")),
                 "total", [-F.col("total"), F.col("cresponse"), F.lit("")]),
        _section(pop.category_total(b, code, "gender"), 5, F.concat(F.lit("Gender -"), _lab("response")),
                 "total", [F.lit(0), F.col("response"), F.lit("")]),
        _section(pop.category_total(b, code, "ethnicity"), 6, F.concat(F.lit("Ethnicity -"), _lab("response")),
                 "total", [F.lit(0), F.col("response"), F.lit("")]),
        _section(pop.status_total(b, code), 7, F.col("name"), "total",
                 [F.lit(0), F.lit(""), F.coalesce(F.col("response"), F.lit("~"))]),
    ]
    u = reduce(DataFrame.unionByName, parts)
    keys = [c for c in ("interval",) if c in u.columns]
    return u.orderBy(*keys, "section", "_o0", "_o1", F.desc("_o2")).drop("_o0", "_o1", "_o2")


# Tab names and descriptions of the population bundle.
POPULATION_TABS = [
    ("Outline", "tab names and descriptions"),
    ("Summary", "summary totals for the report period"),
    ("Distinct Clients", "a count of individuals served by sub-period within the period."),
    ("Services", "breakdown by service type and sub-period within the period."),
    ("Housing", "breakdown by housing conditions and sub-period within the period."),
    ("Housing by City", "breakdown by city and sub-period within the period."),
    ("Unsheltered_by_Name", "clients reporting unsheltered housing in the period."),
    ("Incarcerations", "clients reporting incarceration in the report period."),
    ("Gender", "breakdown by gender and sub-period within the period."),
    ("Ethnicity", "breakdown by ethnicity and sub-period within the period."),
    ("Veterans", "breakdown by veteran status and sub-period within the period."),
    ("New Clients", "a list of clients with first visit occurring in the report period."),
]


def outline(spark: SparkSession, tabs=POPULATION_TABS) -> DataFrame:
    """RP19, derived from the bundle's own tab list (Q19)."""
    return spark.createDataFrame([(t, d) for t, d in tabs], "`Report Tab` string, Description string")


def _outline(b: Binding, code: str | DataFrame, tabs) -> DataFrame:
    """The outline, once for each code of a frame of them."""
    if not isinstance(code, DataFrame):
        return outline(b.spark, tabs)
    rows = F.array(*[F.struct(F.lit(t).alias("Report Tab"), F.lit(d).alias("Description")) for t, d in tabs])
    return facts.period(b, code).codes().select("interval", F.explode(rows).alias("r")).select("interval", "r.*")


def narrowed(b: Binding, code: str | DataFrame) -> Binding:
    """The binding with the facts of the period (or periods) of ``code`` written once: visits, delivered services and
    answers to the report prompts.  Every tab and the Summary read those, so each fact table is scanned once for a bundle
    however many tabs use it.  ``whole`` is the binding itself, for what looks beyond the period."""
    p, answers = facts.period(b, code), facts.period(b, code, "survey")
    out = copy.copy(b)
    out.whole = b
    visits = written(b.spark, facts.visits_in(b, p), "bundle_visits")
    out.visits = lambda: visits
    free = b.free_services().select(F.col("idservice").alias("_free"))

    def services() -> DataFrame:
        rows = facts.service_fact(out, p)
        return written(b.spark, rows.join(free, rows.service_id == free["_free"], "left_semi"), "bundle_services")

    def survey() -> DataFrame:
        rows = facts.in_period(b.survey(), answers).where(F.col("prompt_id").isin(sorted(b.prompts.values())))
        return written(b.spark, rows, "bundle_answers")

    rows, said = _at_once(b.spark, [services, survey])
    out.service_rows, out.survey = (lambda: rows), (lambda: said)
    return out


def population_bundle(b: Binding, code: str | DataFrame) -> list[Tab]:
    """RP20: the 12 tabs in order; each is a lazy DataFrame.  ``code`` may be a
    frame of codes (``interval``); every tab then has the code as a key."""
    frames = {
        "Outline": _outline(b, code, POPULATION_TABS),
        "Summary": summary(b, code),
        "Distinct Clients": pop.distinct_clients_by_period(b, code),
        "Services": pop.services_pivot(b, code),
        "Housing": pop.housing_pivot(b, code),
        "Housing by City": pop.city_pivot(b, code),
        "Unsheltered_by_Name": pop.flagged_people(b, code),
        "Incarcerations": pop.reported_people(b, code),
        "Gender": pop.category_pivot(b, code, "gender"),
        "Ethnicity": pop.category_pivot(b, code, "ethnicity"),
        "Veterans": pop.status_pivot(b, code),
        "New Clients": pop.new_people(b, code),
    }
    return [Tab(i, t, d, frames[t]) for i, (t, d) in enumerate(POPULATION_TABS)]


def manifest(tabs: list[Tab]) -> DataFrame:
    """(ordinal, tab, description, rows) for every tab, as ONE plan: the row
    counts are aggregations unioned together, not a driver loop of actions."""
    parts = [t.df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
             .select(F.lit(t.ordinal).alias("ordinal"), F.lit(t.name).alias("tab"),
                     F.lit(t.description).alias("description"), "rows")
             for t in tabs]
    return reduce(DataFrame.unionByName, parts)


def run_stamp(at: datetime) -> str:
    """``yyyy-MM-dd_HHmmss`` of an explicit time."""
    return f"{at:%Y-%m-%d_%H%M%S}"


def report_name(code: str, at: datetime) -> str:
    """SNK2: ``<code>-<yyyy-MM-dd_HHmmss>``, with the slashes of a day code as dashes."""
    return f"{code.replace('/', '-')}-{run_stamp(at)}"


def tab_folder(ordinal: int, name: str) -> str:
    return f"{ordinal:02d}_{name.replace(' ', '_')}"


def _at_once(spark: SparkSession, jobs: list) -> list:
    """Runs independent writes side by side: small ones wait for each other's latency otherwise."""
    with ThreadPoolExecutor(max_workers=min(6, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]        # the first failure is raised


MANIFEST = "report string, run_ts string, ordinal int, tab string, path string, rows long"


def write_bundle(tabs: list[Tab], base: str, report: str, run_ts: str, fmt: str = "parquet") -> DataFrame:
    """SNK1: the tabs and the manifest of one run, which appear whole or not at all.

    Each attempt writes its tabs to ``base/version=V/report=R/run_ts=T/tab=NN_name``; once all are there, one rename puts a
    pointer with the manifest in place.  Readers go through :func:`read_manifest` and :func:`read_bundle`, so a failed or
    running attempt leaves them the bundle before it.  Writing the same (report, run_ts) again moves its pointer."""
    spark = tabs[0].df.sparkSession
    root = f"{base}/version={uuid.uuid4().hex}/report={report}/run_ts={run_ts}"

    def write(t: Tab) -> tuple:
        path = f"{root}/tab={tab_folder(t.ordinal, t.name)}"
        t.df.write.mode("errorifexists").format(fmt).save(path)
        return report, run_ts, t.ordinal, t.name, path

    there = _at_once(spark, [partial(write, t) for t in tabs])
    # row counts from the written files (footer metadata), not by recomputing the tabs
    counts = reduce(DataFrame.unionByName, [
        spark.read.format(fmt).load(path).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        .select(F.lit(ordinal).alias("ordinal"), "rows")
        for _, _, ordinal, _, path in there])
    rows = {r.ordinal: r.rows for r in counts.collect()}
    entries = [[*x, rows[x[2]]] for x in sorted(there, key=lambda x: x[2])]
    files.write_text(spark, _pointer(base, report, run_ts), json.dumps({"format": fmt, "tabs": entries}), replace=True)
    return read_manifest(spark, base, report, run_ts)


def _pointer(base: str, report: str, run_ts: str) -> str:
    return f"{base}/_current/{report},{run_ts}.json"


def _resolved(spark: SparkSession, base: str, report: str, run_ts: str) -> dict:
    text = files.read_text(spark, _pointer(base, report, run_ts))
    if text is None:
        raise FileNotFoundError(f"no bundle {report} of {run_ts} under {base}")
    return json.loads(text)


def read_manifest(spark: SparkSession, base: str, report: str, run_ts: str) -> DataFrame:
    """What the current bundle holds: a row per tab."""
    return spark.createDataFrame([tuple(x) for x in _resolved(spark, base, report, run_ts)["tabs"]], MANIFEST).orderBy("ordinal")


def read_bundle(spark: SparkSession, base: str, report: str, run_ts: str) -> dict[str, DataFrame]:
    """The tabs of the current bundle, in order."""
    found = _resolved(spark, base, report, run_ts)
    return {name: spark.read.format(found["format"]).load(path) for _, _, _, name, path, _ in found["tabs"]}


def write_bundles(tabs: list[Tab], root: str, at: datetime) -> DataFrame:
    """Bundles of many codes: every tab has an ``interval`` and is written once, to
    ``root/report=R/run_ts=T/tab=NN_name`` of each code's report; the number of jobs doesn't depend on the codes.

    Returns ``(interval, report, ordinal, tab, path, rows)`` for each code and tab.  A tab without rows has no folder."""
    spark = tabs[0].df.sparkSession
    stamp = run_stamp(at)
    report = F.concat(F.regexp_replace("interval", "/", "-"), F.lit(f"-{stamp}"))

    def write(t: Tab) -> DataFrame:
        rows = t.df.withColumn("report", report).withColumn("run_ts", F.lit(stamp)).withColumn("tab", F.lit(tab_folder(t.ordinal, t.name)))
        # each job has a staging folder of its own and replaces only its own partitions
        (rows.drop("interval").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("report", "run_ts", "tab").parquet(root))
        found = [n for n in files.names(spark, root) if n.startswith("report=")]
        if not found:
            return spark.createDataFrame([], "report string, n long, ordinal int")
        some = read_if_there(spark, f"{root}/report=*/run_ts=*/tab={tab_folder(t.ordinal, t.name)}", root)
        if some is None:
            return spark.createDataFrame([], "report string, n long, ordinal int")
        return some.groupBy(F.col("report").cast("string").alias("report")).agg(F.count(F.lit(1)).alias("n")).withColumn("ordinal", F.lit(t.ordinal))

    counts = reduce(DataFrame.unionByName, _at_once(spark, [partial(write, t) for t in tabs]))
    asked = tabs[0].df.select("interval").distinct().withColumn("report", report)
    each = F.array(*[F.struct(F.lit(t.ordinal).alias("ordinal"), F.lit(t.name).alias("tab"), F.lit(tab_folder(t.ordinal, t.name)).alias("folder")) for t in tabs])
    rows = asked.select("interval", "report", F.explode(each).alias("t")).select("interval", "report", "t.*")
    return (rows.join(counts, ["report", "ordinal"], "left")
            .select("interval", "report", "ordinal", "tab",
                    F.concat(F.lit(f"{root}/report="), "report", F.lit(f"/run_ts={stamp}/tab="), "folder").alias("path"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("rows")))


# Tab names and descriptions of the person bundle (RP31).
PERSON_TABS = [
    ("Outline", "tab names and descriptions"),
    ("Summary", "visit, service and housing totals"),
    ("Client Information", "client information"),
    ("Visit Counts Sub-period", "number of visits by sub-period"),
    ("Services Delivered Sub-period", "services delivered by sub-period"),
    ("Housing by Sub-Period", "housing by sub-period"),
    ("Suspensions", "suspension history"),
    ("Incarcerations", "incarceration history"),
]


def person_bundle(b: Binding, code: str | DataFrame, persons=None) -> list[Tab]:
    """RP31: the person bundle in batch form; every tab is keyed by
    ``idperson`` and covers all requested persons (None = everyone).  For a
    frame of codes, ``persons`` is one of ``(interval, idperson)``."""
    from turnstile.plans import person as per

    frames = {
        "Outline": _outline(b, code, PERSON_TABS),
        "Summary": per.person_summary(b, code, persons),
        "Client Information": per.person_header(getattr(b, "whole", b), persons),
        "Visit Counts Sub-period": per.person_visits_by_period(b, code, persons),
        "Services Delivered Sub-period": per.person_services_pivot(b, code, persons),
        "Housing by Sub-Period": per.person_housing_pivot(b, code, persons),
        "Suspensions": per.person_suspensions(b, code, persons),
        "Incarcerations": per.person_reported(b, code, persons),
    }
    return [Tab(i, t, d, frames[t]) for i, (t, d) in enumerate(PERSON_TABS)]


# Tab names of the visit-ranking bundle (its Summary tab is
# always empty in the reference and is dropped, Q23).
RANKING_TABS = [
    ("Outline", "tab names and descriptions"),
    ("Clients By Total Visits", "clients sorted by total visits"),
]


def ranking_bundle(b: Binding, code: str = "SI") -> list[Tab]:
    """The visit-ranking report: Outline + RP21."""
    frames = {"Outline": outline(b.spark, RANKING_TABS), "Clients By Total Visits": pop.visit_ranking(b, code)}
    return [Tab(i, t, d, frames[t]) for i, (t, d) in enumerate(RANKING_TABS)]
