"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Period choices per key (driver binding; orders as-of 2000-05-15 12:00,
events as-of 2024-01-24 15:30, inception 1995-01-01) are fixed here and in
the matching oracle SQL.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstile.binding import DriverBinding
from turnstile.operators import clusters, features, linkage, suspensions
from turnstile.plans import bundle
from turnstile.plans import calendar as cal
from turnstile.plans import person as per
from turnstile.plans import population as pop

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered keys.
SUSPENSION_AS_OF = "2001-07-01 00:00:00"
GIVEN_CENTROIDS = [
    [0.2, 0.2, 0.2, 2.0, 300.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [0.6, 0.5, 0.5, 4.0, 500.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.0, 0.9, 0.8, 6.0, 900.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
]


_BINDINGS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _b(spark: SparkSession, sf_dir: str) -> DriverBinding:
    """One binding per (session, data directory); it keeps resolved periods,
    and nothing that is read from a table."""
    per_session = _BINDINGS.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = DriverBinding(spark, sf_dir)
    return per_session[sf_dir]


def _q(fn, *args, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_b(spark, sf_dir), *args, **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


POPULATION: dict[str, Query] = {
    "distinct_clients_total": _q(pop.distinct_clients_total, "SI"),
    "distinct_clients_by_period": _q(pop.distinct_clients_by_period, "PQ"),
    "services_total": _q(pop.services_total, "PY"),
    "services_pivot": _q(pop.services_pivot, "PY"),
    "services_by_period": _q(pop.services_by_period, "PY"),
    "housing_total": _q(pop.housing_total, "P90"),
    "housing_pivot": _q(pop.housing_pivot, "P90"),
    "housing_by_period": _q(pop.survey_by_period, "P90", "housing"),
    "city_total": _q(pop.city_total, "PW"),
    "city_pivot": _q(pop.city_pivot, "PW"),
    "flagged_people": _q(pop.flagged_people, "P90"),
    "reported_people": _q(pop.reported_people, "YTD"),
    "category_total": _q(pop.category_total, "PQ", "gender"),
    "category_pivot": _q(pop.category_pivot, "PQ", "gender"),
    "category_by_period": _q(pop.category_by_period, "PQ", "gender"),
    "category2_total": _q(pop.category_total, "PM", "ethnicity"),
    "category2_pivot": _q(pop.category_pivot, "PM", "ethnicity"),
    "status_total": _q(pop.status_total, "YTD"),
    "status_pivot": _q(pop.status_pivot, "YTD"),
    "total_and_breakdown": _q(pop.total_and_breakdown, "PQ", "gender"),
    "new_people": _q(pop.new_people, "PY"),
    "visit_ranking": _q(pop.visit_ranking, "SI"),
    "visit_topk": _q(pop.visit_topk, "SI", 10),
    "report_order": _q(pop.report_order),
}


CALENDAR: dict[str, Query] = {
    "period_bounds_grid": _q(cal.period_bounds_grid),
    "period_labels": _q(cal.period_labels),
    "bucket_month": _q(cal.bucket_counts, "YYYY-MM"),
    "bucket_day_dy": _q(cal.bucket_counts, "YYYY-MM/DD DY"),
    "bucket_day_ww": _q(cal.bucket_counts, "YYYY-MM/DD WW"),
    "bucket_month_ww": _q(cal.bucket_counts, "YYYY-MM WW"),
    "bucket_hour": _q(cal.bucket_counts, "HH24", "events"),
    "requests_x_periods": _q(cal.requests_x_periods),
    "grid_figures": _q(cal.grid_figures),
    "clock_figures": _q(cal.clock_figures),
    "cube_period_clients": _q(cal.cube_period_clients),
    "cube_category_clients": _q(cal.cube_category_clients, "gender"),
}

BUNDLE_CODE = "YTD"
PERSON_CODE = "YTD"


def _summary(spark, sf_dir):
    return bundle.summary(_b(spark, sf_dir), BUNDLE_CODE)


def _manifest(spark, sf_dir):
    return bundle.manifest(bundle.population_bundle(bundle.narrowed(_b(spark, sf_dir), BUNDLE_CODE), BUNDLE_CODE))


def _person_manifest(spark, sf_dir):
    return bundle.manifest(bundle.person_bundle(bundle.narrowed(_b(spark, sf_dir), PERSON_CODE), PERSON_CODE))


ASSEMBLY: dict[str, Query] = {
    "summary": _summary,
    "bundle_manifest": _manifest,
    "person_bundle_manifest": _person_manifest,
}

PERSON: dict[str, Query] = {
    "person_header": _q(per.person_header),
    "person_visits": _q(per.person_visits, PERSON_CODE),
    "person_visits_by_period": _q(per.person_visits_by_period, PERSON_CODE),
    "person_services": _q(per.person_services, PERSON_CODE),
    "person_services_pivot": _q(per.person_services_pivot, PERSON_CODE),
    "person_housing": _q(per.person_housing, PERSON_CODE),
    "person_housing_pivot": _q(per.person_housing_pivot, PERSON_CODE),
    "person_suspensions": _q(per.person_suspensions, PERSON_CODE),
    "person_reported": _q(per.person_reported, PERSON_CODE),
    "person_summary": _q(per.person_summary, PERSON_CODE),
    "person_profile": _q(per.person_profile, SUSPENSION_AS_OF),
    "person_code_labels": _q(per.person_code_labels),
}


def _near(spark, sf_dir):
    b = _b(spark, sf_dir)
    return linkage.near_duplicates(b.person(), 2, 2)


def _near_counts(spark, sf_dir):
    b = _b(spark, sf_dir)
    return linkage.near_duplicate_counts(b.person(), 2, 2)


def _classes(spark, sf_dir):
    return linkage.duplicate_classes(_b(spark, sf_dir).person(), 2, 2)


def _groups(spark, sf_dir):
    return linkage.duplicate_groups(_b(spark, sf_dir).person(), 2, 2)


def _exact(spark, sf_dir):
    return linkage.exact_duplicates(_b(spark, sf_dir).part_people())


def _flags(spark, sf_dir):
    return suspensions.suspension_flags(_b(spark, sf_dir), SUSPENSION_AS_OF)


def _features(spark, sf_dir):
    return features.feature_table(_b(spark, sf_dir), "SI", "survey")


def _assign(spark, sf_dir):
    return clusters.assign_nearest(_features(spark, sf_dir), GIVEN_CENTROIDS)


def _fit(spark, sf_dir):
    return clusters.fit_facts(_features(spark, sf_dir), k=3, seed=42)


def _centroids(spark, sf_dir):
    return clusters.update_step(_features(spark, sf_dir), GIVEN_CENTROIDS)


def _fea(fn):
    def run(spark, sf_dir):
        return fn(_b(spark, sf_dir), "SI", "survey")
    return run


def _served(spark, sf_dir):
    """ST1-ST3 end to end: lines derived from the app-user table, repeated and
    malformed ones among them, are dropped as files and drained by the stream."""
    from turnstile.session import scratch_path
    from turnstile.streaming import request_queue as rq

    b = _b(spark, sf_dir)
    root = scratch_path(spark, "request_stream")
    rq.request_lines(b).write.text(f"{root}/queue")
    rq.serve(spark, b, f"{root}/queue", f"{root}/out", f"{root}/checkpoint")
    return rq, f"{root}/out"


def _request_stream(spark, sf_dir):
    rq, out = _served(spark, sf_dir)
    # the request key holds the queue file path, so it is left out of the
    # registered result (everything else is deterministic)
    return rq.results(spark, out).select(*[c for c in rq.RESULT_COLUMNS if c != "request_key"])


def _request_rejects(spark, sf_dir):
    from pyspark.sql import functions as F

    rq, out = _served(spark, sf_dir)
    return rq.rejects(spark, out).select("type", "interval", F.col("_corrupt_record").alias("corrupt_record"))


def _request_reports(spark, sf_dir):
    """ST2/SNK1: one population request and one request for every person, the
    bundles they ask for written, and the manifest of what was written."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from turnstile.session import scratch_path
    from turnstile.streaming import request_queue as rq

    b = _b(spark, sf_dir)
    said = {"type": "string", "interval": "string", "appuser": "long", "client": "long", "idperson": "long",
            "_corrupt_record": "string", "source_file": "string"}
    none = {c: F.lit(None).cast(t).alias(c) for c, t in said.items()}
    code = F.lit(BUNDLE_CODE).alias("interval")
    whole = spark.range(1).select(*({**none, "type": F.lit("ALL").alias("type"), "interval": code}).values())
    each = b.person().select(*({**none, "type": F.lit("IND").alias("type"), "interval": code,
                                "client": F.col("idperson").alias("client")}).values())
    asked = rq.classify(whole.unionByName(each), b)
    manifest, _ = rq.write_reports(asked, b, scratch_path(spark, "reports"), datetime(2000, 5, 15, 12))
    return manifest.select("kind", "report", "ordinal", "tab", "rows")


def _published(spark, sf_dir):
    """SNK3/ST4: the person table with recomputed flags, published and read back."""
    from turnstile.session import scratch_path

    root = scratch_path(spark, "suspension_state")
    suspensions.refresh_suspension_flags(_b(spark, sf_dir), SUSPENSION_AS_OF, root)
    return suspensions.read_current(spark, root)


# Fixed parameters: the times of the two publishes, and those that the walk visits.
PUBLISH_TIMES = ("1998-07-01 00:00:00", "2001-07-01 00:00:00")
WALK_TIMES = ["1995-06-01 00:00:00", "1997-03-15 12:00:00", "1997-03-16 00:00:00", "1999-12-31 23:59:59", "2001-07-01 00:00:00"]


def _published_twice(spark, sf_dir):
    from turnstile.session import scratch_path

    return suspensions.published_twice(_b(spark, sf_dir), scratch_path(spark, "person_store"), *PUBLISH_TIMES)


def _walk(started):
    def run(spark, sf_dir):
        from turnstile.session import scratch_path

        return suspensions.walked(_b(spark, sf_dir), scratch_path(spark, "endpoints"), WALK_TIMES, started)
    return run


LINKAGE_AND_STATE: dict[str, Query] = {
    "request_stream": _request_stream,
    "request_rejects": _request_rejects,
    "request_reports": _request_reports,
    "suspension_state": _published,
    "suspension_publishes": _published_twice,
    "suspension_walk": _walk(False),
    "suspension_walk_started": _walk(True),
    "near_duplicates": _near,
    "near_duplicate_counts": _near_counts,
    "duplicate_classes": _classes,
    "duplicate_groups": _groups,
    "exact_duplicates": _exact,
    "suspension_flags": _flags,
    "feature_people": _fea(features.seen_people),
    "feature_visits": _fea(features.visits_per_person),
    "feature_services": _fea(features.services_per_person),
    "feature_housing": _fea(features.housing_per_person),
    "feature_table": _features,
    "cluster_assign": _assign,
    "cluster_fit": _fit,
    "cluster_centroids": _centroids,
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (CALENDAR, POPULATION, ASSEMBLY, PERSON, LINKAGE_AND_STATE):
        out.update(part)
    return out
