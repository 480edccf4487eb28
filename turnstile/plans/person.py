"""Person reports (RP22-RP32) in batch form.

The reference runs one process per person.  Here every report takes a frame
of requested ``idperson`` values (``None`` = every person) and answers all of
them in one job: the request list is a semi join (broadcast when its size is
proven small), and per-person results are keyed by ``idperson``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.columns import ETHNICITY_LABELS, GENDER_LABELS, LANGUAGE_LABELS, VETERAN_LABELS
from turnstile.functions.columns import attribute_value, code_label, days_elapsed, seconds_between, us_date
from turnstile.operators import breakdown as bd
from turnstile.operators.joins import bounded_broadcast
from turnstile.plans import facts


def _persons(b: Binding, persons) -> DataFrame:
    """The people asked for; with their ``interval`` where each has periods of their own."""
    p = b.person()
    if isinstance(persons, DataFrame) and "interval" in persons.columns:
        return p.join(persons.select("idperson", "interval").distinct(), "idperson")
    return p if persons is None else facts.semi_persons(p, persons, "idperson")


def _keys(who: DataFrame) -> list[str]:
    return [c for c in ("interval",) if c in who.columns]


def _everyone(who: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``who`` with what was found for each, by ``person_id`` (and interval)."""
    on = who["idperson"] == found["person_id"]
    for k in keys:
        on = on & (who[k] == found[k])
    return who.join(found, on, "left").select(*[who[k] for k in keys], who["idperson"], *[found[c] for c in found.columns if c not in (*keys, "person_id")])


def person_header(b: Binding, persons: DataFrame | None = None) -> DataFrame:
    """RP22 + FN20: name, id, labels, first/last visit with days ago, credits
    as ordered (Attribute, Value) rows per person.  A person with no visit
    gets NULL visit values (Q21)."""
    now = F.lit(b.as_of_for("visits")).cast("timestamp_ntz")
    v = facts.semi_persons(b.visits(), persons)
    span = v.groupBy("person_id").agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    p = _persons(b, persons)
    lab = b.person_labels_text()
    j = (p.join(lab, "idperson", "left")
         .join(span, p.idperson == span.person_id, "left"))

    def visit_text(c):
        return F.concat(us_date(c), F.lit(" ("), days_elapsed(c, now).cast("string"), F.lit(" days ago)"))

    attrs = [
        ("Name", F.concat_ws(" ", "firstname", "lastname")),
        ("Client ID", F.col("idperson")),
        ("Ethnicity", F.col("ethnicity")),
        ("Gender", F.col("gender")),
        ("Language", F.col("language")),
        ("Veteran", F.col("veteran")),
        ("First visit", visit_text(F.col("first"))),
        ("Last visit", visit_text(F.col("last"))),
        ("Credits", F.col("credits")),
    ]
    return attribute_value(j, [*_keys(p), "idperson"], attrs)


def person_visits(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP23: per person, earliest/latest visit and visits in the
    period (the visit id is their key); persons without visits get 0 and NULLs."""
    p = facts.period(b, code)
    agg = (facts.visits_in(b, p, persons).groupBy(*p.keys, "person_id")
           .agg(F.min("timestamp").alias("earliest_visit"), F.max("timestamp").alias("latest_visit"),
                F.count(F.lit(1)).alias("total_visits")))
    who = _persons(b, persons).select(*p.keys, "idperson")
    return (_everyone(who, agg, p.keys)
            .select(*p.keys, "idperson", "earliest_visit", "latest_visit",
                    F.coalesce("total_visits", F.lit(0)).cast("bigint").alias("total_visits")))


def person_visits_by_period(b: Binding, code: str, persons: DataFrame | None = None,
                            fmt: str | None = None) -> DataFrame:
    """RP24: distinct visits per person and sub-period (JN8 as a semi join)."""
    p = facts.period(b, code)
    v = facts.with_bucket(facts.visits_in(b, p, persons), p, fmt)
    v = facts.known_persons(b, v)
    return (v.groupBy(*p.keys, F.col("person_id").alias("idperson"), "period")
            .agg(F.count(F.lit(1)).alias("visits")))


def person_services(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP25: services per person and category."""
    p = facts.period(b, code)
    out = bd.rows_by_label(facts.known_persons(b, facts.service_fact(b, p, persons)), "service_id", facts.service_dim(b),
                           group=[*p.keys, "person_id"], out="total")
    return out.select(*p.keys, F.col("person_id").alias("idperson"), F.col("label").alias("servicename"), "total")


def person_services_pivot(b: Binding, code: str, persons: DataFrame | None = None,
                          fmt: str | None = None, columns: str = "dimension") -> DataFrame:
    """RP26: per person and sub-period, one column per category."""
    p = facts.period(b, code)
    dim = facts.service_dim(b)
    long = bd.rows_by_label(facts.with_bucket(facts.known_persons(b, facts.service_fact(b, p, persons)), p, fmt), "service_id", dim,
                            group=[*p.keys, "person_id", "period"], out="total")
    wide = bd.pivot(long, [*p.keys, "person_id", "period"], "label", "total", facts.pivot_values(dim, columns))
    return wide.withColumnRenamed("person_id", "idperson")


def person_housing(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP27: housing answers per person."""
    p = facts.period(b, code, "survey")
    out = bd.rows_by_label(facts.known_persons(b, facts.survey_in(b, p, "housing", persons=persons)), "object_id",
                           facts.response_dim(b, "housing"), group=[*p.keys, "person_id"], out="nights_spent")
    return out.select(*p.keys, F.col("person_id").alias("idperson"), F.col("label").alias("housing_type"),
                      "nights_spent")


def person_housing_pivot(b: Binding, code: str, persons: DataFrame | None = None,
                         fmt: str | None = None, columns: str = "dimension") -> DataFrame:
    """RP28: publishes the housing frame (Q6)."""
    p = facts.period(b, code, "survey")
    dim = facts.response_dim(b, "housing")
    long = bd.rows_by_label(facts.with_bucket(facts.known_persons(b, facts.survey_in(b, p, "housing", persons=persons)), p, fmt),
                            "object_id", dim, group=[*p.keys, "person_id", "period"], out="total")
    wide = bd.pivot(long, [*p.keys, "person_id", "period"], "label", "total", facts.pivot_values(dim, columns))
    return wide.withColumnRenamed("person_id", "idperson")


def person_suspensions(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP29: suspensions starting in the period with length and reason."""
    p = facts.period(b, code)
    s = p.of(b.suspensions(), "starttime") if p.keys else b.suspensions().where(p.contains("starttime"))
    s = facts.known_persons(b, facts.semi_persons(s, persons))
    r = bounded_broadcast(b.reasons().select(F.col("id").alias("_rid"), F.col("name").alias("reason")),
                          b.dimension_rows.get("reasons"))
    j = s.join(r, s.reason_id == r["_rid"])
    return j.select(*p.keys, F.col("person_id").alias("idperson"),
                    F.col("starttime").alias("suspension_starttime"),
                    days_elapsed("starttime", "endtime").alias("days"),
                    seconds_between("starttime", "endtime").alias("seconds"),
                    "reason")


def person_reported(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP30: distinct visits with a 'yes' incarceration answer, per person."""
    p = facts.period(b, code, "survey")
    s = facts.survey_in(b, p, "incarceration", b.incarcerated_object, persons)
    agg = s.groupBy(*p.keys, "person_id").agg(F.count_distinct("idsnapshot").cast("bigint").alias("incarcerations"))
    who = _persons(b, persons).select(*p.keys, "idperson")
    return (_everyone(who, agg, p.keys)
            .select(*p.keys, "idperson", F.coalesce("incarcerations", F.lit(0)).cast("bigint").alias("incarcerations")))


def person_summary(b: Binding, code: str, persons: DataFrame | None = None) -> DataFrame:
    """RP31 Summary tab per person: visits, services, housing totals."""
    keys = facts.period(b, code).keys
    visits = person_visits(b, code, persons).select(
        *keys, "idperson", F.lit(1).alias("section"), F.lit("Total client visits in report period").alias("name"),
        F.col("total_visits").alias("count"))
    services = person_services(b, code, persons).select(
        *keys, "idperson", F.lit(2).alias("section"),
        F.concat(F.coalesce("servicename", F.lit("Unknown")), F.lit(" services delivered.")).alias("name"),
        F.col("total").alias("count"))
    housing = person_housing(b, code, persons).select(
        *keys, "idperson", F.lit(3).alias("section"),
        F.concat(F.lit(" Days spent in "), F.coalesce("housing_type", F.lit("Unknown"))).alias("name"),
        F.col("nights_spent").alias("count"))
    return reduce(DataFrame.unionByName, [visits, services, housing])


def person_profile(b: Binding, as_of: str | None = None, persons: DataFrame | None = None,
                   require_started: bool = False) -> DataFrame:
    """RP32: one row per person; the suspension flag is recomputed as of
    ``as_of`` (SUS1) and the offender column is a real column (Q9), NULL when
    the schema has none."""
    from turnstile.operators.suspensions import suspension_flags

    p = _persons(b, persons)
    lab = b.person_labels_text().select("idperson", "veteran")
    fs = b.first_seen()
    flags = suspension_flags(b, as_of or b.as_of_for("visits"), require_started).select(
        F.col("idperson").alias("_fid"), "iscurrentlysuspended")
    j = (p.join(lab, "idperson", "left").join(fs, "idperson", "left")
         .join(flags, p.idperson == flags["_fid"], "left"))
    return j.select("idperson", "firstname", "lastname", F.col("aliasname").alias("alias"),
                    "sexoffender", "veteran", "credits",
                    F.col("timelinestarttime").alias("timelinestart"),
                    F.col("iscurrentlysuspended").alias("currentlysuspended"))


def person_code_labels(b: Binding) -> DataFrame:
    """FN7: every person's numeric codes as the reference's labels; a code without a label is NULL (Q10)."""
    c = b.person_codes()
    return c.select("idperson", code_label("ethnicity_id", ETHNICITY_LABELS).alias("ethnicity"), code_label("gender_id", GENDER_LABELS).alias("gender"),
                    code_label("language_id", LANGUAGE_LABELS).alias("language"), code_label("veteran_id", VETERAN_LABELS).alias("veteran"))
