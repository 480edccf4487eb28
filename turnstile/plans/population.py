"""Whole-population reports (RP1-RP21, AG13) as short DataFrame compositions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.columns import VETERAN_PIVOT_RENAME, veteran_summary_name
from turnstile.operators import breakdown as bd
from turnstile.operators.joins import bounded_broadcast
from turnstile.plans import facts

# ---------------------------------------------------------------- clients


def distinct_clients_total(b: Binding, code: str) -> DataFrame:
    """RP1: first and last visit time and distinct people in the period."""
    p = facts.period(b, code)
    found = facts.visits_in(b, p).groupBy(*p.keys).agg(
        F.min("timestamp").alias("start"), F.max("timestamp").alias("end"),
        F.count_distinct("person_id").cast("bigint").alias("clients"))
    if not p.keys:
        return found
    # a period without visits has a row, too
    return p.codes().join(found, "interval", "left").withColumn("clients", F.coalesce("clients", F.lit(0)).cast("bigint"))


def distinct_clients_by_period(b: Binding, code: str, fmt: str | None = None) -> DataFrame:
    """RP2/PV2: distinct people per sub-period (visit ⋈ person as existence)."""
    p = facts.period(b, code)
    v = facts.with_bucket(facts.visits_in(b, p), p, fmt).select(*p.keys, "period", "person_id").distinct()
    persons = b.person().select(F.col("idperson"))
    v = v.join(persons, v.person_id == persons.idperson, "left_semi")
    return (v.groupBy(*p.keys, "period").agg(F.count(F.lit(1)).cast("bigint").alias("clients"))
            .orderBy(*p.keys, "period"))


# --------------------------------------------------------------- services


def services_total(b: Binding, code: str) -> DataFrame:
    """RP3: services delivered by category, largest first."""
    p = facts.period(b, code)
    out = bd.rows_by_label(facts.service_fact(b, p), "service_id", facts.service_dim(b), group=p.keys, out="total")
    return out.select(*p.keys, F.col("label").alias("servicename"), "total").orderBy(*p.keys, F.desc("total"), "servicename")


def services_by_period(b: Binding, code: str, fmt: str | None = None) -> DataFrame:
    """RP4 in long form: (period, label, total), for any number of categories."""
    p = facts.period(b, code)
    return bd.rows_by_label(facts.with_bucket(facts.service_fact(b, p), p, fmt), "service_id",
                            facts.service_dim(b), group=[*p.keys, "period"], out="total")


def services_pivot(b: Binding, code: str, fmt: str | None = None, columns: str = "dimension") -> DataFrame:
    """RP4: sub-period x category, one column per category."""
    dim = facts.service_dim(b)
    long = services_by_period(b, code, fmt)
    return _by_period(long, "total", facts.pivot_values(dim, columns))


def _by_period(long: DataFrame, value: str, values: list | None, rename: dict | None = None) -> DataFrame:
    """Sub-periods down, labels across; one block per interval where there are many."""
    index = [c for c in ("interval", "period") if c in long.columns]
    return bd.pivot(long, index, "label", value, values, rename=rename).orderBy(*index)


# ----------------------------------------------------------- survey facts


def _survey_total(b, code, kind, label_name, total_name, order_by_total):
    p = facts.period(b, code, "survey")
    out = bd.rows_by_label(facts.survey_in(b, p, kind), "object_id", facts.response_dim(b, kind),
                           group=p.keys, out=total_name, dim_rows=facts.response_rows(b, kind))
    out = out.select(*p.keys, F.col("label").alias(label_name), total_name)
    return out.orderBy(*p.keys, F.desc(total_name), label_name) if order_by_total else out.orderBy(*p.keys, label_name)


def survey_by_period(b: Binding, code: str, kind: str, fmt: str | None = None) -> DataFrame:
    """RP6/RP8 in long form: (period, label, total), for any number of answers."""
    p = facts.period(b, code, "survey")
    return bd.rows_by_label(facts.with_bucket(facts.survey_in(b, p, kind), p, fmt), "object_id",
                            facts.response_dim(b, kind), group=[*p.keys, "period"], out="total",
                            dim_rows=facts.response_rows(b, kind))


def _survey_pivot(b, code, kind, fmt, columns):
    dim = facts.response_dim(b, kind)
    long = survey_by_period(b, code, kind, fmt)
    return _by_period(long, "total", facts.pivot_values(dim, columns))


def housing_total(b: Binding, code: str) -> DataFrame:
    """RP5: answers to the housing prompt by answer prefix."""
    return _survey_total(b, code, "housing", "hresponse", "total", order_by_total=False)


def housing_pivot(b: Binding, code: str, fmt: str | None = None, columns: str = "dimension") -> DataFrame:
    """RP6."""
    return _survey_pivot(b, code, "housing", fmt, columns)


def city_total(b: Binding, code: str) -> DataFrame:
    """RP7: nights by city, largest first."""
    return _survey_total(b, code, "city", "cresponse", "total", order_by_total=True)


def city_pivot(b: Binding, code: str, fmt: str | None = None, columns: str = "dimension") -> DataFrame:
    """RP8."""
    return _survey_pivot(b, code, "city", fmt, columns)


def flagged_people(b: Binding, code: str, min_nights: int = 1) -> DataFrame:
    """RP9: people answering the housing prompt with the 'unsheltered' answer
    (which must exist in the housing dimension), by night count."""
    p = facts.period(b, code, "survey")
    s = facts.survey_in(b, p, "housing", b.unsheltered_object)
    dim = bounded_broadcast(b.response("housing").select(F.col("id").alias("_hid")),
                            facts.response_rows(b, "housing"))
    s = s.join(dim, s.object_id == dim["_hid"], "left_semi")
    nights = (s.groupBy(*p.keys, "person_id").agg(F.count(F.lit(1)).cast("bigint").alias("unsheltered_nights"))
              .where(F.col("unsheltered_nights") >= min_nights))
    person = b.person()
    j = nights.join(person, nights.person_id == person.idperson)
    return (j.orderBy(*p.keys, F.desc("unsheltered_nights"), "idperson")
            .select(*p.keys, "firstname", "lastname", "aliasname", "unsheltered_nights"))


def reported_people(b: Binding, code: str) -> DataFrame:
    """RP10: distinct people answering 'yes' to the incarceration prompt."""
    p = facts.period(b, code, "survey")
    ids = facts.survey_in(b, p, "incarceration", b.incarcerated_object).select(*p.keys, "person_id").distinct()
    person = b.person()
    j = ids.join(person, ids.person_id == person.idperson)
    return j.select(*p.keys, "idperson", "firstname", "lastname").orderBy(*p.keys, "idperson")


# -------------------------------------------------------- person categories


def category_total(b: Binding, code: str, kind: str) -> DataFrame:
    """RP11/RP13: distinct people by a person category (gender, ethnicity)."""
    p = facts.period(b, code)
    out = bd.people_by_label(facts.visits_in(b, p), b.person_label(kind), group=p.keys, out="total")
    return out.select(*p.keys, F.col("label").alias("response"), "total").orderBy(*p.keys, "response")


def category_by_period(b: Binding, code: str, kind: str, fmt: str | None = None) -> DataFrame:
    """RP12/RP14 in long form: (period, label, total), for any number of categories."""
    p = facts.period(b, code)
    return bd.people_by_label(facts.with_bucket(facts.visits_in(b, p), p, fmt), b.person_label(kind),
                              group=[*p.keys, "period"], out="total")


def category_pivot(b: Binding, code: str, kind: str, fmt: str | None = None,
                   columns: str = "dimension") -> DataFrame:
    """RP12/RP14."""
    labels = b.person_label(kind)
    long = category_by_period(b, code, kind, fmt)
    return _by_period(long, "total", facts.pivot_values(labels, columns))


def status_total(b: Binding, code: str) -> DataFrame:
    """RP15: distinct people by yes/no status, relabelled, by response desc."""
    out = category_total(b, code, "veteran")
    keys = [c for c in out.columns if c == "interval"]
    return (out.select(*keys, "response", veteran_summary_name("response").alias("name"), "total")
            .orderBy(*keys, F.desc_nulls_first("response")))


def status_pivot(b: Binding, code: str, fmt: str | None = None) -> DataFrame:
    """RP16/PV3: fixed answer columns, renamed by name; a missing answer is 0."""
    p = facts.period(b, code)
    long = bd.people_by_label(facts.with_bucket(facts.visits_in(b, p), p, fmt), b.person_label("veteran"),
                              group=[*p.keys, "period"], out="total")
    return _by_period(long, "total", list(VETERAN_PIVOT_RENAME), VETERAN_PIVOT_RENAME)


def total_and_breakdown(b: Binding, code: str, kind: str = "gender", fmt: str | None = None) -> DataFrame:
    """AG13: distinct people per (sub-period, category) and per category in
    one pass; ``is_total = 1`` rows have period NULL."""
    p = facts.period(b, code)
    out = bd.people_total_and_breakdown(facts.with_bucket(facts.visits_in(b, p), p, fmt),
                                        b.person_label(kind), out="total")
    return out.select("period", F.col("label").alias("response"), "total", "is_total")


# --------------------------------------------------------------- lists


def new_people(b: Binding, code: str) -> DataFrame:
    """RP17: people whose first visit falls in the period, oldest first."""
    p = facts.period(b, code)
    fs = p.of(b.first_seen(), "timelinestarttime") if p.keys else b.first_seen().where(p.contains("timelinestarttime"))
    person = b.person()
    j = fs.join(person, "idperson")
    return (j.orderBy(*p.keys, "timelinestarttime", "idperson")
            .select(*p.keys, "firstname", "lastname", "aliasname", F.to_date("timelinestarttime").alias("startdate")))


def visit_ranking(b: Binding, code: str) -> DataFrame:
    """RP21: people by number of distinct visits in the period."""
    p = facts.period(b, code)
    counts = (facts.visits_in(b, p).groupBy(*p.keys, "person_id")
              .agg(F.count(F.lit(1)).alias("clientvisits")))   # idsnapshot is the key of visits
    person = b.person()
    j = counts.join(person, counts.person_id == person.idperson)
    return (j.select(*p.keys, "idperson", "firstname", "lastname", "clientvisits")
            .orderBy(*p.keys, F.desc("clientvisits"), "idperson"))


def visit_topk(b: Binding, code: str, k: int = 10) -> DataFrame:
    """SO7: the k most frequent visitors (TakeOrderedAndProject on the counts
    of known people; the names join k rows)."""
    counts = (facts.known_persons(b, facts.visits_in(b, facts.period(b, code))).groupBy("person_id")
              .agg(F.count(F.lit(1)).alias("clientvisits")))
    top = counts.orderBy(F.desc("clientvisits"), "person_id").limit(k)
    person = b.person()
    return (top.join(person, top.person_id == person.idperson)
            .select("idperson", "firstname", "lastname", "clientvisits")
            .orderBy(F.desc("clientvisits"), "idperson"))


def numbered(report: DataFrame, name: str) -> DataFrame:
    """An ordered report with ``row_no`` from 1, in its own order.  The rows are written as they come and numbered within
    their tasks; only the tasks' sizes are added up one after the other, so no task gets all rows."""
    from pyspark.sql import Window

    from turnstile.session import written

    rows = written(report.sparkSession, report.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")), name)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(before, "_part").withColumn("row_no", F.col("_before") + F.col("_id") - F.col("_first") + 1).drop("_part", "_id", "_first", "_before")


def report_order(b: Binding) -> DataFrame:
    """SO1-SO5: the place of every row of the ordered reports: ``(report, row_no, name)``."""
    from turnstile.operators.linkage import exact_duplicates

    ordered = {
        "services_total": (services_total(b, "PY"), "servicename"),
        "city_total": (city_total(b, "PW"), "cresponse"),
        "flagged_people": (flagged_people(b, "P90"), "lastname"),
        "reported_people": (reported_people(b, "YTD"), "idperson"),
        "status_total": (status_total(b, "YTD"), "response"),
        "new_people": (new_people(b, "PY"), "lastname"),
        "visit_ranking": (visit_ranking(b, "SI"), "idperson"),
        "exact_duplicates": (exact_duplicates(b.part_people()), "idperson"),
    }
    return reduce(DataFrame.unionByName, [
        numbered(df, f"order_{name}").select(F.lit(name).alias("report"), "row_no", F.col(c).cast("string").alias("name"))
        for name, (df, c) in ordered.items()])
