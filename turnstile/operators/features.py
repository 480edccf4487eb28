"""Per-person feature table (FEA1-FEA5): four per-person aggregates left
joined onto the visit counts, NULLs to 0, eleven ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.columns import ratio
from turnstile.plans import facts

# Housing answer codes counted per person (the reference's
# six named answers, object ids 1..6).
HOUSING_COUNTS = [("unknown", 1), ("stable", 2), ("unstable", 3), ("sheltered", 4),
                  ("unsheltered", 5), ("jail", 6)]
RATE_COLUMNS = ["genderrate", "ethnicityrate", "veteranrate", "servicerate", "creditrate",
                "unknownrate", "stablerate", "unstablerate", "shelteredrate", "unshelteredrate", "jailrate"]


def _visits_with_person(b: Binding, p) -> DataFrame:
    v = facts.visits_in(b, p)
    ids = b.person().select(F.col("idperson").alias("_pid"))
    return v.join(ids, v.person_id == ids["_pid"], "left_semi")


def seen_people(b: Binding, code: str = "SI", source: str = "survey") -> DataFrame:
    """FEA1: people with a visit in the range, with their codes and credits
    (aggregate by id first, then join the attributes: AG7)."""
    p = facts.period(b, code, source)
    ids = _visits_with_person(b, p).select(F.col("person_id").alias("idperson")).distinct()
    return ids.join(b.person_codes(), "idperson").select(
        "idperson", "gender_id", "ethnicity_id", "veteran_id", "credits")


def visits_per_person(b: Binding, code: str = "SI", source: str = "survey") -> DataFrame:
    """FEA2: visit count per person (count of non-NULL visit ids)."""
    p = facts.period(b, code, source)
    return (_visits_with_person(b, p).groupBy(F.col("person_id").alias("idperson"))
            .agg(F.count("idsnapshot").cast("bigint").alias("visits")))


def services_per_person(b: Binding, code: str = "SI", source: str = "survey") -> DataFrame:
    """FEA3: service requests per person."""
    p = facts.period(b, code, source)
    v = _visits_with_person(b, p)
    r = b.requests()
    return (v.join(r, v.idsnapshot == r.connection_id).groupBy(F.col("person_id").alias("idperson"))
            .agg(F.count("service_id").cast("bigint").alias("services")))


def activity_per_person(b: Binding, code: str = "SI", source: str = "survey") -> DataFrame:
    """FEA2 and FEA3 in one pass over the visits: visits and service requests
    per person, requests counted per visit first."""
    v = _visits_with_person(b, facts.period(b, code, source))
    r = b.requests().groupBy("connection_id").agg(F.count("service_id").alias("_services"))
    return (v.join(r, v.idsnapshot == r.connection_id, "left").groupBy(F.col("person_id").alias("idperson"))
            .agg(F.count("idsnapshot").alias("visits"), F.sum("_services").alias("services")))


def housing_per_person(b: Binding, code: str = "SI", source: str = "survey") -> DataFrame:
    """FEA4: six conditional counts in one pass (count_if)."""
    p = facts.period(b, code, source)
    s = b.survey().where(p.contains("timestamp"))
    ids = b.person().select(F.col("idperson").alias("_pid"))
    s = s.join(ids, s.person_id == ids["_pid"], "left_semi")
    prompt = F.col("prompt_id") == F.lit(b.prompts["housing"])
    return s.groupBy(F.col("person_id").alias("idperson")).agg(
        *[F.count_if(prompt & (F.col("object_id") == v)).cast("bigint").alias(n) for n, v in HOUSING_COUNTS])


def feature_table(b: Binding, code: str = "SI", source: str = "survey",
                  normalise_by: str = "gender_id") -> DataFrame:
    """FEA5: idperson + 11 rates.

    ``normalise_by='gender_id'`` divides the three code columns by the
    gender maximum, as the reference does (Q12); ``'self'`` divides each by
    its own maximum.  Maxima are scalar subqueries (no cross join).
    """
    j = (activity_per_person(b, code, source).join(b.person_codes(), "idperson", "left")
         .join(housing_per_person(b, code, source), "idperson", "left"))
    counts = ["visits", "gender_id", "ethnicity_id", "veteran_id", "credits", "services"] + [n for n, _ in HOUSING_COUNTS]
    j = j.select("idperson", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in counts])

    seen = seen_people(b, code, source)

    def max_of(c):
        # the people of ``j`` are those of ``seen`` (same visits, same person
        # filter), so the maximum over the joined table is the maximum over
        # ``seen`` with NULL read as 0: a smaller subquery than ``j`` itself
        return seen.select(F.coalesce(F.max(F.col(c).cast("double")), F.lit(0.0))).scalar()

    gmax = max_of("gender_id")
    emax = gmax if normalise_by == "gender_id" else max_of("ethnicity_id")
    vmax = gmax if normalise_by == "gender_id" else max_of("veteran_id")
    rates = [
        ratio("gender_id", gmax).alias("genderrate"),
        ratio("ethnicity_id", emax).alias("ethnicityrate"),
        ratio("veteran_id", vmax).alias("veteranrate"),
        ratio("services", "visits").alias("servicerate"),
        ratio("credits", "visits").alias("creditrate"),
    ] + [ratio(n, "visits").alias(f"{n}rate") for n, _ in HOUSING_COUNTS]
    return j.select("idperson", *rates)
