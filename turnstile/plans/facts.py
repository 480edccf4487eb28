"""Period-filtered fact frames shared by the reports.

Each is a lazy plan; the closed-range filter is a pair of folded literals, so
it reaches the Parquet scan as ``PushedFilters`` and prunes row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.buckets import bucket, bucket_by
from turnstile.functions.columns import prefix_before
from turnstile.functions.periods import Period, Periods, resolve_requests


def period(b: Binding, code: str | DataFrame, source: str = "visits") -> Period | Periods:
    """The period of one code, or of every different code of a frame ``(interval, ...)``; unknown codes have none there."""
    if isinstance(code, DataFrame):
        codes = code.select("interval").distinct().withColumn("as_of", F.lit(b.as_of_for(source)).cast("timestamp_ntz"))
        return Periods(resolve_requests(codes, "interval", "as_of", F.lit(b.inception)).where(F.col("start").isNotNull()))
    return b.memo(("period", code, source), lambda: Period(code, b.as_of_for(source), b.inception))


def pivot_values(dim: DataFrame, columns: str = "dimension") -> list | None:
    """Pivot columns: every label of the dimension, or (``observed``) None, for
    the labels that have rows."""
    from turnstile.operators.breakdown import label_values
    if columns not in ("dimension", "observed"):
        raise ValueError(columns)
    return label_values(dim) if columns == "dimension" else None


def with_bucket(df: DataFrame, p: Period | Periods | None, fmt: str | None = None, ts: str = "timestamp") -> DataFrame:
    if isinstance(p, Periods) and fmt is None:
        return df.withColumn("period", bucket_by(F.col(ts), F.col("_fmt")))
    fmt = fmt or (p.bucket if p is not None else None)
    return df.withColumn("period", bucket(F.col(ts), fmt))


def in_period(df: DataFrame, p: Period | Periods, ts: str = "timestamp") -> DataFrame:
    """FIL1: closed range on the timestamp; when the fact is stored by month
    (``sources.layout``), also the implied partition filter.  For many periods,
    a range join that adds their ``interval``."""
    if isinstance(p, Periods):
        return df if "interval" in df.columns else p.of(df, ts)      # facts dealt to the periods before stay as they are
    from turnstile.sources.layout import PART_COL, prune_to_period
    if PART_COL in df.columns:
        return prune_to_period(df, p, ts)
    return df.where(p.contains(ts))


def visits_in(b: Binding, p: Period, persons=None) -> DataFrame:
    """FIL1 (+FIL3 in batch form): visits in the period, optionally only of
    the requested persons."""
    return semi_persons(in_period(b.visits(), p), persons)


def semi_persons(fact: DataFrame, persons, col: str = "person_id") -> DataFrame:
    """Restrict facts to the requested persons.

    ``persons`` is None (everyone), a list of ids (an IN filter that reaches
    the scan, FIL3) or a DataFrame with an ``idperson`` column (a semi join,
    which Spark sizes).  The caller's type decides, not the number of ids.  A
    frame with an ``interval`` as well asks for each person in their own periods,
    wherever the facts have one.
    """
    if persons is None:
        return fact
    if isinstance(persons, (list, tuple, set, frozenset)):
        return fact.where(F.col(col).isin(sorted({int(x) for x in persons})))
    if "interval" in persons.columns and "interval" in fact.columns:
        asked = persons.select(F.col("idperson").alias("_pid"), F.col("interval").alias("_int")).distinct()
        return fact.join(asked, (fact[col] == asked["_pid"]) & (fact["interval"] == asked["_int"]), "left_semi")
    ids = persons.select(F.col("idperson").alias("_pid")).distinct()
    return fact.join(ids, fact[col] == ids["_pid"], "left_semi")


def known_persons(b: Binding, fact: DataFrame, col: str = "person_id") -> DataFrame:
    """JN8: facts of people that the person table has."""
    return semi_persons(fact, b.person().select("idperson"), col)


def service_fact(b: Binding, p: Period, persons: DataFrame | None = None) -> DataFrame:
    """JN2: visit ⋈ service request; (idsnapshot, person_id, timestamp, service_id)."""
    if hasattr(b, "service_rows"):      # written for a bundle before, of free services only
        return semi_persons(in_period(b.service_rows(), p), persons)
    v = visits_in(b, p, persons)
    r = b.requests()
    return (v.join(r, v.idsnapshot == r.connection_id)
            .select("idsnapshot", "person_id", "timestamp", "service_id", *[c for c in ("interval", "_fmt") if c in v.columns]))


def service_dim(b: Binding) -> DataFrame:
    """Services with non-positive points (FIL6), labelled by the category
    prefix of their name (FN2): (id, label)."""
    s = b.free_services()
    return s.select(F.col("idservice").alias("id"), prefix_before("name", b.service_delim).alias("label"))


def survey_in(b: Binding, p: Period, prompt_kind: str, object_id: int | None = None,
              persons: DataFrame | None = None) -> DataFrame:
    """JN3/FIL4/FIL5: survey answers to one prompt in the period."""
    s = in_period(b.survey(), p).where(F.col("prompt_id") == F.lit(b.prompts[prompt_kind]))
    if object_id is not None:
        s = s.where(F.col("object_id") == F.lit(object_id))
    return semi_persons(s, persons)


def response_rows(b: Binding, kind: str) -> int | None:
    """Known size bound of a response dimension, if the schema fixes one."""
    return b.dimension_rows.get(kind)


def response_dim(b: Binding, kind: str) -> DataFrame:
    """Response dimension labelled for reports: (id, label)."""
    r = b.response(kind)
    delim = b.response_delim(kind)
    lab = prefix_before("name", delim) if delim else F.col("name")
    return r.select("id", lab.alias("label"))
