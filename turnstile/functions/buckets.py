"""Sub-period bucket labels (BKT1-BKT5).

The reference groups by ``to_char(timestamp, fmt)`` with five Postgres
formats.  Spark's ``to_char`` does not take datetime patterns and
``date_format(.., 'ww')`` is rejected, so each format is a composed built-in
expression (all JVM-side, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five bucket formats of the reference.
FORMATS = ["YYYY-MM", "YYYY-MM/DD DY", "YYYY-MM/DD WW", "YYYY-MM WW", "HH24"]


# Postgres ``DY`` day abbreviations, Sunday first (dayofweek 1..7).
DAY_ABBREV = ["SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT"]


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def week_of_year(ts: Column) -> Column:
    """Postgres ``WW``: week 1 starts on 1 January (not ISO), two digits."""
    return _two((F.floor((F.dayofyear(ts) - 1) / 7) + 1).cast("int"))


def bucket(ts: Column | str, fmt: str) -> Column:
    """Bucket label from the stored wall clock (``year``/``month``/``hour``
    read a ``timestamp_ntz`` directly), so labels do not depend on the
    session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    ym = F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), _two(F.month(ts)))
    if fmt == "YYYY-MM":
        return ym
    if fmt == "YYYY-MM/DD DY":
        day = F.element_at(F.array(*[F.lit(d) for d in DAY_ABBREV]), F.dayofweek(ts))
        return F.concat(ym, F.lit("/"), _two(F.dayofmonth(ts)), F.lit(" "), day)
    if fmt == "YYYY-MM/DD WW":
        return F.concat(ym, F.lit("/"), _two(F.dayofmonth(ts)), F.lit(" "), week_of_year(ts))
    if fmt == "YYYY-MM WW":
        return F.concat(ym, F.lit(" "), week_of_year(ts))
    if fmt == "HH24":
        return _two(F.hour(ts))
    raise ValueError(f"unknown bucket format {fmt!r}")


def bucket_by(ts: Column | str, fmt: Column) -> Column:
    """Bucket label with a format of each row; NULL for an unknown one."""
    out = F.when(fmt == FORMATS[0], bucket(ts, FORMATS[0]))
    for f in FORMATS[1:]:
        out = out.when(fmt == f, bucket(ts, f))
    return out
