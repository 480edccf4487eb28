"""Reporting-period algebra (PER1-PER15) as Spark column expressions.

Every period is a closed range ``[start, end]`` of ``timestamp_ntz`` values;
"end of day" is one microsecond before the next midnight.  Weeks run Sunday to
Saturday.  ``as_of`` is always explicit so reports are repeatable.

The same expression serves a single literal request (Catalyst folds it to two
constants that reach the Parquet scan as pushed filters) and a column of many
requests (a per-row ``CASE``), so one resolver covers the batch and stream
paths.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Period codes, their sub-period bucket formats and friendly
# labels (the labels must equal the reference's text).
RELATIVE_CODES = ["PD", "PW", "PM", "PQ", "PY", "YTD", "WTD", "TODAY", "P90", "SI"]
BUCKET_FORMAT = {
    "PD": "HH24",
    "PW": "YYYY-MM/DD DY",
    "PM": "YYYY-MM/DD DY",
    "PQ": "YYYY-MM/DD WW",
    "PY": "YYYY-MM",
    "YTD": "YYYY-MM",
    "WTD": "YYYY-MM/DD DY",
    "TODAY": "HH24",
    "P90": "YYYY-MM WW",
    "SI": "YYYY-MM",
    "DAY": "HH24",
    "MONTH": "YYYY-MM",
}
FRIENDLY = {
    "PD": "Prior Day",
    "PW": "Prior Week",
    "PM": "Prior Month",
    "PQ": "Prior Quarter",
    "PY": "Prior Year",
    "YTD": "Year to Date",
    "WTD": "Week to Date",
    "TODAY": "Today",
    "P90": "Previous 90 days",
    "SI": "all dates",
}
UNKNOWN_PERIOD = "Unknown Period"
DEFAULT_INCEPTION = "2018-01-01"

DAY_CODE = re.compile(r"^\d{1,2}/\d{1,2}/\d{4}$")
MONTH_CODE = re.compile(r"^YYYYMM\d{6}$")

def _us() -> Column:
    return F.expr("make_dt_interval(0, 0, 0, 0.000001)")


def code_kind(code: str) -> str | None:
    """Python-side classification of a literal code (no Spark job)."""
    if code in RELATIVE_CODES:
        return code
    if DAY_CODE.match(code or ""):
        try:
            datetime.strptime(code, "%m/%d/%Y")
        except ValueError:
            return None
        return "DAY"
    if MONTH_CODE.match(code or ""):
        mm = int(code[10:12])
        return "MONTH" if 1 <= mm <= 12 else None
    return None


def validate_code(code: str) -> str:
    kind = code_kind(code)
    if kind is None:
        raise ValueError(f"unknown reporting period code: {code!r}")
    return kind


def _ts(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def _eod(exclusive_day: Column) -> Column:
    """Last microsecond before the given (date) midnight."""
    return _ts(exclusive_day) - _us()


def _branches(code: Column, n: Column, inc: Column) -> dict:
    """code kind -> (start, end) expressions over ``as_of`` = n."""
    d = F.to_date(n)
    week = F.date_sub(d, F.dayofweek(d) - 1)           # Sunday on or before d
    month = F.trunc(d, "month")
    quarter = F.trunc(d, "quarter")
    year = F.trunc(d, "year")
    one_day = F.try_to_date(code, "M/d/yyyy")
    one_month = F.try_to_date(F.substring(code, 7, 6), "yyyyMM")
    return {
        "PD": (_ts(F.date_sub(d, 1)), _eod(d)),
        "PW": (_ts(F.date_sub(week, 7)), _eod(week)),
        "PM": (_ts(F.add_months(month, -1)), _eod(month)),
        "PQ": (_ts(F.add_months(quarter, -3)), _eod(quarter)),
        "PY": (_ts(F.add_months(year, -12)), _eod(year)),
        "YTD": (_ts(year), n),
        "WTD": (_ts(week), n),
        "TODAY": (_ts(d), n),
        "P90": (_ts(F.date_sub(d, 90)), _eod(F.date_add(d, 1))),
        "SI": (_ts(F.to_date(inc)), n),
        "DAY": (_ts(one_day), _eod(F.date_add(one_day, 1))),
        "MONTH": (_ts(one_month), _eod(F.add_months(one_month, 1))),
    }


def period_bounds(code: Column | str, as_of: Column | str | datetime,
                  inception: Column | str = DEFAULT_INCEPTION) -> Column:
    """``struct(start, end, bucket)`` for a period code; NULL fields for an
    unknown code (callers route those rows to a reject frame).

    A literal code yields just its own branch (a small constant expression
    Catalyst folds); a code column yields a per-row ``CASE`` over all kinds.
    """
    n = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of.cast("timestamp_ntz")
    inc = F.lit(inception) if isinstance(inception, str) else inception
    if isinstance(code, str):
        kind = code_kind(code)
        if kind is None:
            nul = F.lit(None).cast("timestamp_ntz")
            return F.struct(nul.alias("start"), nul.alias("end"), F.lit(None).cast("string").alias("bucket"))
        s, e = _branches(F.lit(code), n, inc)[kind]
        return F.struct(s.alias("start"), e.alias("end"), F.lit(BUCKET_FORMAT[kind]).alias("bucket"))
    br = _branches(code, n, inc)
    is_day = code.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") & F.try_to_date(code, "M/d/yyyy").isNotNull()
    is_month = code.rlike(r"^YYYYMM\d{6}$") & F.try_to_date(F.substring(code, 7, 6), "yyyyMM").isNotNull()
    conds = [(code == c, c) for c in RELATIVE_CODES] + [(is_day, "DAY"), (is_month, "MONTH")]
    start = end = fmt = None
    for cond, kind in conds:
        s, e = br[kind]
        f = F.lit(BUCKET_FORMAT[kind])
        start = F.when(cond, s) if start is None else start.when(cond, s)
        end = F.when(cond, e) if end is None else end.when(cond, e)
        fmt = F.when(cond, f) if fmt is None else fmt.when(cond, f)
    return F.struct(start.alias("start"), end.alias("end"), fmt.alias("bucket"))


def period_label(code: Column | str) -> Column:
    """PER14: friendly label, ``Unknown Period`` otherwise."""
    code = F.lit(code) if isinstance(code, str) else code
    out = F.lit(UNKNOWN_PERIOD)
    for c in reversed(RELATIVE_CODES):
        out = F.when(code == c, F.lit(FRIENDLY[c])).otherwise(out)
    return out


class Period:
    """A resolved literal period: constant columns Catalyst folds and pushes."""

    keys: tuple[str, ...] = ()

    def __init__(self, code: str, as_of: str | datetime, inception: str = DEFAULT_INCEPTION):
        self.kind = validate_code(code)
        self.code = code
        self.as_of = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")
        self.inception = inception
        self._b = period_bounds(code, self.as_of, inception)

    @property
    def start(self) -> Column:
        return self._b.getField("start")

    @property
    def end(self) -> Column:
        return self._b.getField("end")

    @property
    def bucket(self) -> str:
        return BUCKET_FORMAT[self.kind]

    @property
    def label(self) -> str:
        return FRIENDLY.get(self.code, UNKNOWN_PERIOD)

    def contains(self, ts: Column | str) -> Column:
        ts = F.col(ts) if isinstance(ts, str) else ts
        return ts.between(self.start, self.end)

    def __repr__(self) -> str:
        return f"Period({self.code!r}, as_of={self.as_of!r})"


class Periods:
    """Many periods at once: a table ``(interval, start, end, bucket)``, one row per code.  Reports that get it in place of
    a :class:`Period` have the code as a further key, ``interval``; their work and their number of jobs don't depend on how
    many codes there are."""

    keys = ("interval",)

    def __init__(self, table: DataFrame):
        self.table = table.select("interval", "start", "end", F.col("bucket").alias("_fmt"))

    def of(self, facts: DataFrame, ts: str = "timestamp") -> DataFrame:
        """Facts once for each period that holds them, with its ``interval`` (and bucket format, for the sub-periods)."""
        from turnstile.operators.joins import range_join
        return range_join(facts, self.table, ts).drop("start", "end")

    def codes(self) -> DataFrame:
        return self.table.select("interval")


def resolve_requests(requests: DataFrame, code_col: str = "interval",
                     as_of_col: str = "as_of", inception: Column | str = DEFAULT_INCEPTION) -> DataFrame:
    """PER15: resolve many requests at once; adds start, end, bucket, label."""
    b = period_bounds(F.col(code_col), F.col(as_of_col), inception)
    return (requests
            .withColumn("_b", b)
            .withColumn("start", F.col("_b.start"))
            .withColumn("end", F.col("_b.end"))
            .withColumn("bucket", F.col("_b.bucket"))
            .withColumn("label", period_label(F.col(code_col)))
            .drop("_b"))
