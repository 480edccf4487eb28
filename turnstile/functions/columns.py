"""Scalar helpers (FN2-FN20) built only from JVM-side Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code lists embedded in the reference's person report (FN7)
# and the yes/no relabelling of the veteran summary (FN8).
ETHNICITY_LABELS = {1: "Unknown", 2: "Asian", 3: "Black", 4: "Hispanic", 5: "Native American", 6: "White"}
GENDER_LABELS = {1: "Unknown", 2: "Male", 3: "Female"}
LANGUAGE_LABELS = {
    1: "Preferred language unknown",
    2: "Preferred language is English",
    3: "Preferred language is Spanish",
}
VETERAN_LABELS = {
    1: "Veteran status is unknown",
    2: "Is a veteran of the US Armed Forces",
    3: "Is not a veteran of the US Armed Forces",
}
VETERAN_SUMMARY = {"Yes": "Veterans", "No": "Non-veterans"}
VETERAN_SUMMARY_OTHER = "Veteran status Unknown"
VETERAN_PIVOT_RENAME = {"No": "non-veteran", "Unknown": "unknown", "Yes": "veteran"}

_MICROS_PER_DAY = 86_400_000_000


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def prefix_before(c: Column | str, delim: str, missing: str = "drop_last") -> Column:
    """FN2: text before the first ``delim``.

    ``missing='drop_last'`` keeps the reference result when the delimiter is
    absent (Postgres ``left(s, -1)``: the text without its last character);
    ``missing='keep'`` returns the whole text.  NULL stays NULL.
    """
    c = _c(c)
    pos = F.instr(c, delim)
    if missing == "keep":
        absent = c
    elif missing == "drop_last":
        # Spark's left(s, -1) is '' while Postgres drops the last character.
        absent = F.left(c, F.greatest(F.length(c) - 1, F.lit(0)))
    else:
        raise ValueError(missing)
    return F.when(pos > 0, F.left(c, pos - 1)).otherwise(absent)


def _micros_between(start: Column | str, end: Column | str) -> Column:
    """Wall-clock microseconds from ``start`` to ``end``.  On
    ``timestamp_ntz`` values ``timestampdiff`` does not depend on the session
    time zone (a zoned cast would lose an hour across a daylight-saving
    change)."""
    return F.timestamp_diff("MICROSECOND", _c(start).cast("timestamp_ntz"), _c(end).cast("timestamp_ntz"))


def days_elapsed(earlier: Column | str, now: Column | str) -> Column:
    """FN6: whole days between two timestamps (floor of the exact difference,
    not the number of midnights crossed)."""
    return F.floor(_micros_between(earlier, now) / F.lit(_MICROS_PER_DAY)).cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """FN4: length of an interval in whole seconds (portable to SQL oracles)."""
    return (_micros_between(start, end) / F.lit(1_000_000)).cast("bigint")


def code_label(c: Column | str, mapping: dict) -> Column:
    """FN7: code -> label via a literal map; unmapped codes give NULL (Q10)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), _c(c).cast("int")) if kv else F.lit(None)


def veteran_summary_name(response: Column | str) -> Column:
    """FN8: Yes -> Veterans, No -> Non-veterans, anything else -> Unknown."""
    r = _c(response)
    return (F.when(r == "Yes", F.lit(VETERAN_SUMMARY["Yes"]))
            .when(r == "No", F.lit(VETERAN_SUMMARY["No"]))
            .otherwise(F.lit(VETERAN_SUMMARY_OTHER)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """FN10: a / b as double; NULL instead of an error on division by zero."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def us_date(ts: Column | str) -> Column:
    """FN5: ``MM/dd/yyyy`` from the stored wall clock (time-zone independent)."""
    t = _c(ts)
    return F.concat(F.lpad(F.month(t).cast("string"), 2, "0"), F.lit("/"),
                    F.lpad(F.dayofmonth(t).cast("string"), 2, "0"), F.lit("/"),
                    F.lpad(F.year(t).cast("string"), 4, "0"))


def attribute_value(df: DataFrame, keys: list[str], attrs: list[tuple[str, Column | str]],
                    attr_col: str = "Attribute", value_col: str = "Value") -> DataFrame:
    """FN20/PV5: wide record -> ordered (attribute, value) rows per key.

    ``attrs`` is an ordered list of (attribute name, column); values are cast
    to string.  Emits ``attr_ord`` so the reference's row order is kept.
    """
    structs = [F.struct(F.lit(i).alias("attr_ord"), F.lit(name).alias(attr_col),
                        _c(col).cast("string").alias(value_col))
               for i, (name, col) in enumerate(attrs, start=1)]
    return (df.select(*keys, F.explode(F.array(*structs)).alias("_av"))
            .select(*keys, "_av.attr_ord", f"_av.{attr_col}", f"_av.{value_col}"))
