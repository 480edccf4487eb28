"""The core report shape: a measure broken down by a label, optionally by
sub-period, as a total, a long breakdown, a pivot, or total-and-breakdown in
one pass (AG1, AG3, AG13, PV1-PV3).

Scale notes
-----------
* ``rows`` measures pre-aggregate on ``(group..., key)`` *before* the label
  join, so a dimension key holding a third of all facts becomes one row per
  group before any exchange, and the join moves counts, not facts.
* ``people`` measures first reduce the facts to distinct ``(group...,
  person_id)``: a person with millions of visits contributes one row per
  sub-period to the join with the person table.
* Totals of distinct counts are never summed from sub-periods; ``both`` uses
  ``GROUPING SETS`` so the sub-period rows and the totals come from one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.operators.joins import bounded_broadcast


def rows_by_label(fact: DataFrame, key: str, dim: DataFrame, group: Sequence[str] = (),
                  out: str = "n", dim_key: str = "id", label: str = "label",
                  dim_rows: int | None = None) -> DataFrame:
    """count(*) of facts per (group..., label); label = dim[label] via key.
    ``dim_rows``: a known bound on the dimension's size, if any."""
    pre = fact.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_n"))
    d = bounded_broadcast(dim.select(F.col(dim_key).alias("_k"), F.col(label).alias("label")), dim_rows)
    j = pre.join(d, pre[key] == d["_k"])
    return j.groupBy(*group, "label").agg(F.sum("_n").cast("bigint").alias(out))


def people_by_label(fact: DataFrame, labels: DataFrame, group: Sequence[str] = (),
                    out: str = "n") -> DataFrame:
    """count(DISTINCT person_id) per (group..., label); labels = (idperson, label)."""
    pre = fact.select(*group, "person_id").distinct()
    lab = labels.select("idperson", "label")      # grows with the people: Spark sizes the join
    j = pre.join(lab, pre.person_id == lab.idperson)
    return j.groupBy(*group, "label").agg(F.count(F.lit(1)).cast("bigint").alias(out))


def rows_total_and_breakdown(fact: DataFrame, key: str, dim: DataFrame, period: str = "period",
                             out: str = "n", dim_key: str = "id", dim_rows: int | None = None) -> DataFrame:
    """AG13 for count(*): (period|NULL, label, n, is_total) in one pass."""
    pre = fact.groupBy(period, key).agg(F.count(F.lit(1)).alias("_n"))
    d = bounded_broadcast(dim.select(F.col(dim_key).alias("_k"), "label"), dim_rows)
    j = pre.join(d, pre[key] == d["_k"])
    return (j.groupingSets([[period, "label"], ["label"]], period, "label")
            .agg(F.sum("_n").cast("bigint").alias(out), F.grouping(period).cast("int").alias("is_total")))


def people_total_and_breakdown(fact: DataFrame, labels: DataFrame, period: str = "period",
                               out: str = "n") -> DataFrame:
    """AG13 for count(DISTINCT person): totals are true distinct counts."""
    pre = fact.select(period, "person_id").distinct()
    lab = labels.select("idperson", "label")
    j = pre.join(lab, pre.person_id == lab.idperson)
    return (j.groupingSets([[period, "label"], ["label"]], period, "label")
            .agg(F.count_distinct("person_id").cast("bigint").alias(out),
                 F.grouping(period).cast("int").alias("is_total")))


def label_values(labels: DataFrame, label: str = "label") -> list:
    """Sorted distinct non-NULL labels, read anew on each call: a label that
    came since the last one gets its column.  As in Spark's own ``pivot``, more
    labels than ``spark.sql.pivotMaxValues`` are an error; the long reports
    (``*_by_period``) have no such width."""
    most = int(labels.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = labels.where(F.col(label).isNotNull()).select(label).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"pivot on {label!r} has more than spark.sql.pivotMaxValues = {most} labels")
    return sorted(r[0] for r in found)


def column_names(index: Sequence[str], labels: Sequence[str]) -> list[str]:
    """A column name for each label: the label itself, or with a number added
    where another column has that name already (names ignore case)."""
    used, out = {c.lower() for c in index}, []
    for v in labels:
        name, n = str(v), 1
        while name.lower() in used:
            n += 1
            name = f"{v} ({n})"
        used.add(name.lower())
        out.append(name)
    return out


def pivot(long: DataFrame, index: Sequence[str], column: str = "label", value: str = "n",
          values: Sequence | None = None, rename: dict | None = None) -> DataFrame:
    """PV1/PV3: long -> wide; gaps become 0 (bigint), NULL labels dropped.

    ``values`` gives the columns (``dimension`` mode: all labels of a
    dimension); without it the columns are the labels that ``long`` has
    (``observed`` mode)."""
    if values is None:
        values = label_values(long, column)
    names = column_names(index, [(rename or {}).get(v, v) for v in values])
    n = F.coalesce(F.col(value), F.lit(0))
    sums = [F.sum(F.when(F.col(column) == F.lit(v), n).otherwise(F.lit(0))).cast("bigint").alias(name)
            for v, name in zip(values, names)]
    rows = long.where(F.col(column).isNotNull()).groupBy(*index)
    return rows.agg(*sums) if sums else rows.agg(F.count(F.lit(1)).alias("_n")).drop("_n")


__all__ = ["rows_by_label", "people_by_label", "rows_total_and_breakdown",
           "people_total_and_breakdown", "label_values", "column_names", "pivot"]
