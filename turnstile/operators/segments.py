"""Pairs of strings within an edit distance, by a segment index (pass-join).

``k`` edits leave at least one of ``k + 1`` segments of a string whole, and it stands in the other string at a place that is
known to a few positions.  So the shorter string of a pair is indexed by its ``k + 1`` segments, and the other looks them up
by its own substrings there: the number of keys of a name is linear in ``k`` squared and does not depend on its length
(against the binomial number of its deletion variants).  A pair of equal lengths is found from its lesser string.

Segments are even in *information*, not in length: they are cut, for each length, so that each part has about the same
share of the entropies of its positions, the middle ones a little more, as they are looked up at more places.  A prefix
that all names share (an account prefix, say) then makes no segment of its own, whose group would be all names.  Any cut
gives the same pairs; the entropies come from all names, and only decide how many candidates there are.

A segment that many names still share is split: index rows are written once for each of ``SALTS``, and a name looks up in
one of them, so the candidates of one segment meet in as many places.  The join's shuffles are Spark's own, so AQE splits
what is still uneven.

Names that fill their space densely (account numbers) share every segment with ever more others as they get more.  So
pairs whose shorter string has up to ``edits.LENGTH`` letters are found by edit keys (``operators/edits.py``), whose
candidates are about as many as the pairs, and segments are for longer strings, whose edit keys would be too many.  Strings
of up to ``k`` characters have no ``k + 1`` segments, and always go by edit keys.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.operators import edits

SALTS = 4


def entropies(strings: DataFrame, col: str) -> DataFrame:
    """``(len, bits)``: for each length the entropies of its positions, in bits."""
    letters = (strings.select(F.col(col).alias("s"), F.length(col).alias("len")).where("len > 0")
               .select("len", "s", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("at"))
               .groupBy("len", "at", F.expr("substr(s, at, 1)").alias("letter")).agg(F.count(F.lit(1)).cast("double").alias("c")))
    places = letters.groupBy("len", "at").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log2("c")).alias("x"))
    place = F.struct("at", (F.log2("n") - F.col("x") / F.col("n")).alias("bits"))
    return places.groupBy("len").agg(F.array_sort(F.collect_list(place)).getField("bits").alias("bits"))


def segment_starts(strings: DataFrame, col: str, k: int) -> DataFrame:
    """``(len, starts)``: where the ``k + 1`` segments of strings of a length start; lengths up to ``k`` have none."""
    places_tried = [2 * min(j, k - j) + 1 for j in range(k + 1)]
    more = [log2(w) for w in places_tried]
    df = (entropies(strings, col).where(F.col("len") > k)
          .withColumn("total", F.expr("aggregate(bits, 0D, (a, x) -> a + x)"))
          # the middle of each position on the scale of information so far
          .withColumn("middles", F.expr("transform(bits, (x, i) -> aggregate(slice(bits, 1, i), 0D, (a, y) -> a + y) + x / 2)")))
    share = (F.col("total") - F.lit(sum(more))) / (k + 1)
    starts: list[Column] = [F.lit(1)]
    for j in range(1, k + 1):
        df = df.withColumn("limit", share * j + F.lit(sum(more[:j])))
        wanted = F.expr("size(filter(middles, m -> m < limit))") + 1
        # every segment has a letter at least
        df = df.withColumn(f"s{j}", F.least(F.greatest(wanted, starts[-1] + 1), F.col("len") - F.lit(k - j)))
        starts.append(F.col(f"s{j}"))
    return df.select("len", F.array(*starts).alias("starts"))


def _segments(starts: DataFrame) -> DataFrame:
    """One row per length and segment: ``(len, seg, first, size)``."""
    return (starts.select("len", "starts", F.posexplode("starts").alias("seg", "first"))
            .select("len", "seg", "first", (F.expr("coalesce(get(starts, seg + 1), len + 1)") - F.col("first")).alias("size")))


def candidate_pairs(left: DataFrame, right: DataFrame, k: int, strings: DataFrame) -> DataFrame:
    """``left(g, s)`` and ``right(g, r)``: every pair of equal ``g`` with ``length(r) <= length(s)`` whose distance may be
    at most ``k``, for strings ``r`` of more than ``k`` characters; ``(g, s, r, + the other columns of both)``.

    ``strings(s)`` are all strings that may occur; they decide where segments are cut."""
    cut = _segments(segment_starts(strings, "s", k))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    index = (right.withColumn("len", F.length("r")).join(cut, "len")
             .select(*right.columns, "len", "seg", F.expr("substr(r, first, size)").alias("var"), salts))
    # where segment j (from 0) may stand: at most j edits before it, at most k - j after it
    longer = F.col("n") - F.col("len")
    low = F.greatest(F.lit(1), F.col("first") - F.col("seg"), F.col("first") + longer - (F.lit(k) - F.col("seg")))
    high = F.least(F.col("n") - F.col("size") + 1, F.col("first") + F.col("seg"), F.col("first") + longer + (F.lit(k) - F.col("seg")))
    sought = (left.withColumn("n", F.length("s"))
              .withColumn("len", F.explode(F.sequence(F.greatest(F.lit(0), F.col("n") - k), F.col("n")))).join(cut, "len")
              .withColumn("low", low).withColumn("high", high).where("low <= high")
              .withColumn("at", F.explode(F.sequence("low", "high")))
              .select(*left.columns, "len", "seg", F.expr("substr(s, at, size)").alias("var"),
                      F.pmod(F.xxhash64("s"), F.lit(SALTS)).cast("int").alias("salt")))
    return sought.join(index, ["g", "len", "seg", "var", "salt"]).drop("len", "seg", "var", "salt")


def near_pairs(left: DataFrame, right: DataFrame, k: int, strings: DataFrame, keep: Column, out: list[str],
               longest: int | None = None) -> DataFrame:
    """Columns ``out`` of the pairs ``(g, s, r, ...)`` of ``left(g, s, ...)`` and ``right(g, r, ...)`` with equal ``g`` and
    ``r`` no longer than ``s``, within ``k`` edits; of those of equal length, the ones that ``keep`` (of columns ``out``) lets
    through.  Each two rows come once, where ``out`` tells the rows of each side apart.

    Pairs go by edit keys up to an ``r`` of ``longest`` letters (if more than ``k``), the others by segments."""
    if k < 0:
        raise ValueError("k must be >= 0")
    if longest is None:
        longest = edits.LENGTH if k <= edits.EDITS else k
    longest = max(longest, k)
    # the few long strings alone decide where long strings are cut
    long_ones = [df.where(F.length(c) > longest) for df, c in ((left, "s"), (right, "r"), (strings, "s"))]
    rest = candidate_pairs(long_ones[0], long_ones[1], k, long_ones[2]).where((F.length("r") < F.length("s")) | keep)
    # one call a pair; beyond k it is -1
    rest = rest.where(F.levenshtein("s", "r", k) != -1).select(*out)
    if k:
        rest = rest.unionByName(edits.moved_pairs(left, right, k, strings, keep, out, longest))
    return edits.replaced_pairs(left, right, k, strings, keep, out, longest).unionByName(rest.distinct())
