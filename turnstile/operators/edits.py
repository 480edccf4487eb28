"""Keys that two strings share exactly when a few edits make one of the other.

Two strings are within ``k`` edits if, after ``c`` letters of the shorter ``r`` and ``b`` of the longer ``s`` are left out,
they agree but for ``a`` places, with ``a + b + c <= k`` and ``b - c`` the difference of their lengths.  So for each
difference and each ``c``, both give a key for every way to leave out their letters and to mask ``a`` places, the most that
``k`` allows.  Equal keys are within ``k``, and pairs within ``k`` have an equal key: candidates are about as many as
pairs, however densely the strings fill their space, and no key has more strings than its few free letters allow.

Strings of a length differ only where strings of that length do, so only those places are masked when nothing is left out:
a prefix that all share makes no keys.  Keys for a difference of lengths are only made where both lengths occur.  Their
number grows with the ``k``-th power of the length, so longer strings are left to segments (``operators/segments.py``).

Most near pairs only have letters replaced, and share several keys if they differ in fewer than ``k`` places.  Of these
keys one counts, so such a pair is made once, needs no comparing of the strings and no removal of repeats: the key that
masks the places where the two differ and, besides, the first ones of the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest strings to be found by these keys, and most edits.
LENGTH = 24
EDITS = 3
#: Stands for a masked letter.  A string that holds it itself only makes more candidates.
MASK = "\x00"


def one_deleted(level: DataFrame, out: str) -> DataFrame:
    """A row per letter of ``out`` from position ``_from`` on, without that letter; ``_from`` is where it stood.

    Of equal neighbours only the first is deleted, counted after the deletions before it."""
    n = F.length(out)
    some = F.when(F.col("_from") <= n, F.sequence(F.col("_from"), n)).otherwise(F.array().cast("array<int>"))
    cut = level.withColumn("_i", F.explode(some))
    first = (F.col("_i") == 1) | (F.expr(f"substr({out}, _i - 1, 1)") != F.expr(f"substr({out}, _i, 1)"))
    return (cut.where(first).withColumn(out, F.concat(F.expr(f"substr({out}, 1, _i - 1)"), F.expr(f"substr({out}, _i + 1)")))
            .withColumn("_from", F.col("_i")).drop("_i"))


def _masked(df: DataFrame, out: str, places: Column, times: int, letters: str | None = None) -> DataFrame:
    """A row per choice of ``times`` of ``places``, masked in ``out``; all places, if there are fewer.  ``_masks`` names them.

    ``letters`` and a number from 1 are the letters under the masks, null where the mask and those before it stand at the
    first places."""
    df = (df.withColumn("_places", places).withColumn("_many", F.least(F.lit(times), F.size("_places")))
          .withColumn("_at", F.lit(0)).withColumn("_masks", F.lit("")))
    for t in range(times):
        more = F.col("_many") > t
        last = F.size("_places") - F.col("_many") + (t + 1)      # leaves places for the masks that follow
        df = df.withColumn("_at", F.explode(F.when(more, F.sequence(F.col("_at") + 1, last)).otherwise(F.array("_at"))))
        place = F.expr("get(_places, _at - 1)")
        if letters is not None:
            df = df.withColumn(f"{letters}{t + 1}", F.when(more & (F.col("_at") > t + 1), F.substr(F.col(out), place, F.lit(1))))
        df = df.withColumn("_masks", F.when(more, F.concat("_masks", place.cast("string"), F.lit(","))).otherwise(F.col("_masks")))
        df = df.withColumn(out, F.when(more, F.concat(F.substr(F.col(out), F.lit(1), place - 1), F.lit(MASK), F.substr(F.col(out), place + 1)))
                           .otherwise(F.col(out)))
    return df.drop("_places", "_many", "_at")


def lengths(strings: DataFrame, col: str) -> DataFrame:
    """``(len, places)``: the lengths that occur, and the places where strings of that length differ."""
    s = strings.select(F.col(col).alias("s"), F.length(col).alias("len"))
    letters = (s.where("len > 0").select("len", "s", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("at"))
               .select("len", "at", F.expr("substr(s, at, 1)").alias("letter")).distinct())
    places = letters.groupBy("len", "at").agg(F.count(F.lit(1)).alias("n"))
    return (places.groupBy("len").agg(F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.col("at")))).alias("places"))
            .unionByName(s.where("len = 0").select("len").distinct().select("len", F.array().cast("array<int>").alias("places"))))


def _keys(df: DataFrame, col: str, deleted: int, masked: int, kind: int) -> DataFrame:
    """A row per choice of letters left out and places masked: ``_var`` tells them and what stays, apart for each kind."""
    level = df.withColumn("_var", F.col(col)).withColumn("_from", F.lit(1)).withColumn("_masks", F.lit(""))
    for _ in range(deleted):
        level = one_deleted(level, "_var")
    if masked:
        n = F.length("_var")
        level = _masked(level, "_var", F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), masked)
    return level.withColumn("_var", F.concat(F.lit(f"{kind};"), "_masks", F.lit(":"), "_var"))


def _known(left: DataFrame, right: DataFrame, k: int, strings: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """The strings of both sides that are short enough, with their length, its places, and all lengths that occur."""
    occur = lengths(strings.where(F.length("s") <= longest + k), "s")
    # at most longest + k + 1 lengths: each gets the list of all
    known = F.broadcast(occur.agg(F.collect_list(F.struct("len", "places")).alias("some"), F.collect_list("len").alias("_all"))
                        .select("_all", F.inline("some")))
    return (left.where(F.length("s") <= longest + k).withColumn("len", F.length("s")).join(known, "len"),
            right.where(F.length("r") <= longest).withColumn("len", F.length("r")).join(known, "len"))


def _met(rows: DataFrame, end: str, own: list[str], out: list[str]) -> DataFrame:
    """One side of a join: the key, what it stands for, the columns ``own`` of this side, and those of ``out``."""
    some = [c for c in rows.columns if c in out]
    return rows.select(F.xxhash64("g", "_var").alias("_key"), F.col("g").alias(f"_g_{end}"), F.col("_var").alias(f"_var_{end}"),
                       *[F.col(c).alias(f"{c}_{end}") for c in own], *some)


def _joined(left: DataFrame, right: DataFrame, some: Column) -> DataFrame:
    """Rows are sorted by one number; what it stands for is compared in the few that ``some`` lets through."""
    return left.join(right, "_key").where(some).where((F.col("_var_s") == F.col("_var_r")) & (F.col("_g_s") == F.col("_g_r")))


def replaced_pairs(left: DataFrame, right: DataFrame, k: int, strings: DataFrame, keep: Column, out: list[str],
                   longest: int = LENGTH) -> DataFrame:
    """Columns ``out`` (but not ``g``) of the pairs of ``left(g, s, ...)`` and ``right(g, r, ...)`` with equal ``g`` and of
    equal length that differ in at most ``k`` places, for ``r`` of at most ``longest`` letters, that ``keep`` (of columns
    ``out``) lets through.  Each pair of rows comes once."""
    letters = [f"_letter{t}" for t in range(1, k + 1)]
    s, r = (_met(_masked(df.withColumn("_var", F.col(c)), "_var", F.col("places"), k, "_letter")
                 .withColumn("_var", F.concat("_masks", F.lit(":"), "_var")), c, letters, out)
            for df, c in zip(_known(left, right, k, strings, longest), "sr", strict=True))
    # masks are equal, so both letters are null or none is
    differ = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"{c}_s") != F.col(f"{c}_r"), F.lit(True)) for c in letters], keep)
    return _joined(s, r, differ).select(*out)


def moved_pairs(left: DataFrame, right: DataFrame, k: int, strings: DataFrame, keep: Column, out: list[str],
                longest: int = LENGTH) -> DataFrame:
    """Columns ``out`` (but not ``g``) of the other pairs within ``k`` edits with ``length(r) <= length(s)``, for ``r`` of at
    most ``longest`` letters: those that differ in length, and those of equal length that differ in more than ``k`` places and
    that ``keep`` (of columns ``out``) lets through.  Some come more than once.  ``k`` is 1 or more."""
    # strings of a length differ at its places only, so only the letters there are compared
    s, r = (df.withColumn("_letters", F.expr(f"transform(places, p -> substr({c}, p, 1))")).withColumnRenamed("len", "_len")
            for df, c in zip(_known(left, right, k, strings, longest), "sr", strict=True))
    index, sought, kind = [], [], 0
    for d in range(k + 1):
        for c in range((k - d) // 2 + 1):
            b, kind = c + d, kind + 1
            if b == 0:
                continue
            a = k - b - c
            shorter = r.where(F.array_contains("_all", F.col("_len") + d))
            longer = s.where(F.array_contains("_all", F.col("_len") - d))
            index.append(_met(_keys(shorter, "r", c, a, kind), "r", ["_len", "_letters"], out))
            sought.append(_met(_keys(longer, "s", b, a, kind), "s", ["_len", "_letters"], out))
    differ = F.expr("size(array_remove(zip_with(_letters_s, _letters_r, (a, b) -> a != b), false))")
    some = (F.col("_len_r") < F.col("_len_s")) | ((F.col("_len_r") == F.col("_len_s")) & keep & (differ > k))
    return _joined(reduce(DataFrame.unionByName, sought), reduce(DataFrame.unionByName, index), some).select(*out)


def edit_candidates(left: DataFrame, right: DataFrame, k: int, strings: DataFrame, longest: int = LENGTH) -> DataFrame:
    """``left(g, s, ...)`` and ``right(g, r, ...)``: pairs of equal ``g`` with ``length(r) <= length(s)`` that share a key,
    for ``r`` of at most ``longest`` letters; ``(s, r, + the other columns of both but g)``, some more than once.

    ``strings(s)`` are all strings that may occur."""
    given = (left, right, k, strings, F.lit(True), [c for c in [*left.columns, *right.columns] if c != "g"], longest)
    return replaced_pairs(*given).unionByName(moved_pairs(*given)) if k else replaced_pairs(*given)
