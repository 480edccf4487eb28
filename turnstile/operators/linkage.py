"""Duplicate people (DUP1 near, DUP2 exact).

DUP1 is lossless blocking by edit keys and, for long names, segments
(``operators/edits.py``, ``operators/segments.py``).  The whole search is
equi-joins on *distinct names*, never a cross join:

1. people -> distinct (first, last) name keys with a head count, so a name
   shared by a third of all people is one row from here on;
2. near first names, verified with ``levenshtein(a, b, k)``;
3. candidate name pairs: each name key, expanded by its near first names, meets
   the other name keys on ``(first name, key of the last name)``; every
   candidate is verified exactly with ``levenshtein`` on the last name;
4. ``near_duplicates`` expands verified name pairs to the people that carry
   them.  ``duplicate_classes`` and ``duplicate_groups`` (AG12) don't: they give
   one row per different name and one per person, whatever the number of pairs.

Names are written with a number of their own, so pairs travel as two numbers and
the few columns asked for, in one direction.  The joins' shuffles are the
planner's, so AQE splits a key that is too large.  ``near_name_pairs`` is the
same search by deletion variants.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.operators.components import components
from turnstile.operators.edits import one_deleted
from turnstile.operators.segments import near_pairs
from turnstile.session import written

#: People of a name in one row.
TOGETHER = 64


def _delete_one(x: str) -> str:
    """SQL lambda body: every string obtained by deleting one character of x
    (empty array for the empty string, where sequence(1, 0) would count down)."""
    return (f"IF(length({x}) = 0, array(), "
            f"transform(sequence(1, length({x})), i -> concat(substr({x}, 1, i - 1), substr({x}, i + 1))))")


def deletion_variants(col: str, k: int) -> Column:
    """All distinct strings reachable from ``col`` by deleting 0..k characters."""
    if k < 0:
        raise ValueError("k must be >= 0")
    levels = [f"array({col})"]
    cur = f"array({col})"
    for _ in range(k):
        cur = f"array_distinct(flatten(transform({cur}, t -> {_delete_one('t')})))"
        levels.append(cur)
    return F.expr(f"array_distinct(concat({', '.join(levels)}))")


def variant_rows(df: DataFrame, col: str, k: int, out: str = "var") -> DataFrame:
    """``df`` plus one row per distinct deletion variant of ``col`` (0..k
    deletions), for any k.

    Each further deletion explodes the positions from the last one on
    (``explode(sequence(..))`` and ``substr``/``concat``, whole-stage codegen, no
    array of all variants in a row).  Of equal neighbours only the first is
    deleted, counted after the deletions before it, so most repeats are never
    made; the few left only add candidates, which the final distinct removes.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    level = df.withColumn(out, F.col(col)).withColumn("_from", F.lit(1))
    levels = [level]
    for _ in range(k):
        level = one_deleted(level, out)
        levels.append(level)
    return reduce(DataFrame.unionByName, levels).drop("_from")


def near_values(values: DataFrame, col: str, k: int) -> DataFrame:
    """(a, b) for distinct non-NULL values with levenshtein(a, b) <= k,
    including a == b."""
    v = values.select(F.col(col).alias("a")).where(F.col("a").isNotNull()).distinct()
    if k == 0:
        return v.select("a", F.col("a").alias("b"))
    left = variant_rows(v, "a", k)
    right = left.select(F.col("a").alias("b"), "var")
    cand = left.join(right, "var").select("a", "b").distinct()
    return cand.where(F.levenshtein("a", "b", k).between(0, k))


def near_name_pairs(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """Verified pairs of distinct name keys:
    (firstname, lastname, dup_firstname, dup_lastname), both directions,
    including a name paired with itself.

    By deletion variants: many more rows than segments make, but for names so
    alike that a segment selects little (dense account numbers, say) each of
    them brings fewer candidates.  :func:`name_pairs_by_segments` gives the same
    pairs, and is what the reports use."""
    names = (people.where(F.col("firstname").isNotNull() & F.col("lastname").isNotNull())
             .select("firstname", "lastname").distinct())
    near_first = near_values(names, "firstname", k_first).select(
        F.col("a").alias("firstname"), F.col("b").alias("dup_firstname"))
    variants = variant_rows(names, "lastname", k_last)
    right = (variants.select(F.col("firstname").alias("dup_firstname"), F.col("lastname").alias("dup_lastname"),
                             "var"))
    # left: each name key re-addressed to every near first name
    # near_first grows with the distinct first names: Spark's size checks
    # decide whether it is broadcast
    left = (variants.join(near_first, "firstname")
            .select("firstname", "lastname", "dup_firstname", "var"))
    # a join whose shuffles Spark adds itself: AQE splits a hot variant over
    # tasks (it leaves explicit repartitions as they are)
    cand = left.join(right, ["dup_firstname", "var"])
    # both relations are symmetric, so every unordered pair arrives in both
    # orientations: verify one orientation only and mirror afterwards
    one_way = cand.where(F.struct("firstname", "lastname") <= F.struct("dup_firstname", "dup_lastname"))
    verified = (one_way.where(F.levenshtein("lastname", "dup_lastname", k_last).between(0, k_last))
                .select("firstname", "lastname", "dup_firstname", "dup_lastname").distinct())
    fwd = F.struct(F.col("firstname").alias("f"), F.col("lastname").alias("l"),
                   F.col("dup_firstname").alias("df"), F.col("dup_lastname").alias("dl"))
    back = F.struct(F.col("dup_firstname").alias("f"), F.col("dup_lastname").alias("l"),
                    F.col("firstname").alias("df"), F.col("lastname").alias("dl"))
    same = (F.col("firstname") == F.col("dup_firstname")) & (F.col("lastname") == F.col("dup_lastname"))
    both = verified.select(F.explode(F.when(same, F.array(fwd)).otherwise(F.array(fwd, back))).alias("p"))
    return both.select(F.col("p.f").alias("firstname"), F.col("p.l").alias("lastname"),
                       F.col("p.df").alias("dup_firstname"), F.col("p.dl").alias("dup_lastname"))


def _mirrored(pairs: DataFrame, one: list[str], other: list[str]) -> DataFrame:
    """Both directions of pairs that are there in one; a pair with itself stays one."""
    there = F.struct(*[F.col(c).alias(n) for c, n in zip([*one, *other], [*one, *other])])
    back = F.struct(*[F.col(c).alias(n) for c, n in zip([*other, *one], [*one, *other])])
    same = F.struct(*one) == F.struct(*[F.col(c).alias(n) for c, n in zip(other, one)])
    return pairs.select(F.explode(F.when(same, F.array(there)).otherwise(F.array(there, back))).alias("p")).select("p.*")


def values_by_segments(values: DataFrame, col: str, k: int) -> DataFrame:
    """(a, b) for distinct non-NULL values with levenshtein(a, b) <= k,
    including a == b."""
    v = values.select(F.col(col).alias("s")).where(F.col("s").isNotNull()).distinct().withColumn("g", F.lit(0))
    found = near_pairs(v, v.withColumnRenamed("s", "r"), k, v, F.col("r") <= F.col("s"), ["s", "r"])
    return _mirrored(found.select(F.col("s").alias("a"), F.col("r").alias("b")), ["a"], ["b"])


def numbered(names: DataFrame, name: str) -> DataFrame:
    """``names`` with a number for each row (``name_id``), written, so that the numbers stay."""
    return written(names.sparkSession, names.withColumn("name_id", F.monotonically_increasing_id()), name)


def name_links(names: DataFrame, k_first: int = 2, k_last: int = 2, more: tuple[str, ...] = ()) -> DataFrame:
    """Verified pairs of different names from ``names(name_id, firstname, lastname, ...)``, a row per name: ``(x, y)`` in
    one direction, with the columns ``more`` of both as ``x_..`` and ``y_..``."""
    near_first = values_by_segments(names, "firstname", k_first).select(
        F.col("a").alias("firstname"), F.col("b").alias("g"))
    # each name key is indexed under its first name, and looked up under every
    # near one; near_first grows with the distinct first names, so Spark's size
    # checks decide whether it is broadcast
    index = names.select(F.col("firstname").alias("g"), F.col("lastname").alias("r"), F.col("name_id").alias("y"),
                         *[F.col(c).alias(f"y_{c}") for c in more])
    sought = names.join(near_first, "firstname").select("g", F.col("lastname").alias("s"), F.col("name_id").alias("x"),
                                                        *[F.col(c).alias(f"x_{c}") for c in more])
    # few first names deal the rows to few tasks, and each row becomes many keys
    sought = sought.repartition("x")
    last = names.select(F.col("lastname").alias("s")).distinct()
    # of two names of equal length both find each other: one of them is enough
    return near_pairs(sought, index, k_last, last, F.col("y") < F.col("x"), ["x", "y", *[f"{e}_{c}" for e in "xy" for c in more]])


def both_ways(links: DataFrame) -> DataFrame:
    """The rows of ``links``, and again with all ``x`` and ``y`` columns changed over."""
    other = {c: ("y" if c[0] == "x" else "x") + c[1:] for c in links.columns}
    ways = [F.struct(*links.columns), F.struct(*[F.col(other[c]).alias(c) for c in links.columns])]
    return links.select(F.inline(F.array(*ways)))


def _names(people: DataFrame) -> DataFrame:
    """A row per different whole name, with how many people have it."""
    return (people.where(F.col("firstname").isNotNull() & F.col("lastname").isNotNull())
            .groupBy("firstname", "lastname").agg(F.count(F.lit(1)).alias("heads")))


def name_pairs_by_segments(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """Verified pairs of distinct name keys:
    (firstname, lastname, dup_firstname, dup_lastname), both directions,
    including a name paired with itself."""
    names = numbered(_names(people), "names")
    whole = ("firstname", "lastname")
    pairs = both_ways(name_links(names, k_first, k_last, whole)).select(
        F.col("x_firstname").alias("firstname"), F.col("x_lastname").alias("lastname"),
        F.col("y_firstname").alias("dup_firstname"), F.col("y_lastname").alias("dup_lastname"))
    return pairs.unionByName(names.select(*whole, *[F.col(c).alias(f"dup_{c}") for c in whole]))


def _people_by_name(people: DataFrame) -> DataFrame:
    """The people of each different whole name, some ``TOGETHER`` in a row, numbered: ``(firstname, lastname, ids, name_id)``."""
    p = people.select(F.col("idperson").alias("id"), "firstname", "lastname").join(_names(people), ["firstname", "lastname"])
    some = p.groupBy("firstname", "lastname", F.pmod(F.xxhash64("id"), F.ceil(F.col("heads") / TOGETHER)).alias("part"))
    return numbered(some.agg(F.collect_list("id").alias("ids")).drop("part"), "names")


def near_duplicates(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """DUP1 flat form: ordered pairs of different people whose first names are
    within ``k_first`` and last names within ``k_last`` edits (both
    directions, case-sensitive, NULL names never match).  ``k = 0`` and
    ``0`` finds exact matches only.

    Each row of a name brings its people along, so no pair of names travels
    again to meet them."""
    names = _people_by_name(people)
    more = ("firstname", "lastname", "ids")
    ends = [F.col(c).alias(f"{e}_{c}") for e in "xy" for c in more]
    own = names.where(F.size("ids") > 1).select(F.col("name_id").alias("x"), F.col("name_id").alias("y"), *ends)
    pairs = both_ways(name_links(names, k_first, k_last, more)).unionByName(own)
    out = (pairs.select(F.explode("x_ids").alias("id"), "x_firstname", "x_lastname", "y_ids", "y_firstname", "y_lastname")
           .select("id", F.col("x_firstname").alias("firstname"), F.col("x_lastname").alias("lastname"), F.explode("y_ids").alias("dup_id"),
                   F.col("y_firstname").alias("dup_firstname"), F.col("y_lastname").alias("dup_lastname")))
    return out.where(F.col("id") != F.col("dup_id"))


def near_duplicate_counts(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """Per person, how many other people are near duplicates, computed on
    name keys with head counts: a name held by millions of people is never
    expanded into pairs."""
    names = numbered(_names(people), "names")
    near = both_ways(name_links(names, k_first, k_last, ("heads",))).groupBy(F.col("x").alias("name_id")).agg(F.sum("y_heads").alias("near"))
    per_name = names.join(near, "name_id", "left").select(
        "firstname", "lastname", (F.col("heads") + F.coalesce("near", F.lit(0))).alias("near_heads"))
    p = people.select(F.col("idperson").alias("id"), "firstname", "lastname")
    # minus one: the person itself is counted under its own name key
    return (p.join(per_name, ["firstname", "lastname"])
            .select("id", "firstname", "lastname", (F.col("near_heads") - 1).cast("bigint").alias("dups"))
            .where(F.col("dups") > 0))


def exact_duplicates(people: DataFrame) -> DataFrame:
    """DUP2: people whose (first, last) name is held by more than one person
    (FIL8 tuple IN as a left semi join, FIL9 HAVING count > 1)."""
    keys = (people.where(F.col("firstname").isNotNull() & F.col("lastname").isNotNull())
            .groupBy("firstname", "lastname").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("firstname", "lastname"))
    return (people.join(keys, ["firstname", "lastname"], "left_semi")
            .select("idperson", "firstname", "lastname")
            .orderBy("lastname", "firstname", "idperson"))


def name_classes(people: DataFrame) -> DataFrame:
    """One row per different name: ``class_id`` (its least person), the name, and how many people have it."""
    return (people.where(F.col("firstname").isNotNull() & F.col("lastname").isNotNull())
            .groupBy("firstname", "lastname")
            .agg(F.min("idperson").alias("class_id"), F.count(F.lit(1)).cast("bigint").alias("heads"))
            .select("class_id", "firstname", "lastname", "heads"))


def class_links(people: DataFrame, k_first: int = 2, k_last: int = 2) -> tuple[DataFrame, DataFrame]:
    """``(classes, links)``, both written: name classes, and ``(x, y, x_heads, y_heads)`` for every two near ones, one way."""
    classes = numbered(name_classes(people), "name_classes")
    links = (name_links(classes, k_first, k_last, ("class_id", "heads"))
             .select(F.col("x_class_id").alias("x"), F.col("y_class_id").alias("y"), "x_heads", "y_heads").where("x != y"))
    return classes.drop("name_id"), written(people.sparkSession, links, "class_links")


def duplicate_classes(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """AG12 in bounded form: per different name its people, its near names with their people, and its group (the least
    class that can be reached over near names).  Output is linear in the names."""
    classes, links = class_links(people, k_first, k_last)
    near = (both_ways(links).groupBy(F.col("x").alias("class_id"))
            .agg(F.count(F.lit(1)).alias("near_classes"), F.sum("y_heads").alias("near_heads")))
    groups = components(links.select("x", "y")).select(F.col("node").alias("class_id"), "comp")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (classes.join(near, "class_id", "left").join(groups, "class_id", "left")
            .select("class_id", "firstname", "lastname", "heads", zero("near_classes"), zero("near_heads"),
                    F.coalesce("comp", "class_id").alias("group_id")))


def duplicate_groups(people: DataFrame, k_first: int = 2, k_last: int = 2) -> DataFrame:
    """Membership: per person with a whole name its class, its group, and how many people the group has."""
    classes, links = class_links(people, k_first, k_last)
    groups = components(links.select("x", "y")).select(F.col("node").alias("class_id"), "comp")
    of = written(people.sparkSession, classes.join(groups, "class_id", "left")
                 .withColumn("group_id", F.coalesce("comp", "class_id")).drop("comp"), "class_groups")
    sizes = of.groupBy("group_id").agg(F.sum("heads").cast("bigint").alias("group_heads"))
    # one row per name: a name that a third of all people have is one row on this side
    names = of.join(sizes, "group_id").select("firstname", "lastname", "class_id", "group_id", "group_heads")
    return people.select("idperson", "firstname", "lastname").join(names, ["firstname", "lastname"]).select("idperson", "class_id", "group_id", "group_heads")
