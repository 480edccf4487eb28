"""Connected components of a table of links, by alternating stars (Kiveris et al. 2014).

A large star points every greater neighbour of a node at the least node it sees; a small star points a node and its lesser
neighbours at the least of them.  Both keep components and only lessen ends, so links never get more, and they end as one
star around the least node of each component.  The number of rounds grows with the logarithm of the longest path.

Links may be many times as many as nodes, so the stars run on a link per node first, the one to its least neighbour.  What
of the links then still joins different components is between these, at most half as many as nodes, and goes through the
stars again.  All links are read twice, whatever the number of rounds.

Each round is a grouped minimum and an equi-join, and is written to the shared folder, which cuts lineage and survives
lost executors.  No node's links are ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.session import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("y", "x"))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("least"))
    return both.where("y > x").join(least, "x").where("y != least").select(F.col("y").alias("x"), F.col("least").alias("y")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the greater node to the lesser."""
    least = links.groupBy("x").agg(F.min("y").alias("least"))
    moved = links.join(least, "x").where("y != least").select(F.col("y").alias("x"), F.col("least").alias("y"))
    return moved.union(least.select("x", F.col("least").alias("y"))).distinct()


def _stars(links: DataFrame) -> DataFrame:
    """``(node, comp)`` of every node of ``links(x, y)``, which have no loops and no nulls."""
    spark = links.sparkSession
    now = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    now, mark = written(spark, now, "links"), None
    while True:
        now = written(spark, _small_star(_large_star(now)), "stars")
        # stars that don't change any more, told by count and two sums of hashes
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.sum(F.hash("y", "x").cast("long"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("x").alias("node"), F.col("y").alias("comp")).union(now.select("y", "y").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links(x, y)`` of one orderable type -> ``(node, comp)``: every linked node with the least node it reaches.

    Direction, repeats and loops make no difference; nodes that are in loops alone, and nulls, don't come out.  ``links`` is
    evaluated twice."""
    spark = links.sparkSession
    links = links.where("x != y")
    ways = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    first = _stars(links.select(F.inline(ways)).groupBy("x").agg(F.min("y").alias("y")))
    x, y = (first.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp")) for c in "xy")
    rest = written(spark, links.join(x, "x").join(y, "y").where("x_comp != y_comp")
                   .select(F.col("x_comp").alias("x"), F.col("y_comp").alias("y")).distinct(), "links")
    if rest.isEmpty():
        return first
    second = _stars(rest).select(F.col("node").alias("comp"), F.col("comp").alias("least"))
    return first.join(second, "comp", "left").select("node", F.coalesce("least", "comp").alias("comp"))
