"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """``links(x long, y long)`` -> ``(node, comp)``: every node of a link with the smallest node it reaches.

    Each round takes the least label among a node and its neighbours, then the label of that label.  The rounds go
    as the logarithm of the longest path; each writes its labels to the shared folder.  Loops and repeated links
    do no harm; no links give no rows.
    """
    both = stored(links.select("x", "y").union(links.select("y", "x")).where("x != y").distinct(), "links")
    labels = stored(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "comp"), "y").groupBy(F.col("x").alias("node")).agg(F.min("comp").alias("near"))
        least = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        least = stored(least, "labels")
        of = least.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        after = stored(least.join(of, "comp").select("node", F.col("further").alias("comp"), (F.col("further") != F.col("was")).alias("moved")), "labels")
        labels = after.select("node", "comp")
        if not after.where("moved").limit(1).count():
            return labels
