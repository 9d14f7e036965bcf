"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.textcore import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node reachable, for every node in a link.

    Rounds of smallest-neighbour labels and pointer jumping (the label of the
    label) until none changes; a label travels at least twice as far each
    round it lies on a chain. Each round is written to the shared folder, so
    the lineage is cut and nothing but the count of changes reaches the driver.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    pairs = stored(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
                   .distinct(), "links")
    labels = stored(pairs.groupBy(F.col("x").alias("node"))
                    .agg(F.min("y").alias("low"))
                    .select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        seen = (pairs.join(labels, pairs["y"] == labels["node"])
                .groupBy("x").agg(F.min("comp").alias("near")))
        lower = (labels.join(seen, labels["node"] == seen["x"])
                 .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")))
        # the label of the label: every label is a node of its own component
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("further"))
        after = stored(lower.join(jump, lower["comp"] == jump["at"])
                       .select("node", "was", F.least("comp", "further").alias("comp")), "labels")
        changed = after.where("was <> comp").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels
