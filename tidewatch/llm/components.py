"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, label`` (smallest node reachable) for every node of ``links(a, b)``.

    Every round takes the smallest label among a node and its neighbours, then
    follows labels of labels once, so chains shorten geometrically.  The table
    is written to the shared folder after each round; nothing but the number of
    changed rows reaches the driver.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .where("a <> b").distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m"))
                 .select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        new = labels.join(near, "node").select("node", F.least("label", "m").alias("l2"),
                                               F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("l2"), F.col("label").alias("m2"))
        new = cut(new.join(jump, "l2", "left")
                  .select("node", F.least("l2", F.coalesce("m2", "l2")).alias("label"), "old"))
        if not new.where("label <> old").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
