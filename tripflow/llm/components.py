"""Connected components of a table of links, by passing on the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import written


def connected(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id that
    ``links`` (a, b) name. Each round takes the smallest label among neighbours,
    combined on the map side, and then the label's own label, so long chains
    shorten by half. Rounds are written to the shared folder."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("was"), F.least("component", "near").alias("c"))
        of = labels.select(F.col("id").alias("c"), F.col("component").alias("jump"))
        now = written(lower.join(of, "c", "left").select("id", "was", F.least("c", F.coalesce("jump", "c")).alias("component")), "labels")
        labels = now.select("id", "component")
        if now.where("was <> component").limit(1).count() == 0:
            return labels
