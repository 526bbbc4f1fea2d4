"""Connected components of a link table, by joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node.

    Each round every node takes the smallest label around it, then the label of
    its label (which halves long chains); rounds end when no label changes.
    Each round is written to the shared folder, so a lost executor costs one round.
    """
    one = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src <> dst")
    edges = settled(one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    labels = settled(edges.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("label")).select(F.col("src").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("label").alias("around"))
        low = labels.join(near, F.col("node") == F.col("src")).select("node", F.col("label").alias("was"), F.least("label", "around").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("higher"))
        new = low.join(up, "low").select("node", "was", F.least("low", "higher").alias("label"))
        new = settled(new, "labels")
        labels = new.select("node", "label")
        if new.where("label <> was").limit(1).count() == 0:
            return labels.select("node", F.col("label").alias("component"))
