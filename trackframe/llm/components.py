"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: u, v (longs, undirected, repeats and loops allowed) -> id, root: the least id of its component.

    Each round takes the least label of a node's neighbours and then of the label's own node, so that long chains
    halve. Labels are cut from their lineage every round; only the count of changed labels reaches the driver. Joins on
    a node that is many others' label or neighbour are left to adaptive execution, which splits such partitions.
    """
    both = checkpointed(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = checkpointed(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("root")))
    while True:
        of = labels.select(F.col("id").alias("v"), F.col("root").alias("other"))
        least = both.join(of, "v").groupBy(F.col("u").alias("id")).agg(F.min("other").alias("other"))
        near = labels.join(least, "id").select("id", F.col("root").alias("was"), F.least("root", "other").alias("mid"))
        near = checkpointed(near)
        up = near.select(F.col("id").alias("mid"), F.col("mid").alias("far"))
        new = checkpointed(near.join(up, "mid").select("id", "was", F.least("mid", "far").alias("root")))
        if new.where("root <> was").isEmpty():
            return new.select("id", "root")
        labels = new.select("id", "root")
