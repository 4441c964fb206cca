"""Connected components: labels sink to the smallest neighbour's, and to their own label's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges`` (i, j).

    A round takes the least label among a node and its neighbours and then follows that label
    once more, which doubles the distance that labels travel. Minima are merged before their
    shuffle, so a node may have any number of neighbours.
    """
    both = cut_lineage(edges.select("i", "j").union(edges.select("j", "i")).distinct())
    labels = cut_lineage(both.groupBy(F.col("i").alias("node")).agg(F.least(F.min("j"), F.col("node")).alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "j"), "j").groupBy(F.col("i").alias("node")).agg(F.min("root").alias("least"))
        sunk = labels.join(near, "node").select("node", F.least("root", "least").alias("next"), "root")
        ahead = labels.select(F.col("node").alias("next"), F.col("root").alias("further"))
        moved = cut_lineage(
            sunk.join(ahead, "next").select("node", F.col("further").alias("now"), (F.col("root") != F.col("further")).alias("moved"))
        )
        labels = moved.select("node", F.col("now").alias("root"))
        if moved.filter("moved").isEmpty():
            return labels
