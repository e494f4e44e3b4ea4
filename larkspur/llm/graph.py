"""Connected components of an edge table, by joins and combined aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. 2014: each
    node hangs its neighbours on the smallest node it knows, until all edges are
    stars. Neighbourhoods are never collected, only their minimum; each round is
    written to the shared folder. Null ends and loops are ignored, repeated
    edges count once, and an empty table gives an empty one.
    """
    down = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
    while True:
        # an edge whose root hangs on something else means the stars are not done
        open_edges = down.join(down.select(F.col("node").alias("root")).distinct(), "root", "left_semi")
        twice = down.groupBy("node").count().where("count > 1")
        if open_edges.isEmpty() and twice.isEmpty():
            return down
        both = down.unionByName(down.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m"))
        large = (
            both.where("root > node").join(least, "node")
            .select(F.col("root").alias("node"), F.least("m", "node").alias("root"))
        )
        large = cut(large.where("node <> root").distinct())
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(least, "node")
        down = cut(
            small.select(F.col("root").alias("node"), F.col("m").alias("root"))
            .unionByName(least.select("node", F.col("m").alias("root")))
            .where("node <> root").distinct()
        )
