"""Connected components of links that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.texts import checkpointed


def _arcs(links: DataFrame) -> DataFrame:
    """Both directions of each link between two nodes."""
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's least neighbour instead."""
    arcs = _arcs(links)
    least = arcs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return arcs.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b")
    return tied.unionAll(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the component's least node.

    Alternates two star steps until the links stop changing, about log(nodes)
    rounds. Each round is written to the shared folder, so lineage stays short.
    A hub's neighbours are counted by partial aggregation and split by adaptive
    joins; no group is gathered. Self links and repeated links are harmless.
    """
    now = checkpointed(links.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        now = checkpointed(_small_star(_large_star(now)), "links")
        after = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after == state:
            break
        state = after
    return now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).unionAll(
        now.select(F.least("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
