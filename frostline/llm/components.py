"""Connected components of a graph given as links, by alternating stars.

Large-star and small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) turn the links into stars around each component's
smallest node.  Every round is a join and an aggregate over links; neither
links nor components reach the driver, only a count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def smallest_in_component(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for each node that has a link and is not its component's smallest.

    Self-links and repeated links are ignored.  Each round's links go to the
    shared checkpoint folder, so a lost executor costs one round at most.
    """
    ensure_checkpoint_dir(links.sparkSession)
    low, high = F.least(a, b), F.greatest(a, b)
    stars = links.select(high.alias("node"), low.alias("root")).where("node != root").distinct().checkpoint()
    state = _state(stars)
    while True:
        stars = _small_star(_large_star(stars)).checkpoint()
        before, state = state, _state(stars)
        if state == before:
            return stars


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root")), F.sum(F.hash("node", "root"))).first()
    return tuple(r)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with the smallest of all its neighbours and itself."""
    both = links.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links.select("root", "node"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("node"), F.col("m").alias("root")).where("node != root").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked with the smallest of them."""
    least = links.groupBy("node").agg(F.min("root").alias("m"))
    inner = links.join(least, "node").select(F.col("root").alias("node"), F.col("m").alias("root")).where("node != root")
    return inner.union(least.select("node", F.col("m").alias("root"))).distinct()
