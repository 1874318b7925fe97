"""Connected components of a graph given as links, by rounds of large-star and small-star (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.tables import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hangs the neighbours of each node onto its smallest neighbour: the larger ones, or the others and the node itself.

    The smallest neighbour is a grouped minimum and comes back by a join, which can be split where a node has very
    many neighbours; no neighbourhood is ever collected.
    """
    if large:
        ends = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    pairs = ends.join(least, "u")
    if large:
        moved = pairs.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = pairs.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node that can be reached.

    Ends when a whole round changes nothing. Each round is a stored table, so a lost executor costs one round. Links
    from a node to itself, repeated links and links with a missing end are fine; the last are left out.
    """
    links = stored(links.where("a <> b").distinct())
    before = None
    while True:
        links = stored(_star(_star(links, large=True), large=False))
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
