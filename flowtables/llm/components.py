"""Connected components by alternating large and small stars.

Every round replaces links by links to smaller nodes until each component is a star around
its smallest node. A round is two groupings (with map-side minima) and two joins, whatever
the shape of the components. A node with more than a million links, a hub, would draw them all
into one task of a join; hubs are few by definition, so they are broadcast and their links stay
where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import staged


#: A node is a hub only with more than this part of all links, so that at most so many are broadcast.
HUB_PART = 10_000
#: And with more links than this, which a task of a join takes in its stride (some 50 MB).
HUB_LINKS = 1_000_000


def _with_least(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``links`` (a, b) with the smallest node ``m`` around a; ``least`` has (a, m, n), n being the links of a."""
    if total <= HUB_LINKS:
        return links.join(least.select("a", "m"), "a")
    limit = max(HUB_LINKS, total // HUB_PART)
    hubs = F.broadcast(least.where(F.col("n") > limit).select("a", "m"))
    rest = least.where(F.col("n") <= limit).select("a", "m")
    return links.join(hubs, "a").unionByName(links.join(hubs, "a", "left_anti").join(rest, "a"))


def _large(links: DataFrame, total: int) -> DataFrame:
    """Links of every node's larger neighbours to the smallest node around it."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    return _with_least(both.where("b > a"), least, total).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(links: DataFrame, total: int) -> DataFrame:
    """Links of every node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    other = _with_least(down, least, total).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return other.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Every node has one link to a smaller one, which has none: nothing can change any more."""
    roles = links.groupBy("a").agg(F.count("*").alias("down"), F.lit(0).alias("up")).unionByName(links.select(F.col("b").alias("a"), F.lit(0).cast("long").alias("down"), F.lit(1).alias("up")).distinct())
    each = roles.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return each.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the label is its component's smallest node.

    Links of a node with itself and repeated links do nothing; no links give no rows.
    """
    links = staged(links.where("a <> b").select("a", "b"), "links")
    total, stars = links.count(), False
    while total and not stars:
        links = staged(_small(_large(links, total), total), "stars")
        stars = _are_stars(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
