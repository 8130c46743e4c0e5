"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import park, parts

#: Links of one node that are nothing special, on any cluster.
FEW = 100_000


def with_least(rows: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """rows (u, v) with m, from least (u, m, n: the links of u).

    Nodes of more than limit links, the centres of large stars, are joined by broadcast, so their rows stay
    where they are; there are at most (links / limit) of them, which follows the cluster, not the data.
    """
    plain = lambda x: x.join(least.select("u", "m"), "u")
    if not limit:
        return plain(rows)
    hot = park(least.where(F.col("n") > limit).select("u", "m"), "centres")
    if hot.isEmpty():
        return plain(rows)
    return rows.join(F.broadcast(hot), "u").unionByName(plain(rows.join(F.broadcast(hot.select("u")), "u", "left_anti")))


def components(links: DataFrame, most_rounds: int = 60, few: int = FEW) -> DataFrame:
    """links: a, b (long). Per id in a link: doc_id, component_id (smallest id reachable).

    Each round is a constant number of shuffles over as many rows as there are links; the number of
    rounds is logarithmic in the number of ids. Every round is written to the shared folder. No
    group of neighbours is gathered: both steps are a minimum per key, joined back.
    """
    edges = park(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before, tasks = None, 16 * parts(links.sparkSession)
    total = edges.count()
    for _ in range(most_rounds):
        # no node can have more links than there are
        limit = 0 if 2 * total <= few else max(few, 2 * total // tasks)
        # large star: the larger neighbours of each node link to its smallest neighbour (or itself)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = with_least(both.where("v > u"), least, limit).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = park(large, "large") if limit else large
        # small star: the smaller neighbours of each node, and itself, link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = with_least(large, least, limit).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = park(small, "edges")
        # a node set that is all stars has every node once on the left and no centre on the left
        now = edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before, total = tuple(now), now[0]
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    named = edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))
    return named.union(edges.select(F.col("v"), F.col("v")).distinct())
