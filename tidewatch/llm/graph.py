"""Connected components of a link table by alternating stars, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage


def _round(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (a, b) with a > b.

    large: every larger neighbour of a node is linked to the smallest neighbour; small: every
    smaller neighbour and the node itself are. Minima are merged before the shuffle, so a hub
    costs no more than its links.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["node"])
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b"))))
    out = out.where("a > b")
    return out if large else out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node in `edges` (a, b long); component is the smallest id reachable.

    Links in either direction, repeated links and self links are fine; nulls are ignored.
    """
    now = cut_lineage(edges.where("a is not null and b is not null and a != b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        now = cut_lineage(_round(_round(now, True), False), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    return (now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
            .unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
            .groupBy("id").agg(F.min("component").alias("component")))
