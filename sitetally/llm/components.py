"""Connected components of a table of links, by alternating large-star and small-star rounds (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def _are_stars(links: DataFrame) -> bool:
    """Whether every ``u`` has one link and is no other's ``v``."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("below")).unionByName(links.select("v", F.lit(0)).toDF("id", "below"))
    found = ends.groupBy("id").agg(F.max("below").alias("below"), F.count("*").alias("n"))
    return found.where("below = 1 and n > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component`` (smallest id reachable) for every id that has a link to another one.

    Each round replaces links by links to smaller ids; the links end as stars around the smallest id of each component, and are
    known as stars by one count. Both halves of a round deal the links once by id and stream them against their smallest
    neighbour; no group is gathered. Rounds are logarithmic in the longest path, and each is a written table. NULL ids link
    nothing.
    """
    kind = links.schema[a].dataType
    links = links.select(F.greatest(a, b).cast(kind).alias("u"), F.least(a, b).cast(kind).alias("v"))
    links = saved(links.where("u is not null and v is not null and u != v").distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
        low = _lowest(both).select("u", F.least("low", "u").alias("low"))
        # one row a link at most: equal ones go in the other half
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).repartition("u")
        down = large.join(_lowest(large), "u")
        small = (down.select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(down.select("u", F.col("low").alias("v"))).where("u != v").distinct())
        links = saved(small, "links")
        if _are_stars(links):
            break
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
