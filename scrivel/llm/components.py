"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivel.llm.landing import landed


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the smallest one in its neighbourhood."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of these."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    lower = links.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return lower.unionByName(least.select("hi", F.col("m").alias("lo")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``node, component`` for every node of the undirected ``links``; the component is its
    smallest node.

    Links to itself or with a null end are dropped, repeated links count once; no link gives no row.
    Every round is a table in the shared folder, so lineage stays short. Minima are combined before
    the shuffle; hubs meet their links in joins that adaptive execution may split.
    """
    pair = links.filter(F.col(a) != F.col(b))
    stars = landed(
        pair.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links"
    )
    before, now = None, _state(stars)
    while now != before:
        stars = landed(_small_star(_large_star(stars).distinct()).distinct(), "links")
        before, now = now, _state(stars)
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
