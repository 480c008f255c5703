"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import shared_table


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of ``u`` to the smallest of u and its neighbours: the
    larger neighbours in a large step, the smaller ones and u in a small step."""
    turned = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = pairs.unionByName(turned) if large else pairs
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    met = near.join(least, F.col("u") == F.col("c"))  # a hot centre's rows are split as skewed join rows
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.where("c <> m").select(F.col("c").alias("u"), F.col("m").alias("v"))
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node) of every node in ``links`` (a, b).

    Each round writes the links that are left to the shared folder; their number
    never grows, and the rounds grow with the logarithm of a component's
    diameter. Only a count and a checksum reach the driver.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, seen = shared_table(pairs, "links"), None
    while True:
        found = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if found == seen or not found[0]:
            break
        seen = found
        pairs = shared_table(_star(_star(pairs, True), False), "links")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
