"""Connected components of links between 64-bit nodes, by alternating star contraction.

Each round joins the links with the smallest neighbour of one end and rewrites them to point
there, first towards larger neighbours (large star), then towards smaller ones (small star),
until the links are stars around the smallest node of each component. Links and minima are
written tables, so a round survives lost executors and a hub's rows can be split by adaptive
execution; nothing but a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.session import materialize


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def _towards_smallest(links: DataFrame, small: bool) -> DataFrame:
    """``links`` (a, b with a > b) rewritten to the smallest node around each centre."""
    if small:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    smallest = materialize(around.groupBy("u").agg(F.min("v").alias("m"))
                           .select("u", F.least("u", "m").alias("m")), "star-minima")
    met = around.join(smallest, "u")
    if small:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return materialize(out.filter("a <> b").distinct(), "star-links")


def components(links: DataFrame) -> DataFrame:
    """``links`` has two long columns a and b (any order, repeats allowed, a <> b). Returns
    ``node, root`` for each linked node, ``root`` the smallest node of its component."""
    links = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "star-links")
    before = None
    while True:
        now = _checksum(links)
        if now == before or now[0] == 0:
            break
        before = now
        links = _towards_smallest(_towards_smallest(links, small=False), small=True)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
