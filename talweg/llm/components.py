"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talweg.llm import _common as c


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of numbers -> (node, label): label is the smallest number that is linked with node, directly or not. Nodes that are their own label have no row.

    Alternating star contraction: every node passes its larger, then its smaller neighbours on to the smallest one, until
    only stars are left; the number of rounds grows with the logarithm of a component's size. Each round is cut off.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges, before = c.cut(edges), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = c.cut(small.distinct())
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
