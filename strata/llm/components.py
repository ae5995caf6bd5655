"""Connected components of a link table, by alternating star contraction.

Each round links every node's larger neighbours to the smallest node it knows
(large star), then its smaller neighbours (small star).  Rounds are joins and
partial aggregations over the link table; it never gains rows, a few rounds
reach the fixed point even for long chains (their number grows with the
logarithm of the number of links), and nothing but two numbers per round
reaches the driver.  Minima are stored before they are joined, so both join
sides are plain exchanges that adaptive execution can split where one node
holds a large part of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _fixed(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the undirected links ``a`` - ``b``; the
    root is the smallest node of its component.  Nodes without a link to
    another node do not occur."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = stored(links.where(F.col(a) != F.col(b))
                 .select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    state = _fixed(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy(F.col("u").alias("c")).agg(
            F.least("c", F.min("v")).alias("m")), "least")
        large = (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("c"))
                 .where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large")
        least = stored(large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "least")
        small = large.join(least, F.col("u") == F.col("c")).select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.*").where(F.col("u") != F.col("v")).distinct(), "links")
        new = _fixed(now)
        if new == state:
            break
        state = new
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
