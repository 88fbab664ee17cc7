"""Connected components of a table of links, by alternating stars.

Every round hangs each node's larger neighbours on its smallest neighbour and
then does the same for the smaller ones; the links end as stars around the
smallest node of each component after a number of rounds that grows with the
logarithm of the longest path.  Nothing but two numbers a round reaches the
driver; each round's links are a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.session import written


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns a, b, of longs).

    The component is its smallest node.  Nulls, loops and repeated links add
    nothing; an empty table gives an empty table.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).withColumn("m", F.least("u", "w")).drop("w")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = written(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        was, state = state, _state(now)
        if state == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
