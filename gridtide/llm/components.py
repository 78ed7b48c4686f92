"""Connected components of a graph held as a frame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table

SALTS = 16
# Rows up to which a side of a join may go through the driver to all tasks.
BROADCAST_ROWS = 20_000


def shuffled_if_large(side: DataFrame, rows: int) -> DataFrame:
    """A side of a join that has up to ``rows`` rows. A larger one is always
    shuffled: Spark would choose by its compressed size or by that before an
    explode, of which a broadcast can take many times as much of the driver."""
    return side if rows <= BROADCAST_ROWS else side.hint("merge")


def _least_neighbour(links: DataFrame, rows: int) -> DataFrame:
    """Each directed link (u, v) with m, the least of u's neighbours and u. Few
    of them (of ``rows`` links at most) go to all tasks; of more, a node with
    very many links is dealt over ``SALTS`` tasks in the join."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if rows <= BROADCAST_ROWS:
        return links.join(F.broadcast(least), "u").select("u", "v", "m")
    dealt = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = links.withColumn("salt", F.pmod(F.hash("v"), F.lit(SALTS)))
    return shuffled_if_large(salted, rows).join(shuffled_if_large(dealt, rows), ["u", "salt"]).select("u", "v", "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node it can reach, for every node
    that has a link to another.

    Alternates two rounds until no link changes, which takes a number of
    rounds that grows with the logarithm of the graph: every node hangs its
    greater neighbours on the least one, then itself and its smaller
    neighbours. Each round's links are written to the shared folder. Links with
    a null end and links of a node to itself are ignored. No round sends more
    than ``BROADCAST_ROWS`` rows through the driver, and neither does a join
    with the result.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    links = keep_table(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state, rows = None, links.count()
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both, 2 * rows).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _least_neighbour(large, 2 * rows)
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        links = keep_table(hung.filter("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        rows = now[0]
        if now == state:
            found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
            return shuffled_if_large(found, 2 * rows)
        state = now
