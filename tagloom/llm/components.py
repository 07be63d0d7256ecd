"""Connected components of a graph of links, as repeated joins over stored edges.

Rounds of large star and small star: every node hands its larger neighbours the smallest
node that it knows, then its smaller ones. The number of rounds grows with the logarithm of
the longest chain. Each round is written to the shared folder. Minima are stored before
they are joined, so that both sides of a join have exchanges of their own and adaptive
execution can split the edges of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.frames import staged


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame, rows: int) -> DataFrame:
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m"), "least", rows)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` for every node that a link (``u, v``) touches other than the roots themselves.

    The root is the smallest node of the component. ``rows`` bounds the links, if known. Links may repeat, point either way, or
    join a node with itself. No links give no rows.
    """
    edges = staged(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", rows
    )
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        count = 2 * before[0]
        least = _least(both, count)
        large = staged(
            both.filter("v > u").join(least, F.col("u") == F.col("node"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(),
            "large-star", count,
        )
        least = _least(large, count)
        edges = staged(
            large.join(least, F.col("u") == F.col("node"))
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct(),
            "small-star", count,
        )
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
