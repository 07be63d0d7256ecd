"""Global positions and top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import shared_root

_POSITION_BITS = 33


def with_global_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in ``order`` without bringing them together in one task.

    The rows are range-sorted and checkpointed, so that partitions and their order are
    fixed. Within a partition the position is the low part of
    ``monotonically_increasing_id``; the start of each partition is a running sum over
    one row per partition, which is also all that is broadcast.
    """
    shared_root(df.sparkSession)
    numbered = (
        df.orderBy(*order)
        .checkpoint()
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumns(
            {
                "__part": F.shiftright("__at", _POSITION_BITS),
                "__at": F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
            }
        )
    )
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("__part")
        .agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    )
    return numbered.join(F.broadcast(starts), "__part").select(
        *df.columns, (F.col("__start") + F.col("__at")).alias(name)
    )


def sample_per_group(df: DataFrame, group: str, key: Sequence[str], k: int) -> DataFrame:
    """``k`` rows of each group, those with the smallest digests of ``key``; all of a smaller group.

    The same rows whatever the partitions are. Each task hands on at most ``k`` rows of a group, so nothing is sorted or
    gathered whole. Rows of one key stand in the order of the key's columns; equal ones may stand for each other.
    """
    digest = F.md5(F.concat_ws("\x1f", *[F.col(name).cast("string") for name in key]))
    return top_per_group(df, group, [digest, *[F.col(name) for name in key]], k, "__rank").drop("__rank")


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts to ``k`` before the shuffle as well."""
    position = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, position.cast("long")).filter(F.col(rank) <= k)
