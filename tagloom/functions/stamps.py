"""Hour-truncated batch stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the text form of a batch stamp, as a Spark datetime pattern.
STAMP_FORMAT = "yyyy_MM_dd_HH"


def current_batch() -> Column:
    """The running hour, taken once per query by Spark."""
    return F.date_trunc("hour", F.current_timestamp())


def batch_stamp(batch: datetime | str | None = None) -> Column:
    """A batch stamp from text, from a moment (cut to its hour) or from the clock."""
    if batch is None:
        return current_batch()
    if isinstance(batch, datetime):
        return F.date_trunc("hour", F.lit(batch))
    return F.to_timestamp(F.lit(batch), STAMP_FORMAT)


def resolve_batch(spark: SparkSession, batch: datetime | str | None = None) -> str:
    """The batch as stamp text, so that all steps of a run use the same hour."""
    return spark.range(1).select(F.date_format(batch_stamp(batch), STAMP_FORMAT)).first()[0]
