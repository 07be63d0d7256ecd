"""The users dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.stamps import batch_stamp
from tagloom.schemas import USERS_DIM

# User columns that are not published.
UNPUBLISHED = ("Age", "EmailHash", "WebsiteUrl")


def build_users_dim(users: DataFrame, batch: datetime | str | None = None) -> DataFrame:
    """Published user columns with year and month of joining and the time of processing."""
    derived = users.drop(*UNPUBLISHED).withColumns(
        {
            "Year": F.year("CreationDate"),
            "Month": F.month("CreationDate"),
            "processing_datetime_stamp": batch_stamp(batch),
        }
    )
    return derived.select(*USERS_DIM.fieldNames())
