"""File writers: checkpoints, quoted CSV, compacted copies and full refreshes."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame

from tagloom.sources.files import KEEP_VALUES, delete_folder, folder_bytes, replace_folder

TARGET_FILE_BYTES = 256 << 20
CSV_ROWS_PER_FILE = 1_000_000


def checkpoint_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as snappy Parquet and return it as read back, with its lineage cut.

    Each task writes its own file; nothing is funnelled into one.
    """
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, every value quoted, ``\\`` as escape and files that one task can read.

    Blanks at the ends of a value, empty strings and nulls read back as they were.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .option("quoteAll", True)
        .options(**KEEP_VALUES)
        .option("maxRecordsPerFile", CSV_ROWS_PER_FILE)
        .csv(path)
    )


def compact_copy(df: DataFrame, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Copy ``df``, read from ``source``, into files of about ``file_bytes``; returns their number.

    The number follows from the size of the source. ``coalesce`` joins the small input
    splits in place, so the copy has no shuffle; the target is replaced.
    """
    files = max(1, math.ceil(folder_bytes(df.sparkSession, source) / file_bytes))
    df.coalesce(files).write.mode("overwrite").option("compression", "snappy").parquet(target)
    return files


def full_refresh(df: DataFrame, target: str, write=checkpoint_parquet) -> None:
    """Replace the content of ``target`` by ``df``, also where ``df`` reads from ``target``.

    ``df`` is written once, beside the target, which stays whole until that is complete and
    is then replaced by a rename. A failed write leaves the target as it was and nothing
    beside it. ``write(df, path, mode=...)`` sets the format.
    """
    staging = f"{target.rstrip('/')}-staging-{uuid.uuid4().hex}"
    try:
        write(df, staging, mode="errorifexists")
    except Exception:
        delete_folder(df.sparkSession, staging)
        raise
    replace_folder(df.sparkSession, staging, target)
