"""Readers of files, folders and database tables."""

from tagloom.sources.database import JdbcTable, read_table
from tagloom.sources.files import (
    folder_bytes,
    folder_exists,
    folder_listing,
    read_csv,
    read_landed_posts,
    read_parquet,
    read_posts,
    source_manifest,
)

__all__ = [
    "JdbcTable",
    "folder_bytes",
    "folder_exists",
    "folder_listing",
    "read_csv",
    "read_landed_posts",
    "read_parquet",
    "read_posts",
    "read_table",
    "source_manifest",
]
