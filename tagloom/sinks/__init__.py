"""Writers of files, folders and tables."""

from tagloom.sinks.files import checkpoint_parquet, compact_copy, full_refresh, write_quoted_csv
from tagloom.sinks.tables import (
    TableMismatch,
    create_database,
    create_external_table,
    overwrite_table,
    publish_batch,
)

__all__ = [
    "TableMismatch",
    "checkpoint_parquet",
    "compact_copy",
    "create_database",
    "create_external_table",
    "full_refresh",
    "overwrite_table",
    "publish_batch",
    "write_quoted_csv",
]
