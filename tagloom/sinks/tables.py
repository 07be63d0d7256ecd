"""External tables: creation, whole overwrite and idempotent batches."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.operators.conform import enforce_schema
from tagloom.sinks.files import full_refresh
from tagloom.sinks.versions import MANIFEST, attach, partition_spec, quoted
from tagloom.sources.files import delete_folder, folder_exists


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


class TableMismatch(ValueError):
    """A table of that name exists with another place, format or other columns."""


def _names(partition_by: str | Sequence[str] | None) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by or [])


def _check_existing(spark: SparkSession, table: str, schema: StructType, location: str, format: str) -> None:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    place = [re.sub(r"^file:/+", "/", path).rstrip("/") for path in (told["Location"], location)]
    columns = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    problems = [f"it is at {told['Location']}, not {location}"] if place[0] != place[1] else []
    if told["Provider"].lower() != format.lower():
        problems.append(f"it is {told['Provider']}, not {format}")
    if columns != {f.name: f.dataType.simpleString() for f in schema}:
        problems.append("it has other columns")
    if problems:
        raise TableMismatch(f"{table} exists: {'; '.join(problems)}")


def create_external_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    partition_by: str | Sequence[str] | None = None,
    format: str = "parquet",
) -> None:
    """Register ``table`` over ``location``; files already there become visible, or the publications that stand, where these are listed.

    A table of that name must have the same place, format and columns.
    """
    if spark.catalog.tableExists(table):
        _check_existing(spark, table, schema, location, format)
        return
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    by = ", ".join(f"`{name}`" for name in _names(partition_by))
    partitions = f" PARTITIONED BY ({by})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {format}{partitions} LOCATION {quoted(location)}")
    if by and format != "delta" and folder_exists(spark, f"{location}/{MANIFEST}"):
        attach(spark, table, location, _names(partition_by))
    elif by and format != "delta" and folder_exists(spark, location):
        spark.catalog.recoverPartitions(table)


def publish_batch(
    df: DataFrame,
    table: str,
    schema: StructType,
    location: str,
    partition_by: str | Sequence[str],
    batch: str | Sequence[str],
    format: str = "parquet",
) -> None:
    """Add ``df`` to ``table`` as the partition ``batch``; one that is already there is replaced.

    The rows are written to a staging folder of the job and take the place of the old
    partition only when all tasks have succeeded, so a failed run leaves the table as it
    was and a repeated run does not double it. As the partition values are literals, the
    write needs neither a shuffle nor a sort. An empty ``df`` leaves no partition.
    """
    spark = df.sparkSession
    values = dict(zip(_names(partition_by), [batch] if isinstance(batch, str) else batch, strict=True))
    rows = df.withColumns({name: F.lit(value).cast(schema[name].dataType) for name, value in values.items()})
    written = Observation()
    (
        enforce_schema(rows, schema)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format(format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*values)
        .save(location)
    )
    if format != "delta":
        partition = partition_spec(list(values), list(values.values()))
        if written.get["rows"]:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition})")
        else:
            _drop_partition(spark, table, partition)
    spark.catalog.refreshTable(table)


def _drop_partition(spark: SparkSession, table: str, partition: str) -> None:
    """Forget a partition and delete its files."""
    try:
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({partition})").collect()
    except AnalysisException:  # there is none
        return
    places = [r["data_type"] for r in told if r["col_name"] == "Location"]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition})")
    delete_folder(spark, places[0])


def overwrite_table(df: DataFrame, table: str, schema: StructType, location: str, format: str = "parquet") -> None:
    """Replace all rows of the external table ``table``.

    The new rows are complete in a folder of their own before the old ones are touched, so a
    job that fails on its input leaves the table as it was.
    """
    spark = df.sparkSession
    rows = enforce_schema(df, schema)
    if format == "delta":
        rows.write.format(format).mode("overwrite").save(location)
    else:
        full_refresh(rows, location, write=lambda part, path, mode: part.write.format(format).mode(mode).save(path))
    spark.catalog.refreshTable(table)
