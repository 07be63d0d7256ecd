"""Publications of a partitioned table that stay: each in a folder of its own, listed in a manifest.

``<location>/<column>=<value>/…/version=<version>`` holds the rows of one publication and is never written again. The
partition of the table points to the last one; so a load that is published again takes the place of its earlier rows
for readers of the table, by a change in the catalog and not by moving files, while these rows stay readable as of
the time they stood there. ``<location>/_publications`` has one small file for each publication. A publication counts
from the moment its manifest file is written: a job that fails before leaves a folder that nothing lists.

The manifest is as large as the number of publications; the driver sees those of it that a read needs, one per partition.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.operators.conform import SchemaMismatch, enforce_schema
from tagloom.sinks.files import TARGET_FILE_BYTES
from tagloom.sources.files import child_names, delete_folder, folder_bytes, folder_exists

MANIFEST, HORIZON = "_publications", "_horizon"
PUBLICATIONS = "version string, published_at timestamp, partition array<string>, rows long, path string, columns string"
#: Partitions that one statement adds to a table.
ADDED = 200

# Characters that Spark escapes in the folder name of a partition.
ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
# Types that Parquet files of the first may be read as.
WIDER = {("int", "bigint"), ("int", "double"), ("float", "double")}


class HistoryPruned(ValueError):
    """The state of that time has been pruned."""


def _folder(names: Sequence[str], values: Sequence[str]) -> str:
    if not all(values):
        raise ValueError("a partition value must not be null or empty")
    return "/".join(f"{name}={ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value)}" for name, value in zip(names, values, strict=True))


def quoted(value: str) -> str:
    """A string as a literal of Spark's SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(names: Sequence[str], values: Sequence[str]) -> str:
    return ", ".join(f"`{name}` = {quoted(value)}" for name, value in zip(names, values, strict=True))


def _version(moment: datetime) -> str:
    return f"{moment.astimezone(timezone.utc):%Y%m%dT%H%M%S%f}"


def publish_version(
    df: DataFrame,
    table: str,
    schema: StructType,
    location: str,
    partition_by: Sequence[str],
    values: Sequence[str],
    published_at: datetime | None = None,
) -> str:
    """Publish ``df`` as the partition ``values`` of ``table``; returns the version.

    What the partition held before stays readable by :func:`as_published`. ``published_at`` is the clock's time unless
    given, and later than that of the last publication of the partition. The partition values are literals, so there
    is neither a shuffle nor a sort. Without rows the partition leaves the table, and that is a publication too.
    """
    spark, moment = df.sparkSession, published_at or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    place, name = _folder(partition_by, values), _version(moment)
    if any(known[: len(name)] >= name for known in child_names(spark, f"{location}/{MANIFEST}/{place}")):
        raise ValueError(f"{place} has a publication of {moment} or later")
    version = f"{name}-{uuid.uuid4().hex[:8]}"
    path = f"{location.rstrip('/')}/{place}/version={version}"
    rows = df.withColumns({column: F.lit(value).cast(schema[column].dataType) for column, value in zip(partition_by, values, strict=True)})
    written = Observation()
    counted = enforce_schema(rows, schema).drop(*partition_by).observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.option("compression", "snappy").parquet(path)
    _list(spark, location, place, (version, moment, list(values), written.get["rows"], path, schema.simpleString()))
    _point(spark, table, partition_by, [(values, path if written.get["rows"] else None)])
    return version


def _list(spark: SparkSession, location: str, place: str, entry: tuple) -> None:
    spark.createDataFrame([entry], PUBLICATIONS).coalesce(1).write.parquet(f"{location}/{MANIFEST}/{place}/{entry[0]}")


def _point(spark: SparkSession, table: str, names: Sequence[str], places: list[tuple[Sequence[str], str | None]]) -> None:
    """Let partitions of a table read from other folders, or leave the table."""
    for values, path in places:
        spec = partition_spec(names, values)
        if path is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        elif spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").isEmpty():
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {quoted(path)}")
        else:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {quoted(path)}")
    spark.catalog.refreshTable(table)


def publications(spark: SparkSession, location: str) -> DataFrame:
    """The manifest, with ``replaced_at``, the time when another publication of the partition took its place."""
    folder = f"{location}/{MANIFEST}"
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], f"{PUBLICATIONS}, replaced_at timestamp")
    listed = spark.read.schema(PUBLICATIONS).option("recursiveFileLookup", True).parquet(folder)
    later = Window.partitionBy("partition").orderBy("version")
    return listed.withColumn("replaced_at", F.lead("published_at").over(later))


def _standing(spark: SparkSession, location: str, moment: datetime | str | None) -> DataFrame:
    listed = publications(spark, location)
    if moment is None:
        return listed.filter("replaced_at IS NULL")
    at = F.lit(moment).cast("timestamp")
    return listed.filter((F.col("published_at") <= at) & (F.col("replaced_at").isNull() | (F.col("replaced_at") > at)))


def as_published(spark: SparkSession, schema: StructType, location: str, moment: datetime | str | None = None) -> DataFrame:
    """The rows of the table as they stood there at ``moment``, or as they stand now.

    Publications of fewer columns, or of narrower types, are read as ``schema`` has them, with nulls.
    """
    horizon = f"{location}/{HORIZON}"
    if moment is not None and folder_exists(spark, horizon):
        pruned = spark.read.schema("horizon timestamp").parquet(horizon).select(F.max("horizon").alias("h")).filter(F.col("h") > F.lit(moment).cast("timestamp"))
        if not pruned.isEmpty():
            raise HistoryPruned(f"the history before {pruned.first().h} has been pruned")
    paths = [row.path for row in _standing(spark, location, moment).filter("rows > 0").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", location).parquet(*paths).select(*schema.names)


def attach(spark: SparkSession, table: str, location: str, partition_by: Sequence[str]) -> None:
    """Give a new ``table`` over ``location`` the partitions that stand."""
    standing = [(row.partition, row.path) for row in _standing(spark, location, None).filter("rows > 0").collect()]
    for at in range(0, len(standing), ADDED):
        added = " ".join(f"PARTITION ({partition_spec(partition_by, values)}) LOCATION {quoted(path)}" for values, path in standing[at : at + ADDED])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)


def prune(spark: SparkSession, location: str, before: datetime) -> int:
    """Delete the publications that were replaced by ``before``; returns their number.

    Earlier states can then no longer be read, and asking for one is an error. What stands, or stood at ``before``, stays.
    """
    gone = publications(spark, location).filter(F.col("replaced_at") <= F.lit(before).cast("timestamp")).collect()
    # The horizon first, then the list, then the rows: a read that comes between finds an error or a whole state.
    spark.createDataFrame([(before,)], "horizon timestamp").coalesce(1).write.mode("append").parquet(f"{location}/{HORIZON}")
    for row in gone:
        place = row.path[len(location.rstrip("/")) + 1 :].rpartition("/")[0]
        delete_folder(spark, f"{location}/{MANIFEST}/{place}/{row.version}")
        delete_folder(spark, row.path)
    return len(gone)


def compact(spark: SparkSession, table: str, schema: StructType, location: str, partition_by: Sequence[str], file_bytes: int = TARGET_FILE_BYTES, published_at: datetime | None = None) -> int:
    """Publish each partition of many small files again, in files of about ``file_bytes``; returns the number of partitions.

    The rows are the same, and who reads the older files goes on doing so. Small splits are joined in place, without a shuffle.
    """
    done = 0
    for row in _standing(spark, location, None).filter("rows > 0").collect():
        files = max(1, math.ceil(folder_bytes(spark, row.path) / file_bytes))
        if sum(name.endswith(".parquet") for name in child_names(spark, row.path)) <= files:
            continue
        columns = [field for field in schema if field.name not in partition_by]
        rows = spark.read.schema(StructType(columns)).parquet(row.path)
        # As many splits as files at most, whatever the size of a split is.
        publish_version(rows.coalesce(files), table, schema, location, partition_by, row.partition, published_at)
        done += 1
    return done


def evolve(spark: SparkSession, table: str, schema: StructType, location: str, partition_by: Sequence[str]) -> list[str]:
    """Give ``table`` new columns and wider types; returns what has changed. Its files stay as they are.

    Rows published before have nulls in a new column. A column that goes, or gets a type that does not hold all of its
    values, is refused, and so is a change of the partition columns.
    """
    present = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    problems = [f"{name} would go" for name in present if name not in wanted]
    changes = [f"{name} {kind}" for name, kind in wanted.items() if name not in present]
    for name in present.keys() & wanted.keys():
        if present[name] != wanted[name]:
            changes.append(f"{name} {wanted[name]}")
            if (present[name], wanted[name]) not in WIDER or name in partition_by:
                problems.append(f"{name} is {present[name]}, which {wanted[name]} does not hold")
    if list(schema.names[-len(partition_by) :]) != list(partition_by):
        problems.append("the partition columns do not come last")
    if problems:
        raise SchemaMismatch("; ".join(sorted(problems)))
    if changes:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in wanted.items())
        by = ", ".join(f"`{name}`" for name in partition_by)
        # Only the catalog forgets an external table; the folder keeps all publications.
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION {quoted(location)}")
        attach(spark, table, location, partition_by)
    return sorted(changes)
