"""File and folder readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagloom.schemas import POSTS


#: CSV options that keep blanks, and tell a null (written as a mark of its own) from an empty string.
KEEP_VALUES = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\x1fnull\x1f",
    "emptyValue": "",
}


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """Parquet at ``path``. A given schema saves the footer read and fills absent columns with null."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Every Parquet file below ``folder`` at any depth; folder names are not read as partitions."""
    return (
        spark.read.schema(POSTS)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
    )


def read_landed_posts(spark: SparkSession, folder: str, load: str) -> DataFrame:
    """The posts of one load. Only the files of that load are listed and read."""
    return read_posts(spark, f"{folder.rstrip('/')}/load={load}")


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, **options: str) -> DataFrame:
    """Comma-separated values with a header, from a file or a folder; ``options`` go before these settings.

    ``multi_line`` keeps newlines within quotes together, at the cost that one file is
    one task; the sink writes files small enough for that.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .option("multiLine", multi_line)
        .options(**KEEP_VALUES, **options)
        .csv(path)
    )


#: The column that holds a line of CSV which does not fit the schema.
REJECTED = "__rejected"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, **options: str) -> DataFrame:
    """As ``read_csv``, with a column ``__rejected``: the line as it stands there where it does not fit the schema, else null.

    A line does not fit if it has too few or too many values, or one that is not of its type. Store the frame before
    counting it: Spark does not read that column alone from the files.
    """
    checked = StructType([*schema, StructField(REJECTED, StringType())])
    return read_csv(spark, path, checked, multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, **options)


def source_manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file: folder, name, kind, size and time of change. File content is not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    return listed.select(
        F.regexp_replace("path", r"/[^/]*$", "").alias("folder"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("item_name"),
        F.lit("File").alias("item_type"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    )


def folder_listing(manifest: DataFrame) -> DataFrame:
    """Per folder: number of files, bytes and the last change."""
    return manifest.groupBy("folder").agg(
        F.count("item_name").alias("child_items"),
        F.sum("size_bytes").alias("size_bytes"),
        F.max("last_modified").alias("last_modified"),
    )


def _file_system(spark: SparkSession, folder: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """One metadata call; nothing below the folder is listed."""
    system, path = _file_system(spark, folder)
    return system.exists(path)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below ``folder``, from the file system; starts no job."""
    system, path = _file_system(spark, folder)
    return system.getContentSummary(path).getLength()


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder. One metadata call."""
    system, path = _file_system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    system, path = _file_system(spark, folder)
    system.delete(path, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``, by renaming both."""
    system, new = _file_system(spark, source)
    _, old = _file_system(spark, target)
    aside = old.suffix(f"-old-{new.getName()[-32:]}")
    had_old = system.exists(old)
    if had_old and not system.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not had_old:
        system.mkdirs(old.getParent())
    if not system.rename(new, old):
        if had_old:
            system.rename(aside, old)
        raise OSError(f"cannot move {source} to {target}")
    if had_old:
        system.delete(aside, True)
