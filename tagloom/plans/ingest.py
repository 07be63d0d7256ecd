"""Landing of posts, post types and users."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagloom.config import Zones
from tagloom.operators.conform import SchemaMismatch, conform, loss_counts
from tagloom.schemas import POSTS
from tagloom.sinks.files import compact_copy, full_refresh, write_quoted_csv
from tagloom.sources.files import REJECTED, delete_folder, folder_exists, read_csv_checked, replace_folder

LOSSES = "column_name string, values_given long, values_lost long"


#: Share of a column's values that may not convert, and of a file's lines that may not fit, unless a job says otherwise.
MOST_LOST = 0.5
MOST_REJECTED = 0.01


class NullKeys(ValueError):
    """Rows without a key."""


class TooManyRejects(ValueError):
    """More lines than allowed do not fit the schema."""


class TooManyLosses(ValueError):
    """More values than allowed do not convert to the types of the table."""


@dataclass(frozen=True)
class Landed:
    """What a landing did: files written, and per column the values given and lost."""

    files: int
    losses: dict[str, tuple[int, int]]

    @property
    def lost(self) -> int:
        return sum(lost for _, lost in self.losses.values())


def _require(found: DataFrame, keys: Sequence[str]) -> None:
    missing = {key.lower() for key in keys} - {name.lower() for name in found.columns}
    if missing:
        raise SchemaMismatch(f"the source has no column {', '.join(sorted(missing))}")


def _counts(found: DataFrame, schema: StructType, keys: Sequence[str]) -> list[Column]:
    """Losses per column, and the rows that lack a key."""
    return [*loss_counts(found, schema), *[F.count_if(F.col(key).isNull()).alias(f"null_{key}") for key in keys]]


def _losses(told: dict[str, int], keys: Sequence[str], most: float) -> dict[str, tuple[int, int]]:
    """The losses of a load, if it may land."""
    bare = {key: told[f"null_{key}"] for key in keys if told[f"null_{key}"]}
    if bare:
        raise NullKeys("; ".join(f"{n} rows without {key}" for key, n in bare.items()))
    losses = {name[6:]: (told[name], told[f"lost_{name[6:]}"]) for name in told if name.startswith("given_")}
    _check_losses(losses, most)
    if lost := [key for key in keys if losses.get(key, (0, 0))[1]]:
        raise NullKeys(f"values of {', '.join(lost)} that do not convert")
    return losses


def _check_losses(losses: dict[str, tuple[int, int]], most: float) -> None:
    bad = {name: pair for name, pair in losses.items() if pair[1] > most * pair[0]}
    if bad:
        raise TooManyLosses("; ".join(f"{name}: {lost} of {given} values" for name, (given, lost) in bad.items()))


def ingest_posts(
    spark: SparkSession,
    zones: Zones,
    source: str,
    load: str,
    merge_schema: bool = True,
    keys: Sequence[str] = ("id",),
    most_lost: float = MOST_LOST,
) -> Landed:
    """Copy a source folder, at any depth and in any close types, into one landed load.

    Each load has its own folder: a failed or repeated copy touches no other load, and
    readers of the previous one are not disturbed. The columns of all files are read
    unless ``merge_schema`` is off. A source without the ``keys`` is refused, also where only some of its
    rows or files lack them, as is one in which a column loses more than the share ``most_lost`` of its values; the losses are
    counted by the pass that copies, returned, and stored below ``zones.landing``.
    """
    if not folder_exists(spark, source):
        raise FileNotFoundError(source)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = reader.option("mergeSchema", merge_schema).parquet(source)
    _require(found, keys)
    counted, names = Observation(), _counts(found, POSTS, keys)
    target = f"{zones.posts}/load={load}"
    staging = f"{zones.landing}/posts_staging/{load}-{uuid.uuid4().hex}"
    try:
        files = compact_copy(conform(found.observe(counted, *names), POSTS, lost=None), source, staging)
        losses = _losses(counted.get, keys, most_lost)
    except Exception:
        delete_folder(spark, staging)
        raise
    replace_folder(spark, staging, target)
    rows = [(name, *pair) for name, pair in losses.items()]
    spark.createDataFrame(rows, LOSSES).coalesce(1).write.mode("overwrite").parquet(losses_path(zones, load))
    return Landed(files, losses)


def losses_path(zones: Zones, load: str) -> str:
    return f"{zones.landing}/posts_losses/load={load}"


def ingest_dimension(table: DataFrame, schema: StructType, target: str, keys: Sequence[str] = ("id",), most_lost: float = MOST_LOST) -> Landed:
    """Replace a landed dimension by ``table``, as quoted CSV; losses and keys as in ``ingest_posts``."""
    _require(table, keys)
    counted = Observation()
    observed = conform(table.observe(counted, *_counts(table, schema, keys)), schema, lost=None)
    losses: dict[str, tuple[int, int]] = {}

    def write(df: DataFrame, path: str, mode: str) -> None:
        write_quoted_csv(df, path, mode)
        losses.update(_losses(counted.get, keys, most_lost))

    full_refresh(observed, target, write=write)
    return Landed(1, losses)


@dataclass(frozen=True)
class Checked:
    """What a checked CSV landing did."""

    kept: int
    rejected: int


def ingest_csv(spark: SparkSession, source: str, schema: StructType, target: str, quarantine: str, keys: Sequence[str] = ("id",), most_rejected: float = MOST_REJECTED, multi_line: bool = False, **options: str) -> Checked:
    """Replace a landed dimension by the lines of CSV files that fit ``schema``; the others go to ``quarantine`` as they stand.

    The files are read once, to a stored copy, from which both parts are written. A share of lines above
    ``most_rejected`` refuses the load: the lines are in quarantine then, and the target is as it was.
    """
    staging = f"{quarantine.rstrip('/')}-staging-{uuid.uuid4().hex}"
    read_csv_checked(spark, source, schema, multi_line, **options).write.parquet(staging)
    try:
        checked = spark.read.schema(StructType([*schema, StructField(REJECTED, StringType())])).parquet(staging)
        kept, rejected = checked.agg(F.count_if(F.col(REJECTED).isNull()), F.count(REJECTED)).first()
        lines = checked.filter(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"))
        full_refresh(lines, quarantine)
        if rejected > most_rejected * (kept + rejected):
            raise TooManyRejects(f"{rejected} of {kept + rejected} lines do not fit; see {quarantine}")
        ingest_dimension(checked.filter(F.col(REJECTED).isNull()).drop(REJECTED), schema, target, keys)
    finally:
        delete_folder(spark, staging)
    return Checked(kept, rejected)
