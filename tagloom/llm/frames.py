"""Steps that several operators share: staging, row keys, and keeping one row of a group."""

from __future__ import annotations

import io
import re
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch

PACKAGE = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri)) if re.match(r"\w+:", uri) else (fs.LocalFileSystem(), uri)


#: Rows that go to a Python worker at once, where the session has not set another number. Texts may be long,
#: and a batch of the default size is held several times over by the task and by its worker.
ARROW_ROWS = 1000
ARROW_SETTING, ARROW_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a session, once per application, and keep their batches small."""
    if spark.conf.get(ARROW_SETTING) == ARROW_DEFAULT:
        spark.conf.set(ARROW_SETTING, ARROW_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(PACKAGE.parent))
    uri = f"{scratch(spark, 'package')}.zip"
    store, path = open_store(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(packed.getvalue())
    sc.addPyFile(uri)
    _SHIPPED.add(sc.applicationId)


#: A frame of at most so many narrow rows (two longs) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000

#: Narrow rows that a stored file holds, where their number is known.
ROWS_PER_FILE = 250_000


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors.

    With ``rows``, a bound of the narrow rows that are to be written, it makes no more files
    than these need, however many partitions they come from.
    """
    path = scratch(df.sparkSession, label)
    if rows is not None:
        df = df.coalesce(1 + rows // ROWS_PER_FILE)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(column: str = "text") -> Column:
    """A hash that, with the id, tells rows apart that share an id but not their text."""
    return F.xxhash64(text_of(column))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep_one(docs: DataFrame, members: DataFrame, largest: bool, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of ``members``, with all columns of ``docs``.

    ``members`` has ``doc_id``, ``key`` (see ``row_key``) and ``group``, one row per document.
    The largest or smallest id stays; ids that are null lose against others, and the smaller
    key decides between rows of one id. Of rows that agree in id and text one stays.
    Only the rows to drop are joined to the documents, so texts move only where these are many.
    """
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("key")) if largest else F.struct(
        F.col("doc_id").isNull().alias("known"), F.col("doc_id"), F.col("key")
    )
    total = members.count()
    pairs = staged(members.groupBy("group", "doc_id", "key").agg(F.count(F.lit(1)).alias("n")), "pairs", total)
    first = pairs.groupBy("group").agg((F.max if largest else F.min)(rank).alias("first"), F.count(F.lit(1)).alias("pairs"))
    crowded = staged(first.filter("pairs > 1").select(F.col("group").alias("g"), "first"), "winners", total)
    losers = pairs.join(crowded, pairs["group"] == crowded["g"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
    ).select(F.col("doc_id").alias("_out_id"), F.col("key").alias("_out_key"), F.lit(False).alias("_once"))
    repeated = pairs.filter("n > 1").select(F.col("doc_id").alias("_out_id"), F.col("key").alias("_out_key"), F.lit(True).alias("_once"))
    out = staged(losers.union(repeated).groupBy("_out_id", "_out_key").agg(F.min("_once").alias("_once")), "dropped", total)
    rows, again = out.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("_once").cast("long")), F.lit(0))).first()
    if not rows:
        return docs

    def same(found: DataFrame) -> Column:
        return docs[doc_id].eqNullSafe(found["_out_id"]) & (F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == found["_out_key"])

    kept = docs.join(small(out, rows), same(out), "left_anti")
    if again:
        once = out.filter("_once").drop("_once")
        kept = kept.unionByName(docs.join(small(once, again), same(once), "left_semi").dropDuplicates([doc_id, text]))
    return kept

