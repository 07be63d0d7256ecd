"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A load is grouped by digest, joined to
the index by a sort-merge anti-join, and what is new is appended. The index keeps its place,
so the join shuffles only the digests of the load, never the index and never a text.

Null texts count as empty. Equal texts are those with the same SHA-256 of their UTF-8 bytes.
Of a group the largest id stays; a null id stays only where the group has no other. Rows
that repeat id and text are one document: all carry its flag, and ``drop_duplicates`` keeps
one of them. An empty load appends nothing. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.frames import keep_one, row_key, staged, text_of
from tagloom.session import scratch
from tagloom.sources.files import folder_exists

#: Rows of a load per bucket when an index is made; a bucket row takes some 50 bytes.
ROWS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 16


@dataclass(frozen=True)
class DigestIndex:
    """An index table at ``path``. A later session opens it with the same path and buckets."""

    spark: SparkSession
    path: str
    buckets: int
    table: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint") -> "DigestIndex":
        table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {table} (digest BINARY, keep_id {id_type}, load STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        # The number of buckets stays beside the files, as another one would miss digests or fail.
        kept = f"{path}/_buckets"
        if folder_exists(spark, kept):
            made = spark.read.schema("buckets int").parquet(kept).first().buckets
            if made != buckets:
                spark.sql(f"DROP TABLE {table}")
                raise ValueError(f"the index at {path} has {made} buckets, not {buckets}")
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(kept)
        return cls(spark, path, buckets, table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame, load: str) -> None:
        """Add the digests of ``groups`` that the index lacks; a repeated load adds nothing."""
        batch = groups.repartition(self.buckets, "digest")
        new = batch.hint("merge").join(self.read(), "digest", "left_anti")
        new.select("digest", "keep_id", F.lit(load).alias("load")).write.insertInto(self.table)

    def close(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``digest`` (32 bytes) and ``key`` of each row."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(text_of(text), 256)).alias("digest"), row_key(text).alias("key"))


def buckets_for(rows: int) -> int:
    """A power of two, so that an index grows by doubling."""
    return max(LEAST_BUCKETS, 1 << max(0, (rows // ROWS_PER_BUCKET) - 1).bit_length())


def decide(rows: DataFrame, index: DigestIndex, load: str) -> DataFrame:
    """Append a load to the index and tell for each row of it whether it stays.

    ``rows`` is a stored frame of ``digests``. Counts are taken per digest and id before they
    are taken per digest, so a group of any size reaches no task whole; the rows of a hot
    group are split by adaptive execution when they meet their group.
    """
    groups = staged(
        rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")),
        "groups",
    )
    index.append(groups, load)
    held = index.read().select("digest", F.col("keep_id").alias("held_id"), "load")
    looked_up = staged(
        groups.repartition(index.buckets, "digest").hint("merge").join(held, "digest")
        .select("digest", F.col("held_id").alias("keep_id"), "group_size", (F.col("load") == load).alias("new")),
        "looked-up",
    )
    return rows.join(looked_up, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "key", "digest", "new",
    )


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, load: str = "load", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and keys."""
    rows = staged(digests(docs, doc_id, text), "digests")
    if index is not None:
        return decide(rows, index, load)
    spark = docs.sparkSession
    own = DigestIndex.open(spark, scratch(spark, "digest-index"), buckets_for(rows.count()), dict(rows.dtypes)["doc_id"])
    decided = decide(rows, own, load)
    # What is decided has been stored; nothing reads the index again.
    own.close()
    return decided


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, load: str = "load", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    decided = staged(deduplicate(docs, index, load, doc_id, text), "decided")
    fresh = keep_one(docs, decided.select("doc_id", "key", F.col("digest").alias("group")), largest=True, doc_id=doc_id, text=text)
    known = decided.filter(~F.col("new")).select(F.unhex("text_sha256").alias("_known")).distinct()
    if index is None:
        return fresh
    return fresh.join(known, F.unhex(F.sha2(F.coalesce(fresh[text].cast("string"), F.lit("")), 256)) == known["_known"], "left_anti")
