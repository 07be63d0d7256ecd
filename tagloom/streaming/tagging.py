"""Posts that arrive as files, published increment by increment.

A stream over the source folder gives each increment of new files a number, which its checkpoint keeps. An increment is
published as a load of that number, so one that is run again after a failure takes its own place instead of doubling the
table: the stamp of its first publication is looked up and used again. Cleaning and tagging work on single rows and need no state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import Zones
from tagloom.functions.stamps import resolve_batch
from tagloom.plans.tag import labeled_location, publish_labeled, tag_posts
from tagloom.schemas import POSTS
from tagloom.sinks.versions import publications

#: Files of an increment.
FILES_PER_INCREMENT = 1000


def _stamp(spark: SparkSession, zones: Zones, load: str, batch: datetime | str | None) -> str:
    """The stamp under which a load was published first, or the one of now."""
    known = publications(spark, labeled_location(zones)).filter(F.get("partition", F.lit(1)) == load).orderBy("version").limit(1).collect()
    return f"{datetime.fromisoformat(known[0].partition[0]):%Y_%m_%d_%H}" if known else resolve_batch(spark, batch)


def publish_arrivals(
    spark: SparkSession,
    zones: Zones,
    source: str,
    checkpoint: str,
    tag: Callable[[DataFrame], DataFrame],
    name: str = "arrivals",
    batch: datetime | str | None = None,
    files: int = FILES_PER_INCREMENT,
) -> list[str]:
    """Publish what has arrived below ``source`` since the last run, tagged by ``tag``; returns the loads.

    Runs until all files are done and then ends; a schedule or a loop runs it again. ``checkpoint`` belongs to one stream.
    """
    done: list[str] = []

    def publish(posts: DataFrame, number: int) -> None:
        load = f"{name}-{number:06d}"
        publish_labeled(tag(posts), zones, _stamp(posts.sparkSession, zones, load, batch), load)
        done.append(load)

    arriving = (
        spark.readStream.schema(POSTS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files).parquet(source)
    )
    running = arriving.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    if done:
        # The stream publishes in a session of its own.
        spark.catalog.refreshTable(zones.labeled_questions)
    return done


def tag_arrivals(spark: SparkSession, zones: Zones, source: str, checkpoint: str, batch: datetime | str | None = None) -> list[str]:
    """The same with the stored model."""
    return publish_arrivals(spark, zones, source, checkpoint, lambda posts: tag_posts(posts, zones), batch=batch)
