"""Topic reports over the published table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import Zones
from tagloom.operators import sketches, trends
from tagloom.operators.results import BATCH, LOAD, topics_as_of
from tagloom.plans.tag import batch_values
from tagloom.schemas import TOPIC_COUNTS, TOPIC_SKETCHES
from tagloom.sinks.tables import create_database, create_external_table
from tagloom.sinks.versions import publish_version

SUMMARIES = {"topic_counts": TOPIC_COUNTS, "topic_sketches": TOPIC_SKETCHES}


def report(spark: SparkSession, zones: Zones, name: str = "top", moment: datetime | str | None = None, k: int = 10) -> DataFrame:
    """``top`` (the k most frequent topics of each day), ``trend``, ``totals`` or ``engagement``.

    Of the table as it is, or as it was at ``moment``. Engagement needs the users table.
    """
    tagged = topics_as_of(spark.table(zones.labeled_questions), moment)
    if name == "engagement":
        return trends.engagement_by_topic(tagged, spark.table(zones.users_dim))
    if name == "totals":
        return trends.topic_totals(tagged, k)
    daily = trends.topic_daily(tagged)
    if name == "trend":
        return trends.topic_trend(daily)
    if name == "top":
        return trends.top_topics_daily(daily, k)
    raise ValueError(f"no report {name!r}")


def _summary_table(zones: Zones, name: str) -> str:
    return f"{zones.database}.{name}"


def summarize_load(spark: SparkSession, zones: Zones, batch: str, load: str = "all", published_at: datetime | None = None) -> None:
    """Counts and sketches of one published load, in the place of those that it had before.

    Only that load is read, without its texts. Run it after each publication: the reports then read summaries alone.
    """
    create_database(spark, zones.database, f"{zones.serving}/database")
    stamp, load = values = batch_values(batch, load)
    rows = topics_as_of(spark.table(zones.labeled_questions).filter((F.col(BATCH) == F.lit(stamp).cast("timestamp")) & (F.col(LOAD) == load)))
    made = {"topic_counts": trends.topic_counts(rows), "topic_sketches": sketches.sketches(rows, ["day", "topic"], questions="question_id", owners="OwnerUserId")}
    for name, schema in SUMMARIES.items():
        location, table = f"{zones.serving}/{name}", _summary_table(zones, name)
        create_external_table(spark, table, schema, location, (BATCH, LOAD))
        summary = made[name].withColumns({BATCH: F.lit(stamp).cast("timestamp"), LOAD: F.lit(load)})
        publish_version(summary, table, schema, location, (BATCH, LOAD), values, published_at)


def summary_report(spark: SparkSession, zones: Zones, name: str = "top", k: int = 10) -> DataFrame:
    """The reports, and ``drilldown`` and ``distinct`` (per topic: questions and owners, estimated), from the summaries of all loads."""
    if name == "distinct":
        return sketches.merged(spark.table(_summary_table(zones, "topic_sketches")), ["topic"], "questions", "owners")
    counts = spark.table(_summary_table(zones, "topic_counts"))
    if name == "engagement":
        return trends.engagement_of_counts(trends.merged_counts(counts, "topic", "OwnerUserId"), spark.table(zones.users_dim))
    daily = counts.groupBy("day", "topic").agg(F.sum("questions").alias("n"))
    if name == "totals":
        return daily.groupBy("topic").agg(F.sum("n").alias("qty")).orderBy(F.desc("qty"), "topic").limit(k)
    if name == "trend":
        return trends.topic_trend(daily)
    if name == "top":
        return trends.top_topics_daily(daily, k)
    if name == "drilldown":
        return trends.drilldown_of_counts(counts.groupBy("Type", "topic", "day").agg(F.sum("questions").alias("n")))
    raise ValueError(f"no report {name!r}")
