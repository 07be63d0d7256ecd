"""Tagging of one load of posts and its publication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tagloom.config import Zones
from tagloom.functions.stamps import resolve_batch
from tagloom.operators.questions import prepare_questions
from tagloom.operators.results import BATCH, LOAD, labeled_questions
from tagloom.operators.topic_model import load_model, predict_topics
from tagloom.schemas import LABELED_QUESTIONS, POST_TYPES
from tagloom.sinks.tables import create_database, create_external_table, publish_batch
from tagloom.sinks.versions import as_published, publish_version
from tagloom.sources.files import read_csv, read_landed_posts


def batch_values(stamp: str, load: str) -> tuple[str, str]:
    """The partition of a load."""
    return f"{datetime.strptime(stamp, '%Y_%m_%d_%H'):%Y-%m-%d %H:%M:%S}", load


def labeled_location(zones: Zones) -> str:
    return f"{zones.serving}/labeled_questions"


def publish_labeled(tagged: DataFrame, zones: Zones, batch: datetime | str | None = None, load: str = "all", published_at: datetime | None = None) -> str:
    """Publish the tagged questions of a load as one batch of the table; returns its stamp.

    A batch holds each load once: loads of the same hour stand side by side, and a load
    that is published again in that hour takes its own place. With Parquet its earlier rows
    stay readable as of the time they were published (``published_at``, by default the clock's).
    """
    spark = tagged.sparkSession
    stamp = resolve_batch(spark, batch)
    location = labeled_location(zones)
    create_database(spark, zones.database, f"{zones.serving}/database")
    create_external_table(spark, zones.labeled_questions, LABELED_QUESTIONS, location, (BATCH, LOAD), zones.table_format)
    rows = labeled_questions(tagged, stamp, load)
    values = batch_values(stamp, load)
    if zones.table_format == "parquet":
        publish_version(rows, zones.labeled_questions, LABELED_QUESTIONS, location, (BATCH, LOAD), values, published_at)
    else:
        publish_batch(rows, zones.labeled_questions, LABELED_QUESTIONS, location, (BATCH, LOAD), values, zones.table_format)
    return stamp


def published_as_of(spark: SparkSession, zones: Zones, moment: datetime | str | None = None) -> DataFrame:
    """The table of labeled questions as it was at ``moment``, earlier publications of a load included."""
    return as_published(spark, LABELED_QUESTIONS, labeled_location(zones), moment)


def tag_posts(posts: DataFrame, zones: Zones) -> DataFrame:
    """Question posts, cleaned and tagged by the stored model."""
    model, labels = load_model(zones.model, zones.label_index)
    questions = prepare_questions(posts, read_csv(posts.sparkSession, zones.post_types, POST_TYPES))
    return predict_topics(questions, model, labels)


def tag_load(spark: SparkSession, zones: Zones, load: str, batch: datetime | str | None = None) -> str:
    """Tag a landed load and publish it as one batch; returns the batch stamp.

    One pass from scan to write; counts are read from the table afterwards.
    """
    return publish_labeled(tag_posts(read_landed_posts(spark, zones.posts, load), zones), zones, batch, load)
