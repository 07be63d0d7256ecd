"""A third of all rows under one key: results stay whole and the work is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tagloom.operators import results, trends
from tagloom.operators.joins import join_dimension

ROWS = 60_000


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and a skew limit that small test data can reach."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def questions(spark):
    id = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int")
    text = F.concat(F.lit("text "), id)
    return spark.range(ROWS, numPartitions=12).select(
        id.alias("question_id"), text.alias("Text"), F.sha2(F.col("id").cast("string"), 256).alias("Title")
    )


def test_copies_of_one_question_are_split(shuffled_joins, questions):
    predictions = questions.select("question_id", "Text", F.lit(1.0).alias("prediction"), F.lit("a").alias("decoded"))
    merged = results.merge_predictions(predictions, questions)
    assert len(merged.select("question_id", "Title").collect()) == ROWS
    checked = merged.agg(F.count("Title").alias("n"), F.max("Title"), F.max("decoded"))
    assert checked.collect()[0].n == ROWS
    assert "skewed" in plan(checked)


def test_copies_of_one_question_in_the_latest_batch_are_split(shuffled_joins, questions):
    hour = F.when(F.col("question_id") == -1, 3).otherwise(F.abs("question_id") % 2)
    stamp = F.make_timestamp(F.lit(2023), F.lit(1), F.lit(1), hour, F.lit(0), F.lit(0))
    labeled = questions.select("question_id", "Title", stamp.alias(results.BATCH))
    counted = results.as_of(labeled, "2023-01-02 00:00:00").agg(F.count("Title").alias("n"), F.max("Title"))
    assert counted.collect()[0].n == ROWS
    assert "skewed" in plan(counted)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("same", [False, True])
def test_a_hot_type_is_split_where_types_are_too_many_to_broadcast(shuffled_joins, spark, questions, how, same):
    """All posts have one of two types; they may agree in id and text."""
    types = spark.range(5).select(F.col("id").cast("int").alias("Id"), F.lit("t").alias("Type"))
    posts = questions.withColumns({"PostTypeId": F.when(F.col("Title") < "e", 1).otherwise(2), "Body": F.col("Title"), **({"Title": F.lit("t"), "question_id": F.lit(7)} if same else {})})
    joined = join_dimension(posts, types, "PostTypeId", "Id", how, broadcast=False)
    per_task = joined.groupBy(F.spark_partition_id()).agg(F.count("Type").alias("n"), F.max("Title"), F.max("Body")).collect()
    assert sum(row.n for row in per_task) == ROWS
    assert max(row.n for row in per_task) < ROWS / 3


def test_one_owner_of_very_many_questions_is_grouped_before_the_join(spark, questions):
    tagged = questions.select(
        F.lit("t").alias("topic"),
        F.when(F.col("question_id") != -1, F.col("question_id")).alias("OwnerUserId"),
        *[F.lit(1).alias(name) for name in trends.ENGAGEMENT],
    )
    users = spark.range(10).select(F.col("id").cast("int").alias("id"), F.lit(5).alias("Reputation"))
    (row,) = trends.engagement_by_topic(tagged, users).collect()
    assert (row.questions, row.owners) == (ROWS, ROWS * 2 // 3)
