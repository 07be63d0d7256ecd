"""The jobs from source folder to published tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tagloom.catalog import views
from tagloom.config import TrainingSettings, Zones
from tagloom.operators import results, topic_model
from tagloom.operators.questions import prepare_questions
from tagloom.operators.conform import SchemaMismatch
from tagloom.plans import ingest_dimension, ingest_posts, publish_users, report, summarize_load, summary_report, tag_load, train
from tagloom.operators.sketches import error_bound
from tagloom.plans.tag import publish_labeled, tag_posts
from tagloom.plans.ingest import TooManyLosses
from tagloom.schemas import POST_TYPES, USERS
from tagloom.sources import read_csv, read_landed_posts

LOADS = ("2023_10_22", "2023_10_23")


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    zones = Zones.under(str(root), database="plans_test")
    posts = views.posts(spark, small)
    posts.filter("CreationDate < '2023-10-06'").write.parquet(str(root / "source" / "1"))
    posts.filter("CreationDate >= '2023-10-06'").write.parquet(str(root / "source" / "2"))
    for folder, load in zip("12", LOADS):
        ingest_posts(spark, zones, str(root / "source" / folder), load)
    ingest_dimension(views.post_types(spark), POST_TYPES, zones.post_types)
    ingest_dimension(views.users(spark, small), USERS, zones.users)
    return zones


@pytest.fixture(scope="module")
def metrics(spark, lake):
    return train(spark, lake, TrainingSettings(max_iterations=8)).first()


def test_landing(spark, small, lake):
    assert sum(read_landed_posts(spark, lake.posts, load).count() for load in LOADS) == views.posts(spark, small).count()
    assert read_csv(spark, lake.post_types, POST_TYPES).count() == 3
    with pytest.raises(FileNotFoundError):
        ingest_posts(spark, lake, f"{lake.landing}/none", "x")


def test_training_reports_and_stores(spark, lake, metrics):
    assert metrics["rows"] >= metrics.questions > 0
    assert 0 <= metrics.accuracy <= metrics.any_tag_accuracy <= 1
    model, labels = topic_model.load_model(lake.model, lake.label_index)
    assert topic_model.model_summary(model)["classes"] == len(labels)
    # Storing again replaces the first model.
    topic_model.save_model(model, lake.model, lake.label_index)


def test_tagging_is_repeatable(spark, small, lake, metrics):
    for load in (*LOADS, LOADS[1]):
        assert tag_load(spark, lake, load, f"{load}_02") == f"{load}_02"
    table = spark.table(lake.labeled_questions)
    expected = prepare_questions(views.posts(spark, small), views.post_types(spark)).count()
    assert table.count() == expected == table.select("question_id").distinct().count()
    labels = topic_model.load_model(lake.model, lake.label_index)[1]
    assert {r[0] for r in table.select("decoded").distinct().collect()} <= set(labels)
    history = {str(r[0]): r["rows"] for r in results.batch_history(table).collect()}
    first = results.as_of(table, "2023-10-22 12:00:00")
    assert first.count() == history["2023-10-22 02:00:00"]


def test_reports_read_the_published_table(spark, lake, metrics):
    for load in LOADS:
        tag_load(spark, lake, load, f"{load}_02")
    publish_users(spark, lake, "2023_10_22_02")
    table = spark.table(lake.labeled_questions)
    assert report(spark, lake, "totals", k=1000).agg(F.sum("qty")).first()[0] == table.filter("decoded IS NOT NULL").count()
    early = report(spark, lake, "trend", "2023-10-22 12:00:00").agg(F.sum("n")).first()[0]
    assert early == table.filter("batch_datetime_stamp < '2023-10-22 12:00:00'").count()
    assert report(spark, lake, "engagement").count() == report(spark, lake, "totals", k=1000).count()
    assert report(spark, lake, "top", k=2).agg(F.max("rank")).first()[0] <= 2


def test_summaries_equal_a_full_recount(spark, lake, metrics):
    for load in LOADS:
        tag_load(spark, lake, load, f"{load}_02")
        summarize_load(spark, lake, f"{load}_02", load)
    publish_users(spark, lake, "2023_10_22_02")
    first = spark.table(lake.labeled_questions).filter(F.col("load") == LOADS[0])
    again = first.filter("Score > 0").withColumn("decoded", F.lit("other")).drop("batch_datetime_stamp", "load")
    publish_labeled(again, lake, f"{LOADS[0]}_02", LOADS[0])
    summarize_load(spark, lake, f"{LOADS[0]}_02", LOADS[0])
    for name in ("totals", "trend", "top", "engagement"):
        made, recounted = (sorted(map(tuple, f(spark, lake, name, k=50).collect()), key=str) for f in (summary_report, report))
        assert made == recounted and made
    whole = spark.table(lake.labeled_questions).filter("decoded IS NOT NULL")
    assert summary_report(spark, lake, "drilldown").filter("level = 7").first()["n"] == whole.count()
    exact = {r.decoded: (r.q, r.o) for r in whole.groupBy("decoded").agg(F.countDistinct("question_id").alias("q"), F.countDistinct("OwnerUserId").alias("o")).collect()}
    for row in summary_report(spark, lake, "distinct").collect():
        assert all(abs(a - b) <= 1 + error_bound() * b for a, b in zip((row.questions, row.owners), exact[row.topic]))
    # Reports read the small tables alone, and a summary only the narrow columns of its load.
    for name in ("totals", "trend", "drilldown"):
        physical = plan(summary_report(spark, lake, name))
        assert "labeled_questions" not in physical and "topic_counts" in physical
    with pytest.raises(ValueError):
        summary_report(spark, lake, "none")


def test_tagging_is_one_stage(spark, lake, metrics):
    physical = plan(tag_posts(read_landed_posts(spark, lake.posts, LOADS[0]), lake))
    assert "Exchange hashpartitioning" not in physical and "SortMergeJoin" not in physical
    assert physical.count("FileScan parquet") == 1


def test_files_of_different_columns_land_together(spark, tmp_path):
    zones = Zones.under(str(tmp_path / "lake"))
    spark.range(2).select(F.col("id").cast("int").alias("id")).write.parquet(str(tmp_path / "s" / "1"))
    spark.range(3).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("Title")).write.parquet(str(tmp_path / "s" / "2"))
    ingest_posts(spark, zones, str(tmp_path / "s"), "x", merge_schema=True)
    landed = read_landed_posts(spark, zones.posts, "x")
    assert landed.agg(F.count("id"), F.count("Title"), F.count("Body")).first()[:] == (5, 3, 0)


def test_users_are_published(spark, small, lake):
    for _ in range(2):
        publish_users(spark, lake, "2023_10_22_02")
    assert spark.table(lake.users_dim).count() == views.users(spark, small).count()


def test_hashed_features_train_too(spark, lake, metrics):
    questions = spark.read.parquet(f"{lake.intermediate}/questions")
    settings = TrainingSettings(vocabulary=1024, max_iterations=2, vectorizer="hashing")
    model = topic_model.fit_topic_model(questions, settings)
    assert topic_model.model_summary(model)["vocabulary"] == 1024
    scored = topic_model.score(questions, model, topic_model.label_stage(model).labels)
    assert scored.filter(F.col("decoded").isNull()).count() == 0


def test_a_model_too_large_for_the_driver_is_refused(spark):
    questions = spark.createDataFrame([("a b", ["x", "y"])], "Text string, Tags array<string>")
    with pytest.raises(topic_model.ModelTooLarge):
        topic_model.fit_topic_model(questions, TrainingSettings(coefficient_limit_bytes=1))
    with pytest.raises(ValueError):
        topic_model.build_pipeline(TrainingSettings(vectorizer="other"))
    # Without a limit any number of tags is taken; sizes count the terms that there are.
    many = spark.range(5000).select(F.array(F.lit("a"), F.lit("b")).alias("Filtered"), F.col("id").cast("string").alias("tag"))
    assert topic_model.check_model_size(many, TrainingSettings()) == 5000 * 2 * 8


def test_tokens_are_cut_once_and_all_stages_are_stored(spark, lake, metrics):
    model, _ = topic_model.load_model(lake.model, lake.label_index)
    assert [type(stage).__name__ for stage in model.stages[:2]] == ["Tokenizer", "StopWordsRemover"] and len(model.stages) == 6


def test_landing_refuses_what_it_would_lose(spark, tmp_path):
    zones = Zones.under(str(tmp_path / "lake"))
    bad = spark.createDataFrame([(1, "2.5"), (2, "n/a")], "id int, Score string")
    bad.write.parquet(str(tmp_path / "bad"))
    landed = ingest_posts(spark, zones, str(tmp_path / "bad"), "x")
    assert landed.losses == {"id": (2, 0), "Score": (2, 1)} and landed.lost == 1
    with pytest.raises(TooManyLosses):
        ingest_posts(spark, zones, str(tmp_path / "bad"), "x", most_lost=0.1)
    assert read_landed_posts(spark, zones.posts, "x").count() == 2
    bad.withColumnRenamed("id", "post").write.parquet(str(tmp_path / "keyless"))
    with pytest.raises(SchemaMismatch):
        ingest_posts(spark, zones, str(tmp_path / "keyless"), "x")
    assert not list((tmp_path / "lake").rglob("posts_staging/*"))


def test_unknown_tags_are_scored_as_wrong(spark, lake, metrics):
    model, labels = topic_model.load_model(lake.model, lake.label_index)
    unknown = spark.createDataFrame([(1, "some text", ["never-seen", ""])], "question_id int, Text string, Tags array<string>")
    (row,) = topic_model.per_tag(topic_model.score(unknown, model, labels)).collect()
    assert row.tag == "never-seen" and row.decoded in labels


def test_an_index_without_a_label_fails(spark):
    predicted = spark.createDataFrame([(2.0,)], "prediction double")
    with pytest.raises(Exception):
        topic_model.decode_predictions(predicted, ["a", "b"]).collect()
