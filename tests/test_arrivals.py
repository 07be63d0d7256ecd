"""Files that arrive, lines that do not fit, rows without keys, samples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.catalog import views
from tagloom.config import Zones
from tagloom.operators.questions import prepare_questions
from tagloom.operators.ranking import sample_per_group
from tagloom.plans.ingest import MOST_REJECTED, NullKeys, TooManyRejects, ingest_csv, ingest_dimension, ingest_posts
from tagloom.schemas import POST_TYPES
from tagloom.sources import read_csv, read_landed_posts
from tagloom.sources.files import delete_folder
from tagloom.streaming import publish_arrivals


def tag(posts):
    questions = prepare_questions(posts, views.post_types(posts.sparkSession))
    return questions.withColumns({"decoded": F.get("Tags", F.lit(0)), "prediction": F.lit(0.0)})


def test_arrivals_are_published_once(spark, small, tmp_path):
    zones = Zones.under(str(tmp_path / "lake"), database="arrivals_test")
    posts, source, checkpoint = views.posts(spark, small), str(tmp_path / "in"), str(tmp_path / "checkpoint")
    run = lambda **more: publish_arrivals(spark, zones, source, checkpoint, tag, batch="2023_10_22_02", **more)
    posts.filter("id < 100").write.parquet(f"{source}/a")
    assert run() == ["arrivals-000000"]
    assert run() == []
    posts.filter("id >= 100").repartition(3).write.parquet(f"{source}/b/deeper")
    assert run(files=1) == ["arrivals-000001", "arrivals-000002", "arrivals-000003"]
    expected = sorted(r[0] for r in prepare_questions(posts, views.post_types(spark)).select("question_id").collect())
    held = lambda: sorted(r[0] for r in spark.table(zones.labeled_questions).select("question_id").collect())
    assert held() == expected
    # An increment that is run again, an hour later, takes its own place.
    delete_folder(spark, f"{checkpoint}/commits/3")
    assert publish_arrivals(spark, zones, source, checkpoint, tag, batch="2023_10_22_03") == ["arrivals-000003"]
    assert held() == expected
    assert spark.table(zones.labeled_questions).select("batch_datetime_stamp").distinct().count() == 1


def test_a_failed_increment_is_done_again(spark, small, tmp_path):
    zones = Zones.under(str(tmp_path / "lake"), database="failing_arrivals")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    views.posts(spark, small).write.parquet(f"{source}/a")
    with pytest.raises(Exception, match="not today"):
        publish_arrivals(spark, zones, source, checkpoint, lambda posts: tag(posts).withColumn("decoded", F.raise_error(F.lit("not today"))))
    assert publish_arrivals(spark, zones, source, checkpoint, tag) == ["arrivals-000000"]
    assert spark.table(zones.labeled_questions).count() == prepare_questions(views.posts(spark, small), views.post_types(spark)).count()


KINDS = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


def lines(tmp_path, *rows):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(["id,name", *rows]) + "\n")
    return str(folder)


def test_lines_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    source = lines(tmp_path, "1,a", "x,b", '3,"c, d"', "4", "5,e,f", '6,"q""', "7,")
    target, aside = str(tmp_path / "landed"), str(tmp_path / "aside")
    with pytest.raises(TooManyRejects, match="3 of 7"):
        ingest_csv(spark, source, KINDS, target, aside)
    assert not (tmp_path / "landed").exists() and spark.read.parquet(aside).count() == 3
    done = ingest_csv(spark, source, KINDS, target, aside, most_rejected=0.5)
    assert (done.kept, done.rejected) == (4, 3)
    assert {r.line for r in spark.read.parquet(aside).collect()} == {"x,b", "4", "5,e,f"}
    assert {r.id for r in read_csv(spark, target, KINDS).collect()} == {1, 3, 6, 7}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["aside", "landed", "lines"]


def test_sound_files_have_no_rejects(spark, tmp_path):
    done = ingest_csv(spark, lines(tmp_path, "1,a", "2,b"), KINDS, str(tmp_path / "landed"), str(tmp_path / "aside"))
    assert (done.kept, done.rejected) == (2, 0) and 0 < MOST_REJECTED < 1
    assert spark.read.schema("line string").parquet(str(tmp_path / "aside")).count() == 0


def test_rows_without_a_key_are_refused(spark, tmp_path):
    zones = Zones.under(str(tmp_path / "lake"))
    good = spark.range(5).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("Title"))
    good.write.parquet(str(tmp_path / "s" / "1"))
    ingest_posts(spark, zones, str(tmp_path / "s"), "x")
    good.select("Title").write.parquet(str(tmp_path / "s" / "2"))
    with pytest.raises(NullKeys, match="5 rows without id"):
        ingest_posts(spark, zones, str(tmp_path / "s"), "x")
    assert read_landed_posts(spark, zones.posts, "x").count() == 5
    for bad in (good.withColumn("id", F.nullif("id", F.lit(3))), good.withColumn("id", F.when(F.col("id") == 3, "n/a").otherwise(F.col("id").cast("string")))):
        with pytest.raises(NullKeys):
            ingest_dimension(bad.withColumnRenamed("Title", "Type").withColumnRenamed("id", "Id"), POST_TYPES, str(tmp_path / "d"), keys=("Id",))
    assert not (tmp_path / "d").exists()


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 7 % 5).alias("topic"), F.lit("x").alias("more")).withColumn("topic", F.nullif("topic", F.lit(4)))
    taken = [sorted((r.topic or -1, r.id) for r in sample_per_group(rows.repartition(n, "id"), "topic", ["id"], 6).collect()) for n in (1, 4, 13)]
    assert taken[0] == taken[1] == taken[2] and len(taken[0]) == 30
    assert sample_per_group(rows, "topic", ["id"], 10**6).count() == 3000
    # A row is as likely as any other: the middle of the ids taken lies near the middle of all.
    many = [r.id for r in sample_per_group(rows, "topic", ["id"], 200).collect()]
    assert abs(sum(many) / len(many) - 1500) < 150
