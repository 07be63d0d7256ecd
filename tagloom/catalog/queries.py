"""The named queries. Each takes a session and a data folder and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.catalog import views
from tagloom.config import TrainingSettings, Zones
from tagloom.functions import clean_text, last_tag, parse_tags, strip_html, strip_urls
from tagloom.operators import features, metrics, profile, results, sketches, tag_blocks, topic_model, trends
from tagloom.operators.conform import conform, conversion_losses, merge_versions
from tagloom.operators.joins import join_dimension
from tagloom.operators.questions import (
    ml_input,
    prepare_questions,
    question_posts,
    text_and_tags,
    training_corpus,
    with_type,
)
from tagloom.operators.ranking import sample_per_group, top_per_group, with_global_index
from tagloom.operators.split import train_test_split, with_part
from tagloom.operators.users import build_users_dim
from tagloom.plans.ingest import LOSSES, ingest_csv, ingest_dimension, ingest_posts, losses_path
from tagloom.plans.report import summarize_load, summary_report
from tagloom.plans.tag import labeled_location, publish_labeled, published_as_of
from tagloom.schemas import LABELED_QUESTIONS, POSTS, USERS, USERS_DIM
from tagloom.session import scratch, shared_root
from tagloom.sinks import (
    checkpoint_parquet,
    create_database,
    create_external_table,
    overwrite_table,
    write_quoted_csv,
)
from tagloom.sinks.versions import compact, evolve, prune, publications, publish_version
from tagloom.sources import folder_listing, read_csv, read_landed_posts, read_parquet, read_posts, source_manifest
from tagloom.sources.files import delete_folder
from tagloom.streaming import publish_arrivals

Query = Callable[[SparkSession, str], DataFrame]

FIRST_BATCH, SECOND_BATCH, THIRD_BATCH = "2023_10_22_02", "2023_10_23_02", "2023_10_24_02"

#: Share of held-out rows that a trained model must at least name right.
ACCURACY_FLOOR = 0.1

_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared frames -----------------------------------------------------------------


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    return question_posts(views.posts(spark, folder), views.post_types(spark))


def _prepared(spark: SparkSession, folder: str, order: str = "train", dealt: bool = False) -> DataFrame:
    return prepare_questions(views.posts(spark, folder), views.post_types(spark), order, dealt)


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    """Question posts with their last tag as topic; the post body is not read."""
    tagged = _questions(spark, folder).withColumns({"topic": last_tag("Tags"), "day": F.col("CreationDate")})
    return tagged.filter(F.col("topic").isNotNull())


def _zones(spark: SparkSession, label: str) -> Zones:
    """Storage of one run; the database has a name of its own so that runs do not meet."""
    return Zones.under(scratch(spark, label), database=f"topics_{uuid.uuid4().hex}")


def _topic_counts(questions: DataFrame) -> DataFrame:
    """Questions per first tag and topic. Checkpointed, as the questions are read once for all that follows."""
    keyed = questions.select(F.get("Tags", F.lit(0)).alias("first_tag"), last_tag("Tags").alias("topic"))
    counts = keyed.filter(F.col("topic").isNotNull()).groupBy("first_tag", "topic").agg(F.count("*").alias("n"))
    shared_root(questions.sparkSession)
    return counts.checkpoint()


def _topic_index(counts: DataFrame) -> DataFrame:
    """``topic, label_index``: topics numbered by falling frequency."""
    totals = counts.groupBy("topic").agg(F.sum("n").alias("n"))
    return with_global_index(totals, [F.desc("n"), F.col("topic")], "label_index").drop("n")


def _rule_predictions(questions: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """A fixed rule in place of a model, so that SQL can check what follows from predictions.

    Predicts the most frequent topic among questions with the same first tag, with the
    index of that topic among all topics.
    """
    counts = _topic_counts(questions) if counts is None else counts
    rule = top_per_group(counts, "first_tag", [F.desc("n"), F.col("topic")], 1).select(
        F.col("first_tag").alias("rule_tag"), "topic"
    )
    indexed_rule = rule.join(_topic_index(counts), "topic").select(
        "rule_tag", F.col("topic").alias("decoded"), F.col("label_index").cast("double").alias("prediction")
    )
    keyed = questions.withColumn("first_tag", F.get("Tags", F.lit(0)))
    joined = join_dimension(keyed, indexed_rule, "first_tag", "rule_tag", how="left")
    return joined.drop("first_tag", "rule_tag")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- sources and sinks -------------------------------------------------------------


@_query("scan_posts")
def _scan_posts(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "scan")
    views.posts(spark, folder).write.parquet(f"{root}/incoming/day")
    return read_posts(spark, root)


@_query("source_manifest")
def _source_files(spark: SparkSession, folder: str) -> DataFrame:
    return source_manifest(spark, folder, "*.parquet")


@_query("folder_listing")
def _source_folders(spark: SparkSession, folder: str) -> DataFrame:
    return folder_listing(source_manifest(spark, folder, "*.parquet"))


@_query("csv_roundtrip")
def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "csv")
    write_quoted_csv(views.users(spark, folder), path)
    return read_csv(spark, path, USERS, multi_line=True)


@_query("csv_rejects")
def _csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as lines of text, some with a value that is no number, too few or too many values: what lands and what does not."""
    key = F.col("c_custkey")
    number = F.when(key % 7 == 0, F.concat(key.cast("string"), F.lit("x"))).otherwise(key.cast("string"))
    line = F.concat(number, F.lit(',"'), F.col("c_name"), F.lit('"'), F.when(key % 11 == 0, F.lit("")).when(key % 13 == 0, F.lit(",1,2")).otherwise(F.lit(",3")))
    root = scratch(spark, "rejects")
    views.table(spark, folder, "customer").select(line.alias("value")).write.text(f"{root}/lines")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("kind", T.IntegerType())])
    ingest_csv(spark, f"{root}/lines", schema, f"{root}/landed", f"{root}/quarantine", most_rejected=0.5, header="false")
    kept = read_csv(spark, f"{root}/landed", schema).withColumn("line", F.lit(None).cast("string"))
    return kept.unionByName(spark.read.schema("line string").parquet(f"{root}/quarantine"), allowMissingColumns=True)


@_query("full_refresh_dim")
def _full_refresh_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads; the second reads the first from the folder that it replaces."""
    target = f"{scratch(spark, 'dim')}/users"
    ingest_dimension(views.users(spark, folder), USERS, target)
    landed = read_csv(spark, target, USERS, multi_line=True)
    ingest_dimension(landed.withColumn("UpVotes", F.col("UpVotes") + 1), USERS, target)
    return read_csv(spark, target, USERS, multi_line=True)


@_query("landing_posts")
def _landing_posts(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "landing")
    zones = Zones.under(f"{root}/lake")
    views.posts(spark, folder).write.parquet(f"{root}/source/day")
    ingest_posts(spark, zones, f"{root}/source", FIRST_BATCH)
    landed = read_landed_posts(spark, zones.posts, FIRST_BATCH)
    return landed.groupBy("CreationDate").agg(
        F.count("*").alias("posts"), F.count("Body").alias("bodies"), F.sum("ViewCount").alias("views")
    )


@_query("landing_losses")
def _landing_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Losses of a landed load, as the job stores them; its files differ in their columns."""
    root = scratch(spark, "losses")
    zones, text = Zones.under(f"{root}/lake"), _text_posts(spark, folder)
    text.filter("id % 2 = 0").write.parquet(f"{root}/source/whole")
    text.filter("id % 2 = 1").select("id", "Title", "CreationDate", "Score", "CommentCount").write.parquet(f"{root}/source/few")
    ingest_posts(spark, zones, f"{root}/source", FIRST_BATCH)
    return spark.read.schema(LOSSES).parquet(losses_path(zones, FIRST_BATCH))


def _text_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as text, as a loosely typed source delivers them, with some values that do not convert."""
    posts = views.posts(spark, folder)
    text = posts.select(*[F.col(name).cast("string").alias(name) for name in posts.columns])
    return text.withColumns(
        {
            "CreationDate": F.when(F.col("AnswerCount") == "3", "2010-13-02").otherwise(F.col("CreationDate")),
            "CommentCount": F.when(F.col("CommentCount") == "5", "five").otherwise(F.col("CommentCount")),
            "Score": F.when(F.col("Score") == "4.0", "n/a").otherwise(F.col("Score")),
            "ViewCount": F.concat("ViewCount", F.lit(".75")),
        }
    )


@_query("conform_posts")
def _conform_posts(spark: SparkSession, folder: str) -> DataFrame:
    return conform(_text_posts(spark, folder), POSTS)


@_query("conform_losses")
def _conform_losses(spark: SparkSession, folder: str) -> DataFrame:
    return conversion_losses(_text_posts(spark, folder), POSTS)


@_query("checkpoint_roundtrip")
def _checkpoint_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return checkpoint_parquet(text_and_tags(_prepared(spark, folder)), scratch(spark, "corpus"))


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    posts = views.posts(spark, folder).select("id", "CreationDate", "Score", "FavoriteCount", "ViewCount")
    changed = F.lit("2023-10-15").cast("date")
    older = posts.filter(F.col("CreationDate") < changed).drop("FavoriteCount", "ViewCount")
    return older, posts.filter(F.col("CreationDate") >= changed)


@_query("schema_evolution")
def _schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "versions")
    older, newer = _versions(spark, folder)
    older.write.parquet(f"{root}/version=1")
    newer.write.parquet(f"{root}/version=2")
    merged = read_parquet(spark, root, merge_schema=True)
    return merged.select("id", "CreationDate", "Score", "FavoriteCount", "ViewCount", "version")


@_query("schema_union")
def _schema_union(spark: SparkSession, folder: str) -> DataFrame:
    return merge_versions(*_versions(spark, folder))


# --- profiles ----------------------------------------------------------------------


@_query("null_counts")
def _null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(views.posts(spark, folder))


@_query("describe_posts")
def _describe_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.describe(views.posts(spark, folder)), "mean", "stddev")


@_query("describe_users")
def _describe_users(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.describe(views.users(spark, folder)), "mean", "stddev")


@_query("describe_questions")
def _describe_questions(spark: SparkSession, folder: str) -> DataFrame:
    """The array of tags is left out."""
    return _rounded(profile.describe(_questions(spark, folder)), "mean", "stddev")


@_query("preview_questions")
def _preview_questions(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows by id, for a look at the data."""
    shown = _questions(spark, folder).select("question_id", "Title", "Score", "ViewCount")
    return shown.orderBy("question_id").limit(20)


@_query("distinct_tags")
def _distinct_tags(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_counts(text_and_tags(_questions(spark, folder), "Body"), ["tag", "question_id"])


# --- posts, questions, text --------------------------------------------------------


@_query("posts_with_type")
def _posts_with_type(spark: SparkSession, folder: str) -> DataFrame:
    typed = with_type(views.posts(spark, folder), views.post_types(spark))
    return typed.groupBy("Type").agg(F.count("*").alias("posts"))


@_query("question_posts")
def _question_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _questions(spark, folder).withColumn("Tags", F.array_join("Tags", ","))


@_query("parse_tags")
def _tag_lists(spark: SparkSession, folder: str) -> DataFrame:
    tags = parse_tags("Tags")
    return views.posts(spark, folder).select(
        "id", F.array_join(tags, ",").alias("tags"), F.size(tags).cast("long").alias("n_tags")
    )


def _bodies(spark: SparkSession, folder: str) -> DataFrame:
    posts = views.posts(spark, folder).select(F.lit("posts").alias("origin"), "id", "Body")
    pages = views.pages(spark, folder).select(F.lit("pages").alias("origin"), "question_id", "Body")
    return posts.union(pages)


@_query("strip_html")
def _html_stripped(spark: SparkSession, folder: str) -> DataFrame:
    return _bodies(spark, folder).select("origin", "id", strip_html("Body").alias("text"))


@_query("strip_urls")
def _urls_stripped(spark: SparkSession, folder: str) -> DataFrame:
    return _bodies(spark, folder).select("origin", "id", strip_urls("Body").alias("text"))


@_query("clean_text_train")
def _clean_text_train(spark: SparkSession, folder: str) -> DataFrame:
    return _bodies(spark, folder).select("origin", "id", clean_text("Body", "train").alias("text"))


@_query("clean_text_infer")
def _clean_text_infer(spark: SparkSession, folder: str) -> DataFrame:
    return _bodies(spark, folder).select("origin", "id", clean_text("Body", "infer").alias("text"))


@_query("ml_input")
def _model_input(spark: SparkSession, folder: str) -> DataFrame:
    return ml_input(_prepared(spark, folder))


@_query("ml_input_url_first")
def _model_input_url_first(spark: SparkSession, folder: str) -> DataFrame:
    return ml_input(_prepared(spark, folder, "infer"))


@_query("text_and_tags")
def _tag_rows(spark: SparkSession, folder: str) -> DataFrame:
    stripped = _questions(spark, folder).withColumn("Text", strip_html("Body"))
    return text_and_tags(stripped)


@_query("training_corpus")
def _corpus(spark: SparkSession, folder: str) -> DataFrame:
    return training_corpus(views.posts(spark, folder), views.post_types(spark))


# --- features ----------------------------------------------------------------------


def _long_position(df: DataFrame) -> DataFrame:
    return df.withColumn("position", F.col("position").cast("long"))


@_query("tokens")
def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    return _long_position(features.tokens(_prepared(spark, folder)))


@_query("filtered_tokens")
def _filtered_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return _long_position(features.filtered_tokens(_prepared(spark, folder)))


@_query("term_frequency")
def _term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return features.term_frequency(_prepared(spark, folder))


@_query("idf_weights")
def _idf_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(features.idf_weights(_prepared(spark, folder), TrainingSettings().min_doc_freq), "idf")


@_query("hashing_tf")
def _hashing_tf(spark: SparkSession, folder: str) -> DataFrame:
    return features.hashing_tf(_prepared(spark, folder))


@_query("hashing_tf_totals")
def _hashing_tf_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed frequencies add up to the tokens of each question, whatever the buckets are."""
    hashed = features.hashing_tf(_prepared(spark, folder))
    return hashed.groupBy("question_id").agg(F.sum("frequency").cast("long").alias("tokens"))


@_query("label_index")
def _label_index(spark: SparkSession, folder: str) -> DataFrame:
    return features.label_index(text_and_tags(_questions(spark, folder), "Body"))


@_query("train_test_split")
def _split_parts(spark: SparkSession, folder: str) -> DataFrame:
    return with_part(_questions(spark, folder)).select("question_id", "part")


# --- model -------------------------------------------------------------------------


_FITTED: dict[tuple[str, str], tuple] = {}


def _fitted(spark: SparkSession, folder: str):
    """The model as published settings give it, stored and loaded, with the questions held out and its zones.

    The queries of a session share one fit per folder.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        _FITTED[key] = _fit(spark, folder)
    return _FITTED[key]


def _fit(spark: SparkSession, folder: str):
    zones = _zones(spark, "model")
    known = checkpoint_parquet(
        _prepared(spark, folder, dealt=True).select("question_id", "Text", "Tags"), f"{zones.intermediate}/questions"
    )
    learn, held_out = train_test_split(known)
    fitted = topic_model.fit_topic_model(learn)
    topic_model.save_model(fitted, zones.model, zones.label_index)
    return fitted, *topic_model.load_model(zones.model, zones.label_index), held_out, zones


def _stored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``label_index, tag`` as the training stored them."""
    *_, zones = _fitted(spark, folder)
    stored = read_parquet(spark, f"{zones.label_index}/data")
    return stored.select(F.posexplode(F.get("labelsArray", F.lit(0))).alias("label_index", "tag"))


@_query("train_topic_model")
def _train_topic_model(spark: SparkSession, folder: str) -> DataFrame:
    """The size of a fitted model, beside the number of questions held out from it."""
    fitted, _, _, held_out, _ = _fitted(spark, folder)
    summary = topic_model.model_summary(fitted)
    sizes = [F.lit(summary[name]).cast("long").alias(name) for name in ("classes", "vocabulary")]
    return held_out.agg(F.count("*").alias("held_out")).select("held_out", *sizes)


@_query("stored_label_index")
def _stored_label_index(spark: SparkSession, folder: str) -> DataFrame:
    """The labels of the training rows, as read from the files of the stored index."""
    return _stored_labels(spark, folder).withColumn("label_index", F.col("label_index").cast("long"))


def _inferred(spark: SparkSession, folder: str) -> DataFrame:
    _, model, labels, _, _ = _fitted(spark, folder)
    return topic_model.predict_topics(ml_input(_prepared(spark, folder, dealt=True)), model, labels)


@_query("infer_topics")
def _infer_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Every question as the model takes and gives it; which tag is up to the model, that there is one is not."""
    tagged = F.col("decoded").isNotNull() & (F.col("prediction") >= 0)
    return _inferred(spark, folder).select("question_id", "Text", tagged.alias("tagged"))


@_query("infer_coverage")
def _infer_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Every question is tagged once, and with a tag that training has seen."""
    tagged = _inferred(spark, folder).groupBy("question_id", "decoded").agg(F.count("*").alias("n"))
    known = _stored_labels(spark, folder).select("tag", F.lit(True).alias("known"))
    return tagged.join(known, F.col("decoded") == F.col("tag"), "left").agg(
        F.sum("n").alias("rows"),
        F.countDistinct("question_id").alias("questions"),
        F.sum(F.when(F.col("known"), F.col("n"))).alias("known_tags"),
    )


@_query("eval_topic_model")
def _eval_topic_model(spark: SparkSession, folder: str) -> DataFrame:
    """Rows scored, and whether the model does better on them than the floor."""
    _, model, labels, held_out, _ = _fitted(spark, folder)
    scored = metrics.evaluate(topic_model.per_tag(topic_model.score(held_out, model, labels)))
    above = bool(scored.first()["accuracy"] >= ACCURACY_FLOOR)
    rows = held_out.select(F.explode("Tags").alias("tag")).filter("tag <> ''")
    return rows.agg(F.count("*").alias("scored")).withColumn("above_floor", F.lit(above))


#: How much less of the held-out rows a model in blocks of hashed features may name right than one of a single matrix.
BLOCK_MARGIN = 0.05


@_query("train_tag_blocks")
def _train_tag_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A model in blocks of tags: how many, the rows scored, and whether it does as well as the model of one matrix."""
    _, model, labels, held_out, _ = _fitted(spark, folder)
    learn, _ = train_test_split(checkpoint_parquet(_prepared(spark, folder, dealt=True).select("question_id", "Text", "Tags"), scratch(spark, "questions")))
    blocks = tag_blocks.fit_blocks(learn, scratch(spark, "tag-blocks"), TrainingSettings(vocabulary=1 << 14, max_iterations=30), block_tags=10)
    scored = tag_blocks.predict_blocks(held_out, blocks).select("question_id", "Tags", "decoded")
    accuracy, one_matrix = (metrics.evaluate(topic_model.per_tag(s)).first()["accuracy"] for s in (scored, topic_model.score(held_out, model, labels)))
    rows = held_out.select(F.explode("Tags").alias("tag")).filter("tag <> ''")
    sizes = [F.lit(n).cast("long").alias(name) for name, n in (("tags", blocks.tags), ("blocks", blocks.blocks))]
    return rows.agg(F.count("*").alias("scored")).select("scored", *sizes, F.lit(bool(accuracy >= one_matrix - BLOCK_MARGIN)).alias("as_good"))


@_query("decode_labels")
def _decode_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted indexes back to names, by the stage that decodes those of a model."""
    tagged = _tagged(spark, folder)
    counts = _topic_counts(tagged)
    predicted = _rule_predictions(tagged, counts).select("question_id", "prediction").filter("prediction IS NOT NULL")
    labels = [r["topic"] for r in _topic_index(counts).orderBy("label_index").collect()]
    named = topic_model.decode_predictions(predicted, labels)
    return named.select("question_id", F.col("prediction").cast("long").alias("prediction"), "decoded")


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return _rule_predictions(_tagged(spark, folder)).select("question_id", "Tags", "topic", "decoded")


@_query("confusion_matrix")
def _confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_judged(spark, folder), label="topic")


@_query("class_metrics")
def _class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    judged = metrics.confusion_matrix(_judged(spark, folder), label="topic")
    return _rounded(metrics.class_metrics(judged), "precision", "recall", "f1")


@_query("eval_metrics")
def _eval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.evaluate(_judged(spark, folder), label="topic"), "accuracy", "weighted_f1")


@_query("auc_by_topic")
def _auc_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    """How well the share of a topic among the questions of the same first tag and day tells that topic."""
    keyed = _tagged(spark, folder).select(F.get("Tags", F.lit(0)).alias("first_tag"), "day", "topic")
    found = checkpoint_parquet(keyed.groupBy("first_tag", "day", "topic").agg(F.count("*").alias("n")), scratch(spark, "topic-shares"))
    cells = found.groupBy("first_tag", "day").agg(F.sum("n").alias("cell_n")).withColumnsRenamed({"first_tag": "c_tag", "day": "c_day"})
    same = F.col("first_tag").eqNullSafe(F.col("c_tag")) & F.col("day").eqNullSafe(F.col("c_day"))
    held = found.join(cells, same).select("topic", (F.col("n") / F.col("cell_n")).alias("score"), F.col("n").alias("positives"), (F.col("cell_n") - F.col("n")).alias("negatives"))
    # Elsewhere a topic has share 0: all other questions are negatives there.
    rest = cells.agg(F.sum("cell_n").alias("n")).scalar() - F.sum(F.col("positives") + F.col("negatives"))
    absent = held.groupBy("topic").agg(F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("positives"), rest.alias("negatives"))
    counts = held.unionByName(absent).groupBy("topic", "score").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    return _rounded(metrics.area_under_curve(counts, "topic"), "auc")


@_query("any_tag_accuracy")
def _any_tag_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.any_tag_accuracy(_judged(spark, folder)), "any_tag_accuracy")


# --- result tables -----------------------------------------------------------------


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared questions, written once and read back where several writes or both sides of a join use them."""
    return checkpoint_parquet(_prepared(spark, folder), scratch(spark, "prepared"))


@_query("merge_predictions")
def _merge_predictions(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _stored(spark, folder)
    predicted = _rule_predictions(prepared).select("question_id", "Text", "prediction", "decoded")
    merged = results.merge_predictions(predicted, prepared)
    return merged.withColumns({"prediction": F.col("prediction").cast("int"), "Tags": F.array_join("Tags", ",")})


@_query("labeled_questions")
def _labeled_questions(spark: SparkSession, folder: str) -> DataFrame:
    """One batch, published twice: the table holds it once."""
    zones = _zones(spark, "labeled")
    predicted = _rule_predictions(_stored(spark, folder))
    publish_labeled(predicted, zones, FIRST_BATCH)
    publish_labeled(predicted, zones, FIRST_BATCH)
    return spark.table(zones.labeled_questions).withColumn("Tags", F.array_join("Tags", ","))


def _three_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All questions, then those that were edited, then those with a good score."""
    zones = _zones(spark, "batches")
    predicted = _rule_predictions(_stored(spark, folder))
    edited = predicted.filter(F.col("LastEditDate").isNotNull()).withColumn("decoded", F.lit("edited"))
    liked = predicted.filter(F.col("Score") > 3).withColumn("decoded", F.lit("liked"))
    for rows, stamp in ((predicted, FIRST_BATCH), (edited, SECOND_BATCH), (liked, THIRD_BATCH)):
        publish_labeled(rows, zones, stamp)
    return spark.table(zones.labeled_questions)


@_query("two_loads_one_hour")
def _two_loads_one_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads tagged within an hour, the first of them again with fewer rows, and one without rows."""
    zones = _zones(spark, "loads")
    predicted = _rule_predictions(_stored(spark, folder))
    first, second = (predicted.filter(F.col("question_id") % 2 == part) for part in (0, 1))
    for rows, load in ((first, "even"), (second, "odd"), (first.filter(F.col("Score") > 0), "even"), (second, "none"), (second.filter("false"), "none")):
        publish_labeled(rows, zones, FIRST_BATCH, load)
    return spark.table(zones.labeled_questions).select("question_id", "decoded", results.BATCH, results.LOAD)


def _published(spark: SparkSession, folder: str) -> DataFrame:
    """The published table as it was after the second batch, with its topic and day."""
    return results.topics_as_of(_three_batches(spark, folder), "2023-10-23 12:00:00")


@_query("published_top10_daily")
def _published_top10_daily(spark: SparkSession, folder: str) -> DataFrame:
    return trends.top_topics_daily(trends.topic_daily(_published(spark, folder)), 10)


@_query("published_engagement")
def _published_engagement(spark: SparkSession, folder: str) -> DataFrame:
    found = trends.engagement_by_topic(_published(spark, folder), views.users(spark, folder))
    return _rounded(found, *[name for name in found.columns if name.startswith("mean_")])


@_query("as_of_predictions")
def _as_of_predictions(spark: SparkSession, folder: str) -> DataFrame:
    known = results.as_of(_three_batches(spark, folder), "2023-10-23 12:00:00")
    return known.select("question_id", "decoded", results.BATCH)


@_query("batch_history")
def _batch_history(spark: SparkSession, folder: str) -> DataFrame:
    return results.batch_history(_three_batches(spark, folder))


def _moment(minute: int) -> datetime:
    """Times of publication, a minute apart."""
    return datetime(2023, 10, 24, 3, minute, tzinfo=timezone.utc)


def _republished(spark: SparkSession, folder: str) -> Zones:
    """Two loads of an hour; the first again, corrected and with fewer rows; the second again without rows, and whole."""
    zones = _zones(spark, "republished")
    predicted = _rule_predictions(_stored(spark, folder))
    first, second = (predicted.filter(F.col("question_id") % 2 == part) for part in (0, 1))
    corrected = first.filter(F.col("Score") > 0).withColumn("decoded", F.lit("corrected"))
    for minute, (rows, load) in enumerate(((first, "first"), (second, "it's"), (corrected, "first"), (second.filter("false"), "it's"), (second, "it's"))):
        publish_labeled(rows, zones, FIRST_BATCH, load, _moment(minute))
    return zones


@_query("history_after_republish")
def _history_after_republish(spark: SparkSession, folder: str) -> DataFrame:
    """The table as it stood after each publication, and as a reader of the table finds it."""
    zones = _republished(spark, folder)
    states = [published_as_of(spark, zones, _moment(minute)).withColumn("state", F.lit(f"after {minute}")) for minute in range(5)]
    states.append(spark.table(zones.labeled_questions).withColumn("state", F.lit("now")))
    return reduce(DataFrame.unionByName, [state.select("state", "question_id", "decoded", results.BATCH, results.LOAD) for state in states])


@_query("publications")
def _publications(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of these publications after those replaced by the third minute are pruned."""
    zones = _republished(spark, folder)
    prune(spark, labeled_location(zones), _moment(3))
    listed = publications(spark, labeled_location(zones))
    return listed.select(F.get("partition", F.lit(1)).alias("load"), "rows", "published_at", "replaced_at")


@_query("published_evolution")
def _published_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """A batch, a table that then gains a column and wider counts, and a batch that has them."""
    zones = _zones(spark, "evolution")
    location, by = labeled_location(zones), (results.BATCH, results.LOAD)
    predicted = _rule_predictions(_stored(spark, folder))
    publish_labeled(predicted, zones, FIRST_BATCH, "all", _moment(0))
    wide = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name == "ViewCount" else f.dataType) for f in LABELED_QUESTIONS][:-2]
        + [T.StructField("certainty", T.DoubleType()), *LABELED_QUESTIONS[-2:]]
    )
    evolve(spark, zones.labeled_questions, wide, location, by)
    liked = predicted.filter(F.col("Score") > 3).withColumns({"ViewCount": F.col("ViewCount") + (1 << 40), "certainty": F.col("Score").cast("double") / 2})
    rows = results.labeled_questions(liked, SECOND_BATCH, "all", wide)
    publish_version(rows, zones.labeled_questions, wide, location, by, ("2023-10-23 02:00:00", "all"), _moment(1))
    return spark.table(zones.labeled_questions).select("question_id", "decoded", "ViewCount", "certainty", results.BATCH)


@_query("compacted_publication")
def _compacted_publication(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and files of a load before and after its small files are joined; the rows are the same."""
    zones = _zones(spark, "compaction")
    location, by = labeled_location(zones), (results.BATCH, results.LOAD)
    predicted = _rule_predictions(_stored(spark, folder)).repartition(12, "question_id")
    publish_labeled(predicted, zones, FIRST_BATCH, "all", _moment(0))
    compact(spark, zones.labeled_questions, LABELED_QUESTIONS, location, by, published_at=_moment(1))
    states = [published_as_of(spark, zones, _moment(minute)).select("question_id", "Title", "decoded", F.lit(minute).alias("state"), F.input_file_name().alias("file")) for minute in (0, 1)]
    return states[0].unionByName(states[1]).groupBy("state").agg(
        F.count("*").alias("rows"), F.sum("question_id").alias("ids"), F.count("decoded").alias("decoded"), (F.countDistinct("file") > 1).alias("many_files")
    )


@_query("users_dim")
def _users_dim(spark: SparkSession, folder: str) -> DataFrame:
    zones = _zones(spark, "users")
    location = f"{zones.serving}/users_dim"
    create_database(spark, zones.database, f"{zones.serving}/database")
    create_external_table(spark, zones.users_dim, USERS_DIM, location)
    dim = build_users_dim(views.users(spark, folder), FIRST_BATCH)
    overwrite_table(dim, zones.users_dim, USERS_DIM, location)
    return spark.table(zones.users_dim)


@_query("streamed_questions")
def _streamed_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Posts that arrive in two increments, the second of which is run again; each question is published once."""
    zones = _zones(spark, "streamed")
    source, checkpoint = f"{zones.landing}/arriving", f"{zones.intermediate}/stream"

    def tag(posts: DataFrame) -> DataFrame:
        questions = prepare_questions(posts, views.post_types(posts.sparkSession))
        return questions.withColumns({"decoded": last_tag("Tags"), "prediction": F.lit(0.0)})

    posts = views.posts(spark, folder)
    for part in (0, 1):
        posts.filter(F.col("id") % 2 == part).write.parquet(f"{source}/{part}")
        publish_arrivals(spark, zones, source, checkpoint, tag, batch=FIRST_BATCH)
    # As after a failure between the publication and the note that it is done.
    delete_folder(spark, f"{checkpoint}/commits/1")
    publish_arrivals(spark, zones, source, checkpoint, tag, batch=SECOND_BATCH)
    return spark.table(zones.labeled_questions).select("question_id", "decoded", results.BATCH, results.LOAD)


# --- topic reports -----------------------------------------------------------------


@_query("sample_by_topic")
def _sample_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Five questions of each topic, whatever the partitions are."""
    return sample_per_group(_tagged(spark, folder), "topic", ["question_id"], 5).select("topic", "question_id", "Title")


def _summarized(spark: SparkSession, folder: str) -> Zones:
    """Three batches with their summaries; the second is then published again with other topics and fewer rows."""
    zones = _zones(spark, "summaries")
    predicted = _rule_predictions(_stored(spark, folder))
    edited = predicted.filter(F.col("LastEditDate").isNotNull())
    liked = predicted.filter(F.col("Score") > 3).withColumn("decoded", F.lit("liked"))
    again = edited.filter(F.col("question_id") % 3 == 0).withColumn("decoded", F.lit("edited"))
    for rows, stamp in ((predicted, FIRST_BATCH), (edited, SECOND_BATCH), (liked, THIRD_BATCH), (again, SECOND_BATCH)):
        publish_labeled(rows, zones, stamp)
        summarize_load(spark, zones, stamp)
    users = build_users_dim(views.users(spark, folder), FIRST_BATCH)
    create_external_table(spark, zones.users_dim, USERS_DIM, f"{zones.serving}/users_dim")
    overwrite_table(users, zones.users_dim, USERS_DIM, f"{zones.serving}/users_dim")
    return zones


@_query("summary_trend")
def _summary_trend(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary_report(spark, _summarized(spark, folder), "trend"), "share")


@_query("summary_engagement")
def _summary_engagement(spark: SparkSession, folder: str) -> DataFrame:
    found = summary_report(spark, _summarized(spark, folder), "engagement")
    return _rounded(found, *[name for name in found.columns if name.startswith("mean_")])


@_query("summary_drilldown")
def _summary_drilldown(spark: SparkSession, folder: str) -> DataFrame:
    return summary_report(spark, _summarized(spark, folder), "drilldown")


@_query("distinct_by_range")
def _distinct_by_range(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct owners and titles of ranges of days, exactly and by sketches of single days that are stored and merged.

    A range is a week, the month, or its second half; the sketches must keep within their stated error.
    """
    posts = views.posts(spark, folder).select("CreationDate", "OwnerUserId", "Title")
    day = F.dayofmonth("CreationDate")
    ranges = F.explode(F.array(F.concat(F.lit("week "), F.floor((day - 1) / 7).cast("string")), F.lit("month"), F.when(day > 14, F.lit("half")).otherwise(F.lit("first half"))))
    daily = checkpoint_parquet(sketches.sketches(posts, ["CreationDate"], owners="OwnerUserId", titles="Title"), scratch(spark, "sketches"))
    estimated = sketches.merged(daily.withColumn("span", ranges), ["span"], "owners", "titles")
    exact = posts.withColumn("span", ranges).groupBy("span").agg(F.countDistinct("OwnerUserId").alias("n_owners"), F.countDistinct("Title").alias("n_titles"))
    near = lambda name: (F.abs(F.col(name) - F.col(f"n_{name}")) <= F.ceil(F.col(f"n_{name}") * sketches.error_bound())).alias(f"{name}_near")
    return exact.join(estimated, "span").select("span", "n_owners", "n_titles", near("owners"), near("titles"))


@_query("topic_totals")
def _topic_totals(spark: SparkSession, folder: str) -> DataFrame:
    return trends.topic_totals(_tagged(spark, folder))


@_query("topic_daily")
def _topic_daily(spark: SparkSession, folder: str) -> DataFrame:
    return trends.topic_daily(_tagged(spark, folder))


@_query("topic_trend")
def _topic_trend(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(trends.topic_trend(trends.topic_daily(_tagged(spark, folder))), "share")


@_query("top10_topics_daily")
def _top10_topics_daily(spark: SparkSession, folder: str) -> DataFrame:
    return trends.top_topics_daily(trends.topic_daily(_tagged(spark, folder)), 10)


@_query("engagement_by_topic")
def _engagement_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    found = trends.engagement_by_topic(_tagged(spark, folder), views.users(spark, folder))
    return _rounded(found, *[name for name in found.columns if name.startswith("mean_")])


@_query("topic_drilldown")
def _topic_drilldown(spark: SparkSession, folder: str) -> DataFrame:
    return trends.topic_drilldown(_tagged(spark, folder))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Learn topics, tag every question with them and report the ten most frequent."""
    return trends.topic_totals(_inferred(spark, folder), k=10, topic="decoded")
