"""Training of the topic model from landed posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import TrainingSettings, Zones
from tagloom.operators.metrics import any_tag_accuracy, evaluate
from tagloom.operators.questions import prepare_questions
from tagloom.operators.split import train_test_split
from tagloom.operators.topic_model import fit_topic_model, load_model, per_tag, save_model, score
from tagloom.schemas import POST_TYPES
from tagloom.sinks.files import checkpoint_parquet
from tagloom.sources.files import read_csv, read_posts


def train(spark: SparkSession, zones: Zones, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """Learn from all landed posts, store the model and return its metrics on held-out questions.

    The cleaned questions are written once and read back, so that cleaning is not
    repeated by the passes of the fit. The stored model, read back, is the one that is
    evaluated.
    """
    post_types = read_csv(spark, zones.post_types, POST_TYPES)
    questions = prepare_questions(read_posts(spark, zones.posts), post_types).select("question_id", "Text", "Tags")
    questions = checkpoint_parquet(questions, f"{zones.intermediate}/questions", mode="overwrite")
    learn, held_out = train_test_split(questions, train_share=settings.train_share)

    save_model(fit_topic_model(learn, settings), zones.model, zones.label_index)
    model, labels = load_model(zones.model, zones.label_index)

    scored = checkpoint_parquet(score(held_out, model, labels), f"{zones.intermediate}/scored", mode="overwrite")
    metrics = {**evaluate(per_tag(scored)).first().asDict(), **any_tag_accuracy(scored).first().asDict()}
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in metrics.items()])
