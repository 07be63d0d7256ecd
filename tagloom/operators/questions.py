"""From posts to cleaned questions, their tags and the training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import parse_tags
from tagloom.functions.text import clean_text
from tagloom.operators.joins import join_dimension
from tagloom.session import deal

# The post type that is tagged, and post columns that questions do not use.
QUESTION = "Question"
UNUSED = ("LastEditorDisplayName", "ParentId")


def with_type(posts: DataFrame, post_types: DataFrame) -> DataFrame:
    """Posts with their ``Type``; posts without a known type drop out.

    ``id`` becomes ``question_id``, as it would collide with the ``Id`` of the types.
    """
    posts = posts.withColumnRenamed("id", "question_id")
    types = post_types.withColumnRenamed("Id", "__type_id")
    return join_dimension(posts, types, "PostTypeId", "__type_id").drop("__type_id")


def question_posts(posts: DataFrame, post_types: DataFrame) -> DataFrame:
    """Question posts with parsed tags. Filtering on the type makes the join an inner one."""
    questions = with_type(posts, post_types.filter(F.col("Type") == QUESTION))
    return questions.drop(*UNUSED).withColumn("Tags", parse_tags("Tags"))


def prepare_questions(posts: DataFrame, post_types: DataFrame, order: str = "train", dealt: bool = False) -> DataFrame:
    """Question posts with a body, the body cleaned into ``Text``.

    Training and tagging both use the default ``order``; see ``clean_text``. With ``dealt``, the questions are dealt
    out evenly before they are cleaned: for what costs more per question than a shuffle of its body.
    """
    questions = question_posts(posts, post_types).filter(F.col("Body").isNotNull())
    if dealt:
        questions = deal(questions)
    return questions.withColumn("Text", clean_text("Body", order)).drop("Body")


def ml_input(prepared: DataFrame) -> DataFrame:
    """What the model reads."""
    return prepared.select("question_id", "Text")


def text_and_tags(questions: DataFrame, text: str = "Text") -> DataFrame:
    """One row per question and tag. Questions without tags drop out, empty tags stay."""
    return questions.select("question_id", F.col(text).alias("Text"), F.explode("Tags").alias("tag"))


def training_corpus(posts: DataFrame, post_types: DataFrame) -> DataFrame:
    """``question_id, Text, tag`` to learn from; the empty tag is no topic and drops out.

    The text is cleaned before the tags are exploded, once per question.
    """
    return text_and_tags(prepare_questions(posts, post_types)).filter(F.col("tag") != "")
