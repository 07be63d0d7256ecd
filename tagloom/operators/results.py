"""The labeled-questions table: rows, merging of predictions, and reading as of a time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.functions.stamps import batch_stamp
from tagloom.schemas import LABELED_QUESTIONS

BATCH = "batch_datetime_stamp"
LOAD = "load"


def merge_predictions(predictions: DataFrame, questions: DataFrame) -> DataFrame:
    """Question columns joined to ``question_id, Text, prediction, decoded``.

    The rows match on id, null ids too, and on text, and equal predictions are merged first.
    So a question that was delivered k times gives k rows, not k times k. Texts take part as
    digests; that of a match comes from the question, so that merging sorts no texts.

    Predictions without a question are kept, as by a left join. They are added apart, as
    Spark can split the many copies of one question over tasks in an inner join only.
    """
    keys = ["question_id", "__text"]
    digest = F.sha2("Text", 256)
    unique = predictions.select("question_id", digest.alias("__text"), "prediction", "decoded").distinct()
    details = questions.withColumn("__text", digest)
    named = details.withColumnsRenamed({"question_id": "__id", "__text": "__digest"})
    same = unique["question_id"].eqNullSafe(named["__id"]) & unique["__text"].eqNullSafe(named["__digest"])
    matched = unique.join(named, same).drop("__text", "__id", "__digest")
    known = questions.select(F.col("question_id").alias("__id"), digest.alias("__digest")).distinct()
    texts = predictions.withColumn("__text", digest)
    alone = texts.join(known, texts["question_id"].eqNullSafe(known["__id"]) & texts["__text"].eqNullSafe(known["__digest"]), "left_anti")
    unmatched = alone.dropDuplicates([*keys, "prediction", "decoded"]).drop("__text")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def labeled_questions(tagged: DataFrame, batch: datetime | str | None = None, load: str = "", schema: StructType = LABELED_QUESTIONS) -> DataFrame:
    """``tagged`` in the columns and types of the table, with its batch stamp and load."""
    stamped = tagged.withColumns({BATCH: batch_stamp(batch), LOAD: F.lit(load)})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def batch_history(labeled: DataFrame) -> DataFrame:
    """Per batch: rows and questions. A difference between the two shows duplicate ids."""
    return labeled.groupBy(BATCH).agg(
        F.count("*").alias("rows"), F.countDistinct("question_id").alias("questions")
    )


def topics_as_of(labeled: DataFrame, moment: datetime | str | None = None) -> DataFrame:
    """The published questions with their topic and day for the reports, now or at ``moment``; untagged ones are left out."""
    known = labeled if moment is None else as_of(labeled, moment)
    return known.withColumns({"topic": F.col("decoded"), "day": F.col("CreationDate").cast("date")}).filter("topic IS NOT NULL")


def as_of(labeled: DataFrame, moment: datetime | str) -> DataFrame:
    """The state at ``moment``: for each question the rows of its latest batch up to then.

    Later batches are not read. The latest batch per question is a partial aggregation
    on two narrow columns; the join back is on id and batch, so its exchange is not that
    of the aggregation and can be split where an id is hot.
    """
    seen = labeled.filter(F.col(BATCH) <= F.lit(moment).cast("timestamp"))
    latest = seen.groupBy(F.col("question_id").alias("__id")).agg(F.max(BATCH).alias("__latest"))
    newest = F.col("question_id").eqNullSafe(F.col("__id")) & (F.col(BATCH) == F.col("__latest"))
    return seen.join(latest, newest).select(*labeled.columns)
