"""Topic reports. All start from counts that are grouped before anything is ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.ranking import top_per_group


def topic_totals(tagged: DataFrame, k: int | None = 20, topic: str = "topic") -> DataFrame:
    """The ``k`` most frequent topics with their counts; ties in order of name."""
    totals = tagged.groupBy(topic).agg(F.count(topic).alias("qty"))
    ordered = totals.orderBy(F.desc("qty"), topic)
    return ordered.limit(k) if k is not None else ordered


def topic_daily(tagged: DataFrame) -> DataFrame:
    """Questions per day and topic."""
    return tagged.groupBy("day", "topic").agg(F.count("*").alias("n"))


def topic_trend(daily: DataFrame) -> DataFrame:
    """Per day and topic: count, share of the day and change against the day before.

    A topic that the day before did not have counts as zero there. The total of a day is
    joined, so its topics need not meet in one task; the window holds the days of a topic.
    """
    by_topic = Window.partitionBy("topic").orderBy("day")
    follows = F.lag("day").over(by_topic) == F.date_sub("day", 1)
    before = F.coalesce(F.when(follows, F.lag("n").over(by_topic)), F.lit(0))
    totals = daily.groupBy(F.col("day").alias("__day")).agg(F.sum("n").alias("__total"))
    compared = daily.withColumn("previous_n", before)
    return compared.join(totals, F.col("day").eqNullSafe(F.col("__day"))).select(
        "day",
        "topic",
        "n",
        "previous_n",
        (F.col("n") / F.col("__total")).alias("share"),
        (F.col("n") - F.col("previous_n")).alias("change"),
    )


def top_topics_daily(daily: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent topics of each day; ties in order of name."""
    return top_per_group(daily, "day", [F.desc("n"), F.col("topic")], k)


# The engagement columns of a question.
ENGAGEMENT = ("AnswerCount", "CommentCount", "FavoriteCount", "Score", "ViewCount")


#: The finest grain that the reports start from.
GRAIN = ("day", "topic", "Type", "OwnerUserId")


def _measures() -> list[Column]:
    return [
        F.count("*").alias("questions"),
        *[F.sum(F.col(name).cast("double")).alias(f"sum_{name}") for name in ENGAGEMENT],
        *[F.count(name).alias(f"n_{name}") for name in ENGAGEMENT],
    ]


def topic_counts(tagged: DataFrame) -> DataFrame:
    """Questions, sums and numbers of each engagement column at the finest grain. Such counts of several batches add up."""
    return tagged.groupBy(*GRAIN).agg(*_measures())


def merged_counts(counts: DataFrame, *groups: str) -> DataFrame:
    """The same at a coarser grain, from counts of any number of batches."""
    names = ["questions", *[f"{part}_{name}" for part in ("sum", "n") for name in ENGAGEMENT]]
    return counts.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in names])


def engagement_by_topic(tagged: DataFrame, users: DataFrame) -> DataFrame:
    """Per topic: questions, sum and mean of each engagement column, and its owners.

    Questions are first grouped by topic and owner. An owner with very many questions,
    or questions without one, then bring one row per topic to the join with the users.
    """
    return engagement_of_counts(tagged.groupBy("topic", "OwnerUserId").agg(*_measures()), users)


def engagement_of_counts(partial: DataFrame, users: DataFrame) -> DataFrame:
    """The same from counts per topic and owner."""
    owners = users.groupBy(F.col("id").alias("OwnerUserId")).agg(F.max("Reputation").alias("Reputation"))
    joined = partial.join(owners, "OwnerUserId", "left")
    return joined.groupBy("topic").agg(
        F.sum("questions").alias("questions"),
        *[F.sum(f"sum_{name}").alias(f"total_{name}") for name in ENGAGEMENT],
        *[(F.sum(f"sum_{name}") / F.nullif(F.sum(f"n_{name}"), F.lit(0))).alias(f"mean_{name}") for name in ENGAGEMENT],
        F.count("OwnerUserId").alias("owners"),
        F.count("Reputation").alias("known_owners"),
        F.avg("Reputation").alias("mean_owner_reputation"),
    )


def topic_drilldown(tagged: DataFrame) -> DataFrame:
    """Questions at each level type / topic / day, with subtotals and the grand total.

    Rolling up multiplies rows by four, so it is applied to the grouped counts.
    """
    return drilldown_of_counts(tagged.groupBy("Type", "topic", "day").agg(F.count("*").alias("n")))


def drilldown_of_counts(finest: DataFrame) -> DataFrame:
    """The same from ``Type, topic, day, n``."""
    return finest.rollup("Type", "topic", "day").agg(
        F.sum("n").alias("n"), F.grouping_id().cast("long").alias("level")
    )
