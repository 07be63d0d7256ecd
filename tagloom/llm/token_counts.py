"""Token counts for every context limit, from an exact histogram of encoded lengths.

Documents are encoded and counted per length; sums over the histogram from the longest
length down then answer how many documents exceed a limit, how many tokens remain when
texts are cut there, and quantiles, without a look at the documents.

Null and empty texts have length 0 and count. Repeated rows count each. No rows give an
empty curve. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.byte_bpe import byte_bpe
from tagloom.llm.frames import staged, text_of

#: Lengths per block; sums run within blocks, then over the blocks.
BLOCK = 1024


def token_count(vocabulary: str, text: Column) -> Column:
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        bpe = byte_bpe(vocabulary)
        return pd.Series([bpe.length(t) for t in texts], dtype="int64")

    return count(text)


def histogram(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``n_tokens, docs``: how many documents have each encoded length."""
    return docs.select(token_count(vocabulary, text_of(text)).alias("n_tokens")).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def curve(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs, taken as a context limit.

    ``docs`` have that length, ``docs_longer`` exceed it, ``docs_within`` do not;
    ``tokens_within`` are the tokens of the latter, ``tokens_cut`` the total when all texts are
    cut at the limit, ``tokens_lost`` what the cut takes, ``quantile`` the share of documents within.
    """
    hist = staged(lengths, "histogram").withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.col("docs") * F.col("n_tokens")
    blocks = hist.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    totals = blocks.select(
        F.col("block").alias("b"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(Window.partitionBy()).alias("all_docs"),
        F.sum("t").over(Window.partitionBy()).alias("all_tokens"),
    )
    suffix = (
        hist.withColumn("d", F.sum("docs").over(down)).withColumn("t", F.sum(tokens).over(down))
        .join(totals, F.col("block") == F.col("b"))
        .withColumn("docs_longer", F.col("docs_above") + F.col("d") - F.col("docs"))
        .withColumn("tokens_longer", F.col("tokens_above") + F.col("t") - tokens)
    )
    return suffix.select(
        "n_tokens", "docs", "docs_longer",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_within"),
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_within"),
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("tokens_cut"),
        (F.col("tokens_longer") - F.col("docs_longer") * F.col("n_tokens")).alias("tokens_lost"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"),
    )


def cut_totals(points: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context, docs_longer, tokens_cut`` of any context limits, from the rows of ``curve``."""
    asked = [F.struct(F.lit(int(x)).cast("long").alias("context")) for x in limits]
    first = points.agg(F.sum("docs").alias("docs"))
    columns = [
        F.struct(
            a["context"].alias("context"),
            F.sum(F.when(F.col("n_tokens") > a["context"], F.col("docs")).otherwise(0)).alias("docs_longer"),
            F.sum(F.least("n_tokens", a["context"]) * F.col("docs")).alias("tokens_cut"),
        )
        for a in asked
    ]
    return points.agg(F.array(*columns).alias("rows")).select(F.inline("rows")) if columns else first.filter("false")


def length_quantile(points: DataFrame, share: float) -> int | None:
    """The smallest length within which at least ``share`` of the documents lie."""
    return points.filter(F.col("quantile") >= share).agg(F.min("n_tokens")).first()[0]
