"""A training corpus from raw documents, in five stages.

Toxic documents go, of equal texts one stays, of near-duplicate texts one stays, documents
that hold benchmark items go, and what remains is encoded to pieces. Each stage is written
as Parquet to the shared folder and read back as the documents of the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, exact_dedup, sentence_piece, simhash, toxicity
from tagloom.llm.frames import documents, ship, staged

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a scorer that learns from the labels."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity.learn(docs, documents(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (three-word shingles, two bits) the document with the smallest id."""
    ship(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, distance=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece_ids, n_pieces, round_trip``: each text as pieces, and whether these decode to it."""
    ship(spark)
    rows = sentence_piece.encode_checked(docs.select("doc_id", "text"), PIECES)
    return rows.select("doc_id", "piece_ids", F.size("piece_ids").alias("n_pieces"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: SQL states neither a learned score nor fingerprints; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
