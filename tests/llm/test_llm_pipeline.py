"""The pipeline stages: each on what the one before kept, and the queries as registered."""

from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
import oracle
import pytest

from tagloom.llm import catalog


def test_registered_queries():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {f"{x.split('_')[0]}_" for x in catalog.queries()}
    assert set(catalog.oracle_sql()) <= names and corpus_pipeline.ORACLE_SQL is None


def test_each_stage_keeps_columns_and_only_removes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, small).cache()
        ids, before = {r.doc_id for r in kept.collect()}, {r.doc_id for r in docs.collect()}
        assert ids <= before and kept.count() == len(ids)
        if name == "sentencepiece":
            assert ids == before and all(r.round_trip and len(r.piece_ids) == r.n_pieces for r in kept.collect())
        else:
            assert kept.columns == docs.columns
            docs = kept


def test_stages_drop_what_they_should(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, small).collect()}
    assert kept == set({t: d for d, t in sorted(texts.items())}.values())
    groups = {r.doc_id: r.component_id for r in catalog.queries()["op10_simhash"](spark, small).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()} == set(groups.values())
    leaked = {r.doc_id for r in catalog.queries()["op4_decontaminate"](spark, small).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, small).collect()} == set(texts) - leaked


def test_stages_take_odd_and_empty_documents(spark, small, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, small)
            assert name == "sentencepiece" or kept.columns == docs.columns
            kept.count()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_queries_equal_their_sql(spark, small, name):
    assert oracle.differences(catalog.queries()[name](spark, small), oracle.connect(small), catalog.oracle_sql()[name]) == []
