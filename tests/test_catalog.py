"""Every named query against its SQL, and the shape of plans that matter at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import oracle
from conftest import SMALL, plan
from tagloom import catalog

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SMALL)


@pytest.fixture(scope="module")
def build(spark):
    """Query results by name, each built once."""
    built = {}

    def get(name):
        if name not in built:
            built[name] = QUERIES[name](spark, SMALL)
        return built[name]

    return get


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(build, connection, name):
    assert oracle.differences(build(name), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(build, name):
    assert build(name).count() > 0


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert 0 < len(rows) <= 10 and [r.qty for r in rows] == sorted((r.qty for r in rows), reverse=True)


@pytest.mark.parametrize("name", ["topic_daily", "topic_totals", "engagement_by_topic", "posts_with_type", "train_test_split"])
def test_reports_do_not_read_the_text(build, name):
    assert "text:string" not in plan(build(name))


@pytest.mark.parametrize("name", ["ml_input", "training_corpus", "text_and_tags", "tokens", "filtered_tokens", "train_test_split"])
def test_row_wise_queries_do_not_shuffle(build, name):
    physical = plan(build(name))
    assert "Exchange hashpartitioning" not in physical and "SinglePartition" not in physical


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_has_python_or_cross_joins(build, name):
    physical = plan(build(name))
    assert not any(word in physical for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"))
