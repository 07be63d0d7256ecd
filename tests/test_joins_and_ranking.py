from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tagloom.operators.joins import fits_broadcast, join_dimension
from tagloom.operators.ranking import top_per_group, with_global_index
from tagloom.session import scratch, shared_root


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, another third has none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return spark.range(3000).select("id", key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("dk"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_shuffled_and_broadcast_joins_agree(facts, dim, how):
    small = join_dimension(facts, dim, "k", "dk", how, broadcast=True)
    shuffled = join_dimension(facts, dim, "k", "dk", how, broadcast=False)
    assert shuffled.columns == small.columns
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, small.collect()))
    assert "BroadcastHashJoin" in plan(small)


def test_the_size_of_a_dimension_is_measured(dim):
    assert fits_broadcast(dim)
    assert not fits_broadcast(dim, rows=39)
    assert not fits_broadcast(dim, size=100)


def test_global_index_over_many_partitions(spark):
    rows = spark.range(1000, numPartitions=13).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 9).alias("g"))
    indexed = with_global_index(rows, [F.desc("g"), F.col("v")], "at").collect()
    expected = sorted(((row.v, row.g) for row in indexed), key=lambda r: (-r[1], r[0]))
    assert [row.at for row in sorted(indexed, key=lambda r: r.at)] == list(range(1000))
    assert [(row.v, row.g) for row in sorted(indexed, key=lambda r: r.at)] == expected


def test_global_index_of_nothing(spark):
    assert with_global_index(spark.range(0), [F.col("id")], "at").count() == 0


def test_top_per_group_cuts_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 4).alias("g"), "id")
    top = top_per_group(rows, "g", [F.desc("id")], 2)
    assert sorted((r.g, r.id, r["rank"]) for r in top.collect()) == sorted(
        (g, 96 + g - 4 * i, i + 1) for g in range(4) for i in range(2)
    )
    assert "WindowGroupLimit" in plan(top) and "Partial" in plan(top)


def test_scratch_paths_lie_in_the_shared_folder_and_differ(spark):
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def test_a_cluster_without_a_shared_folder_is_refused():
    context = SimpleNamespace(
        master="spark://host:7077",
        getConf=lambda: SimpleNamespace(get=lambda key: None),
        getCheckpointDir=lambda: None,
    )
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session)
