"""Publications that stay: earlier states, pruning, compaction and evolution of a table."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan
from tagloom.operators.conform import SchemaMismatch
from tagloom.sinks.tables import create_database, create_external_table
from tagloom.sinks.versions import HistoryPruned, as_published, compact, evolve, publications, prune, publish_version

BY = ("at", "load")
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("at", T.TimestampType()), T.StructField("load", T.StringType())])
HOUR = "2023-10-22 02:00:00"


def moment(minute):
    return datetime(2023, 10, 22, 3, minute, tzinfo=timezone.utc)


@pytest.fixture
def table(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    create_database(spark, name, str(tmp_path / "db"))
    create_external_table(spark, f"{name}.t", SCHEMA, str(tmp_path / "t"), BY)
    return f"{name}.t", str(tmp_path / "t")


def publish(spark, table, rows, minute, load="a", n=1, schema=SCHEMA):
    df = rows if not isinstance(rows, int) else spark.range(rows).select("id", F.lit(n).alias("n"))
    return publish_version(df, table[0], schema, table[1], BY, (HOUR, load), moment(minute))


def state(df):
    return {(r.load, r.n): r["count"] for r in df.groupBy("load", "n").count().collect()}


def test_earlier_publications_stay_readable(spark, table):
    publish(spark, table, 5, 1)
    publish(spark, table, 4, 2, "b", 7)
    publish(spark, table, 3, 3, n=2)
    assert state(spark.table(table[0])) == state(as_published(spark, SCHEMA, table[1])) == {("a", 2): 3, ("b", 7): 4}
    assert state(as_published(spark, SCHEMA, table[1], moment(2))) == {("a", 1): 5, ("b", 7): 4}
    assert state(as_published(spark, SCHEMA, table[1], "2023-10-22 03:01:30")) == {("a", 1): 5}
    assert as_published(spark, SCHEMA, table[1], moment(0)).count() == 0
    listed = {(r.partition[1], r["rows"]): (r.published_at, r.replaced_at) for r in publications(spark, table[1]).collect()}
    assert [len(listed), listed["a", 5][1], listed["a", 3][1]] == [3, listed["a", 3][0], None]


def test_publications_of_one_partition_are_in_order(spark, table):
    publish(spark, table, 5, 2)
    for minute in (1, 2):
        with pytest.raises(ValueError, match="or later"):
            publish(spark, table, 4, minute)
    publish(spark, table, 4, 1, "b")
    assert state(spark.table(table[0])) == {("a", 1): 5, ("b", 1): 4}


def test_a_failed_publication_changes_nothing(spark, table):
    publish(spark, table, 5, 1)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"), F.lit(1).alias("n"))
    with pytest.raises(Exception, match="no"):
        publish(spark, table, broken, 2)
    with pytest.raises(SchemaMismatch):
        publish(spark, table, spark.range(3), 3)
    assert state(spark.table(table[0])) == state(as_published(spark, SCHEMA, table[1])) == {("a", 1): 5}


def test_a_publication_without_rows_empties_its_partition(spark, table):
    publish(spark, table, 5, 1)
    publish(spark, table, 0, 2)
    assert spark.table(table[0]).count() == 0 and spark.sql(f"SHOW PARTITIONS {table[0]}").count() == 0
    assert as_published(spark, SCHEMA, table[1]).count() == 0 and as_published(spark, SCHEMA, table[1], moment(1)).count() == 5
    publish(spark, table, 2, 3)
    assert state(spark.table(table[0])) == {("a", 1): 2}


@pytest.mark.parametrize("load", ["it's", 'x "y" z', "a/b=c", "back\\slash", "100%", "über", "a b:c?*#{}[]^"])
def test_loads_of_any_name(spark, table, load):
    publish(spark, table, 3, 1, load)
    publish(spark, table, 2, 2, load)
    publish(spark, table, 1, 1, "plain")
    expected = {(load, 1): 2, ("plain", 1): 1}
    assert state(spark.table(table[0])) == state(as_published(spark, SCHEMA, table[1])) == expected
    assert spark.table(table[0]).filter(F.col("load") == load).count() == 2


def test_a_load_without_a_name_is_refused(spark, table):
    with pytest.raises(ValueError, match="null or empty"):
        publish(spark, table, 3, 1, "")


def test_another_catalog_sees_what_stands(spark, table):
    publish(spark, table, 5, 1)
    publish(spark, table, 3, 2, n=2)
    publish(spark, table, 2, 2, "it's")
    publish(spark, table, 0, 3, "it's")
    create_external_table(spark, f"{table[0]}_again", SCHEMA, table[1], BY)
    assert state(spark.table(f"{table[0]}_again")) == {("a", 2): 3}


def test_pruned_history_is_refused(spark, table):
    for minute, rows in enumerate((5, 4, 3), 1):
        publish(spark, table, rows, minute)
    publish(spark, table, 9, 1, "b")
    assert prune(spark, table[1], moment(2)) == 1
    assert publications(spark, table[1]).count() == 3
    assert state(as_published(spark, SCHEMA, table[1], moment(2))) == {("a", 1): 4, ("b", 1): 9}
    with pytest.raises(HistoryPruned):
        as_published(spark, SCHEMA, table[1], moment(1))
    assert prune(spark, table[1], moment(9)) == 1
    assert state(spark.table(table[0])) == state(as_published(spark, SCHEMA, table[1])) == {("a", 1): 3, ("b", 1): 9}


def test_only_asked_partitions_are_read(spark, table):
    publish(spark, table, 5, 1)
    physical = plan(spark.table(table[0]).filter(F.col("at") <= HOUR))
    assert "PartitionFilters: [isnotnull(at" in physical


def test_small_files_become_few(spark, table):
    publish(spark, table, spark.range(900).select("id", F.lit(1).alias("n")).repartition(9), 1)
    publish(spark, table, spark.range(50).select("id", F.lit(2).alias("n")).coalesce(1), 1, "one file")
    before = spark.table(table[0]).select("id", "n", "load")
    rows = sorted(map(tuple, before.collect()))
    assert compact(spark, table[0], SCHEMA, table[1], BY, published_at=moment(5)) == 1
    after = spark.table(table[0])
    assert sorted(map(tuple, after.select("id", "n", "load").collect())) == rows
    assert len({r[0] for r in after.filter("load = 'a'").select(F.input_file_name()).distinct().collect()}) == 1
    # Who has the older files goes on reading them, and a second pass has nothing to do.
    assert sorted(map(tuple, before.collect())) == rows and state(as_published(spark, SCHEMA, table[1], moment(4))) == {("a", 1): 900, ("one file", 2): 50}
    assert compact(spark, table[0], SCHEMA, table[1], BY) == 0


WIDE = T.StructType([SCHEMA["id"], T.StructField("n", T.LongType()), T.StructField("sure", T.DoubleType()), SCHEMA["at"], SCHEMA["load"]])


def test_a_table_gains_columns_and_wider_types(spark, table):
    publish(spark, table, 3, 1)
    files = sorted(r[0] for r in spark.table(table[0]).select(F.input_file_name()).distinct().collect())
    assert evolve(spark, table[0], WIDE, table[1], BY) == ["n bigint", "sure double"]
    assert evolve(spark, table[0], WIDE, table[1], BY) == []
    new = spark.range(2).select("id", F.lit(1 << 40).alias("n"), F.lit(0.5).alias("sure"))
    publish(spark, table, new, 2, "b", schema=WIDE)
    found = spark.table(table[0])
    assert found.schema["n"].dataType == T.LongType()
    expected = {("a", 1, None): 3, ("b", 1 << 40, 0.5): 2}
    for df in (found, as_published(spark, WIDE, table[1])):
        assert {(r.load, r.n, r.sure): r["count"] for r in df.groupBy("load", "n", "sure").count().collect()} == expected
    assert files == sorted(r[0] for r in found.filter("load = 'a'").select(F.input_file_name()).distinct().collect())
    assert {tuple(r) for r in found.agg(F.sum("n"), F.count("sure")).collect()} == {(3 + (2 << 40), 2)}


@pytest.mark.parametrize(
    "schema",
    [
        T.StructType([SCHEMA["id"], SCHEMA["at"], SCHEMA["load"]]),
        T.StructType([T.StructField("id", T.IntegerType()), SCHEMA["n"], SCHEMA["at"], SCHEMA["load"]]),
        T.StructType([SCHEMA["id"], T.StructField("n", T.StringType()), SCHEMA["at"], SCHEMA["load"]]),
        T.StructType([SCHEMA["id"], SCHEMA["n"], SCHEMA["at"], SCHEMA["load"], T.StructField("more", T.StringType())]),
        T.StructType([SCHEMA["id"], SCHEMA["n"], T.StructField("at", T.StringType()), SCHEMA["load"]]),
    ],
)
def test_what_would_lose_values_is_refused(spark, table, schema):
    publish(spark, table, 3, 1)
    with pytest.raises(SchemaMismatch):
        evolve(spark, table[0], schema, table[1], BY)
    assert state(spark.table(table[0])) == {("a", 1): 3}
