from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.conform import SchemaMismatch, conform, conversion_losses, enforce_schema, merge_versions
from tagloom.operators.profile import describe, distinct_counts, null_counts
from tagloom.schemas import LABELED_QUESTIONS, POSTS, USERS, USERS_DIM

TARGET = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("d", T.DateType()),
        T.StructField("f", T.FloatType()),
        T.StructField("absent", T.StringType()),
    ]
)


def test_conform_converts_cuts_and_counts(spark):
    raw = spark.createDataFrame(
        [("12", "2010-01-02", "1.5"), ("12.9", "2010-13-02", "x"), ("99999999999", None, None), (None, "", "2")],
        "i string, d string, f string",
    )
    rows = conform(raw, TARGET).collect()
    assert [tuple(row) for row in rows] == [
        (12, datetime.date(2010, 1, 2), 1.5, None, 0),
        (12, None, None, None, 2),
        (None, None, None, None, 1),
        (None, None, 2.0, None, 1),
    ]
    losses = {row.column_name: (row.values_given, row.values_lost) for row in conversion_losses(raw, TARGET).collect()}
    assert losses == {"i": (3, 1), "d": (3, 2), "f": (3, 1)}


def test_conform_cuts_numbers_and_moments(spark):
    raw = spark.range(1).select(
        F.lit(-3.7).alias("i"), F.lit("2020-02-03 04:05:06").cast("timestamp").alias("d"), F.lit(1).alias("f")
    )
    assert tuple(conform(raw, TARGET, lost=None).first()) == (-3, datetime.date(2020, 2, 3), 1.0, None)


def test_conform_matches_names_without_case(spark):
    assert conform(spark.range(1).select(F.lit("5").alias("I")), TARGET).first().i == 5


def test_enforce_schema_is_strict(spark):
    good = conform(spark.range(1).select(F.lit("1").alias("i")), TARGET, lost=None)
    assert enforce_schema(good.select("f", "absent", "d", "i"), TARGET).columns == ["i", "d", "f", "absent"]
    for bad in (
        good.drop("f"),
        good.withColumn("extra", F.lit(1)),
        good.withColumn("i", F.col("i").cast("long")),
        good.select("*", F.lit(1).alias("i")),
    ):
        with pytest.raises(SchemaMismatch):
            enforce_schema(bad, TARGET)


def test_merge_versions_fills_with_null(spark):
    merged = merge_versions(spark.range(1).select("id"), spark.range(1).select("id", F.lit("n").alias("new")))
    assert sorted(map(str, (tuple(row) for row in merged.collect()))) == ["(0, 'n')", "(0, None)"]


def test_stored_tables_have_the_agreed_width():
    assert [len(schema) for schema in (POSTS, USERS, LABELED_QUESTIONS, USERS_DIM)] == [17, 12, 20, 12]
    assert all(field.nullable for schema in (POSTS, USERS, LABELED_QUESTIONS, USERS_DIM) for field in schema)


def test_profiles(spark):
    rows = spark.createDataFrame(
        [(1, "a", ["x"]), (2, None, None), (4, "10", ["y"])], "n int, s string, tags array<string>"
    )
    assert {r.column_name: (r.rows, r.nulls) for r in null_counts(rows).collect()} == {
        "n": (3, 0),
        "s": (3, 1),
        "tags": (3, 1),
    }
    described = {r.column_name: r for r in describe(rows).collect()}
    assert set(described) == {"n", "s"}
    assert (described["n"].n, described["n"].min, described["n"].max) == (3, "1", "4")
    assert described["n"]["mean"] == pytest.approx(7 / 3)
    assert described["n"].stddev == pytest.approx(1.5275252)
    assert (described["s"].n, described["s"]["mean"], described["s"].min, described["s"].max) == (2, 10.0, "10", "a")
    assert tuple(distinct_counts(rows, ["n", "s"]).first()) == (3, 3, 2)
    assert tuple(distinct_counts(rows, ["n", "s"], approximate=True).first()) == (3, 3, 2)


def test_describe_agrees_with_the_built_in(spark, small):
    rows = spark.read.parquet(f"{small}/customer.parquet").select("c_custkey", "c_acctbal", "c_name")
    built_in = {r.summary: r for r in rows.describe().collect()}
    for row in describe(rows).collect():
        assert str(row.n) == built_in["count"][row.column_name]
        assert row.min == built_in["min"][row.column_name]
        if row["mean"] is not None:
            assert row["mean"] == pytest.approx(float(built_in["mean"][row.column_name]))
            assert row.stddev == pytest.approx(float(built_in["stddev"][row.column_name]))
