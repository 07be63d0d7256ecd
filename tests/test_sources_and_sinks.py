from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan
from tagloom.operators.conform import SchemaMismatch
from tagloom.schemas import POST_TYPES, POSTS, USERS
from tagloom.sinks import (
    TableMismatch,
    checkpoint_parquet,
    compact_copy,
    create_database,
    create_external_table,
    full_refresh,
    overwrite_table,
    publish_batch,
    write_quoted_csv,
)
from tagloom.sources import (
    JdbcTable,
    folder_exists,
    folder_listing,
    read_csv,
    read_parquet,
    read_posts,
    read_table,
    source_manifest,
)
from tagloom.sources.files import KEEP_VALUES


def user(id, name="n", location="l"):
    return (id, None, datetime.date(2010, 1, 2), name, 1, None, location, 5, 2, 3, None, 9)


def test_csv_keeps_quotes_newlines_and_nulls(spark, tmp_path):
    rows = [user(1, 'A "q" b', "x,\ny"), user(2, "back\\slash", None), user(3, "ünï", "<p>")]
    path = str(tmp_path / "users")
    write_quoted_csv(spark.createDataFrame(rows, USERS), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, USERS, multi_line=True).collect()) == sorted(rows)
    assert read_csv(spark, path, USERS).count() > len(rows)


def test_csv_sink_quotes_every_value(spark, tmp_path):
    write_quoted_csv(spark.createDataFrame([(1, "Question"), (2, None)], POST_TYPES).coalesce(1), str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text().splitlines() == ['"Id","Type"', '"1","Question"', f'"2","{KEEP_VALUES["nullValue"]}"']


def test_csv_values_of_a_wrong_type_are_null(spark, tmp_path):
    (tmp_path / "u.csv").write_text(",".join(USERS.fieldNames()) + "\nx,,2010-13-02,n,1,,l,5,2,3,,9\n")
    row = read_csv(spark, str(tmp_path / "u.csv"), USERS).first()
    assert (row.id, row.CreationDate, row.DisplayName, row.AccountId) == (None, None, "n", 9)


def test_posts_are_found_at_any_depth(spark, tmp_path):
    post = spark.range(2).select(F.col("id").cast("int").alias("id"))
    post.write.parquet(str(tmp_path / "a" / "day=1"))
    post.write.parquet(str(tmp_path / "b"))
    (tmp_path / "notes.txt").write_text("no parquet")
    found = read_posts(spark, str(tmp_path))
    assert found.schema == POSTS and found.count() == 4


def test_manifest_and_listing(spark, tmp_path):
    for name, size in (("x/a.parquet", 3), ("x/b.parquet", 4), ("y/c.txt", 5)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"0" * size)
    manifest = source_manifest(spark, str(tmp_path))
    assert {(r.item_name, r.item_type, r.size_bytes) for r in manifest.collect()} == {
        ("a.parquet", "File", 3),
        ("b.parquet", "File", 4),
        ("c.txt", "File", 5),
    }
    assert "content" not in plan(manifest)
    listing = {r.folder.rsplit("/", 1)[1]: (r.child_items, r.size_bytes) for r in folder_listing(manifest).collect()}
    assert listing == {"x": (2, 7), "y": (1, 5)}
    assert source_manifest(spark, str(tmp_path), "*.parquet").count() == 2


def test_folder_exists(spark, tmp_path):
    assert folder_exists(spark, str(tmp_path))
    assert not folder_exists(spark, str(tmp_path / "none"))


def test_database_options():
    table = JdbcTable("jdbc:postgresql://host/db", "raw.users", key="id", partitions=8, login={"user": "u"})
    assert table.bounds_options()["query"] == "SELECT min(id) AS low, max(id) AS high FROM raw.users"
    split = table.scan_options(1, 90)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id",
        "1",
        "90",
        "8",
    )
    assert "partitionColumn" not in table.scan_options(None, None)
    assert "user" not in repr(table).replace("raw.users", "")


def test_tables_of_another_format_are_read_alike(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    source = JdbcTable(url="", table="", login={"path": str(tmp_path / "t")})
    assert read_table(spark, source, format="parquet").count() == 5


def test_checkpoint_modes(spark, tmp_path):
    path = str(tmp_path / "c")
    assert checkpoint_parquet(spark.range(3), path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        checkpoint_parquet(spark.range(3), path)
    assert checkpoint_parquet(spark.range(4), path, mode="overwrite").count() == 4


def test_compact_copy_follows_the_size(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(10_000).repartition(12).write.parquet(source)
    size = source_manifest(spark, source, "*.parquet").agg(F.sum("size_bytes")).first()[0]
    assert compact_copy(spark.read.parquet(source), source, target) == 1
    assert compact_copy(spark.read.parquet(source), source, target, file_bytes=size // 3) in (3, 4)
    assert spark.read.parquet(target).agg(F.count("*"), F.sum("id")).first()[:] == (10_000, 49_995_000)


def test_full_refresh_may_read_its_target(spark, tmp_path):
    target = str(tmp_path / "dim")
    full_refresh(spark.range(3), target)
    full_refresh(spark.read.parquet(target).select(F.col("id") + 10), target)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [10, 11, 12]


def test_a_failed_refresh_leaves_the_target(spark, tmp_path):
    target = str(tmp_path / "dim")
    full_refresh(spark.range(3), target)
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        full_refresh(broken, target)
    assert spark.read.parquet(target).count() == 3


def test_merged_schemas(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "v=1"))
    spark.range(1).select("id", F.lit("n").alias("new")).write.parquet(str(tmp_path / "v=2"))
    rows = read_parquet(spark, str(tmp_path), merge_schema=True).select("v", "id", "new").orderBy("v").collect()
    assert [tuple(r) for r in rows] == [(1, 0, None), (2, 0, "n")]


# --- tables ------------------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    create_database(spark, name, str(tmp_path / "db"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType())])
    create_external_table(spark, f"{name}.t", schema, str(tmp_path / "t"), partition_by="at")
    return f"{name}.t", schema, str(tmp_path / "t")


def counts(spark, name):
    return {str(r["at"]): r["count"] for r in spark.table(name).groupBy("at").count().collect()}


FIRST, SECOND = "2023-10-22 02:00:00", "2023-10-23 02:00:00"


def test_batches_accumulate_and_repeat_without_doubling(spark, table):
    name, schema, location = table
    for rows, batch in ((3, FIRST), (4, SECOND), (3, FIRST)):
        publish_batch(spark.range(rows), name, schema, location, "at", batch)
    assert counts(spark, name) == {FIRST: 3, SECOND: 4}
    publish_batch(spark.range(2), name, schema, location, "at", FIRST)
    assert counts(spark, name) == {FIRST: 2, SECOND: 4}
    early = spark.table(name).filter(F.col("at") <= FIRST)
    assert early.count() == 2 and "PartitionFilters: [isnotnull(at" in plan(early)


def test_a_failed_batch_leaves_the_table(spark, table):
    name, schema, location = table
    publish_batch(spark.range(3), name, schema, location, "at", FIRST)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        publish_batch(broken, name, schema, location, "at", FIRST)
    spark.catalog.refreshTable(name)
    assert counts(spark, name) == {FIRST: 3}


def test_a_batch_of_another_schema_is_refused(spark, table):
    name, schema, location = table
    with pytest.raises(SchemaMismatch):
        publish_batch(spark.range(3).select(F.col("id").cast("int")), name, schema, location, "at", FIRST)
    assert counts(spark, name) == {}


def test_an_empty_batch_leaves_no_partition(spark, table):
    name, schema, location = table
    publish_batch(spark.range(3), name, schema, location, "at", FIRST)
    for batch in (FIRST, SECOND):
        publish_batch(spark.range(3).filter("false"), name, schema, location, "at", batch)
    assert counts(spark, name) == {} and spark.sql(f"SHOW PARTITIONS {name}").count() == 0
    assert spark.read.schema(schema).parquet(location).count() == 0


def test_a_table_elsewhere_is_refused(spark, tmp_path, table):
    name, schema, location = table
    create_external_table(spark, name, schema, f"file:{location}/", partition_by="at")
    for other in ({"location": str(tmp_path / "elsewhere")}, {"schema": T.StructType([*schema, T.StructField("more", T.StringType())])}, {"format": "csv"}):
        with pytest.raises(TableMismatch):
            create_external_table(spark, name, **{"schema": table[1], "location": location, **other})


def test_csv_keeps_values_as_they_are(spark, tmp_path):
    values = ["  lead ", "tab\t", "", None, "null", " ", 'a "quoted" \\ one', "two\nlines"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    write_quoted_csv(rows, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), rows.schema, multi_line=True)
    assert dict(back.collect()) == dict(enumerate(values))


def test_a_new_table_sees_the_files_of_its_folder(spark, table):
    name, schema, location = table
    publish_batch(spark.range(3), name, schema, location, "at", FIRST)
    create_external_table(spark, f"{name}_again", schema, location, partition_by="at")
    assert counts(spark, f"{name}_again") == {FIRST: 3}


def test_overwritten_tables_hold_the_last_rows(spark, tmp_path, table):
    name, location = f"{table[0]}_dim", str(tmp_path / "dim")
    schema = T.StructType([T.StructField("id", T.LongType())])
    create_external_table(spark, name, schema, location)
    for rows in (5, 2):
        overwrite_table(spark.range(rows), name, schema, location)
    assert spark.table(name).count() == 2 and spark.read.parquet(location).count() == 2
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(broken, name, schema, location)
    assert spark.table(name).count() == 2
