"""Posts, post types and users, derived from the tables of a data folder.

The SQL runs on Spark and, with the same text, in the checks. Spark reads the two
input frames by the names in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTS = """
SELECT CAST(d.doc_id AS INT) AS id,
       CAST(CASE WHEN d.doc_id % 3 = 0 THEN d.doc_id + 1 END AS INT) AS AcceptedAnswerId,
       CAST(d.doc_id % 5 AS INT) AS AnswerCount,
       CASE WHEN d.doc_id % 50 = 49 THEN NULL
            ELSE concat('<p>', d.text, '</p> <a href="http://example.com/', CAST(d.doc_id AS STRING), '">link text</a> tail') END AS Body,
       CAST(d.doc_id % 7 AS INT) AS CommentCount,
       DATE '2023-10-01' + CAST(floor(d.doc_id / 20) % 28 AS INT) AS CreationDate,
       CAST(CASE WHEN d.doc_id % 4 = 0 THEN d.doc_id % 9 END AS INT) AS FavoriteCount,
       CASE WHEN d.doc_id % 2 = 0 THEN DATE '2023-11-01' + CAST(d.doc_id % 28 AS INT) END AS LastEditDate,
       CAST(NULL AS STRING) AS LastEditorDisplayName,
       CAST(CASE WHEN d.doc_id % 2 = 0 THEN d.doc_id % 150 END AS INT) AS LastEditorUserId,
       CAST(d.doc_id % 150 AS INT) AS OwnerUserId,
       CAST(NULL AS INT) AS ParentId,
       CASE l.quality WHEN 1 THEN 1 WHEN 0 THEN 2 END AS PostTypeId,
       CAST(d.doc_id % 11 - 2 AS FLOAT) AS Score,
       CASE WHEN d.doc_id % 40 = 39 THEN NULL ELSE concat('<', d.lang, '><', d.source, '>') END AS Tags,
       concat('Post ', CAST(d.doc_id AS STRING)) AS Title,
       CAST(d.n_chars AS INT) AS ViewCount
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

POST_TYPES = """
SELECT CAST(Id AS INT) AS Id, Type
FROM (VALUES (1, 'Question'), (2, 'Answer'), (3, 'Wiki')) AS v(Id, Type)
"""

USERS = """
SELECT CAST(c.c_custkey AS INT) AS id, CAST(NULL AS INT) AS Age,
       DATE '2009-01-01' + CAST(c.c_custkey % 1500 AS INT) AS CreationDate,
       CASE c.c_custkey % 9 WHEN 0 THEN concat('  ', c.c_name) WHEN 1 THEN concat(c.c_name, ' ') WHEN 2 THEN ''
            WHEN 3 THEN NULL WHEN 4 THEN ' ' WHEN 5 THEN 'null' ELSE c.c_name END AS DisplayName, CAST(c.c_custkey % 13 AS INT) AS DownVotes,
       CAST(NULL AS STRING) AS EmailHash, n.n_name AS Location,
       CAST(floor(c.c_acctbal) AS INT) AS Reputation, CAST(c.c_custkey % 17 AS INT) AS UpVotes,
       CAST(c.c_custkey % 101 AS INT) AS Views, CAST(NULL AS STRING) AS WebsiteUrl,
       CAST(c.c_custkey + 1000 AS INT) AS AccountId
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Web pages with a link in front of their HTML.
PAGES = """
SELECT CAST(page_id AS INT) AS question_id,
       concat('<a href="', url, '">', url, ' x</a> ', html) AS Body
FROM {pages}
"""


# Declared, so that no job has to read file footers before a query starts.
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _view(spark: SparkSession, folder: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, folder, name) for name in names})


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, POSTS, "documents", "labels")


def post_types(spark: SparkSession) -> DataFrame:
    return spark.sql(POST_TYPES)


def users(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, USERS, "customer", "nation")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, PAGES, "pages")
