"""The named queries of this folder over a data folder, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import collocations, decontaminate, divergence, exact_dedup, jaccard, oracles, pii, sentence_piece, simhash, suffix_dedup, token_counts, token_shards, toxicity, url_filters
from tagloom.llm.frames import documents, ship
from tagloom.session import scratch

Query = Callable[[SparkSession, str], DataFrame]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return sentence_piece.round_trip(documents(spark, sf_dir), PIECES)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every text, learned from the labels that are not held out."""
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.learn(docs, documents(spark, sf_dir, "labels")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for every document, by a digest index."""
    return exact_dedup.deduplicate(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark item that it holds."""
    found = decontaminate.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "matched", "share", "changed")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit."""
    return token_counts.curve(token_counts.histogram(documents(spark, sf_dir), BYTES))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it stands in the shard files."""
    files = token_shards.write_shards(documents(spark, sf_dir), scratch(spark, "token-shards"), BYTES)
    return token_shards.read_shards(files)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that stands in more than one document."""
    return suffix_dedup.find_repeats(documents(spark, sf_dir))


def dated_list(pages: DataFrame) -> DataFrame:
    """A block list and an allow list with a history, made from the hosts of the pages.

    A host's number, from a digest of its name, says on which days it or its domain was
    listed and taken off again. The tables have no list and no dates of their own.
    """
    hosts = pages.select(url_filters.host(F.col("url")).alias("host")).filter("host <> ''").distinct()
    h = F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int")
    day = F.to_date(F.lit("2024-01-01"))

    def entry(name: str, pattern, action: str, after) -> Column:
        return F.struct(F.lit(name).alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), F.date_add(day, after).alias("date"))

    domain = F.regexp_replace("host", r"^[^.]+\.", "")
    rows = F.concat(
        F.when(h % 4 == 0, F.array(entry("block", F.col("host"), "add", h % 400), entry("block", F.col("host"), "remove", h % 400 + 30 + h % 200))).otherwise(F.array()),
        F.when(h % 8 == 0, F.array(entry("block", F.col("host"), "add", h % 400 + 300))).otherwise(F.array()),
        F.when((h % 5 == 0) & domain.like("%.%.%"), F.array(entry("block", domain, "add", h % 600))).otherwise(F.array()),
        F.when(h % 6 == 0, F.array(entry("allow", F.concat("host", F.lit("/en")), "add", h % 300))).otherwise(F.array()),
    )
    return hosts.select(F.inline(rows))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active on the day of its capture."""
    pages = documents(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("page_id") % 731).cast("int")).alias("fetched"))
    found = url_filters.judge(captures, url_filters.intervals(dated_list(pages)))
    dates = {c: F.col(c).cast("string") for c in ("fetched", "listed_since")}
    return found.withColumnRenamed("capture_id", "page_id").withColumns(dates)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.summary(pii.find(documents(spark, sf_dir)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    return jaccard.similar_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart, and the terms in which each stands out."""
    return divergence.audit(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words keep company."""
    return collocations.collocations(documents(spark, sf_dir), stored=True)


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {
        f.__name__: _shipped(f)
        for f in (op1_sentencepiece, op2_toxicity, op3_exact_dedup, op4_decontaminate, op5_token_counts, op6_token_shards, op7_suffix_dedup, op8_url_filters, op9_pii, op10_simhash, op11_jaccard, op12_divergence, op13_collocations)
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
        "op8_url_filters": r"""
            WITH captures AS (
                SELECT page_id, DATE '2024-01-01' + (page_id % 731)::INT AS fetched,
                       regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.|\.$', '', 'g') AS host,
                       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
                FROM pages
            ), hosts AS (
                SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 4))::INT AS h, regexp_replace(host, '^[^.]+\.', '') AS domain
                FROM captures WHERE host <> ''
            ), entries AS (
                SELECT 'block' AS list, host AS pattern, 'add' AS action, DATE '2024-01-01' + h % 400 AS date FROM hosts WHERE h % 4 = 0
                UNION SELECT 'block', host, 'remove', DATE '2024-01-01' + (h % 400 + 30 + h % 200) FROM hosts WHERE h % 4 = 0
                UNION SELECT 'block', host, 'add', DATE '2024-01-01' + (h % 400 + 300) FROM hosts WHERE h % 8 = 0
                UNION SELECT 'block', domain, 'add', DATE '2024-01-01' + h % 600 FROM hosts WHERE h % 5 = 0 AND domain LIKE '%.%.%'
                UNION SELECT 'allow', host || '/en', 'add', DATE '2024-01-01' + h % 300 FROM hosts WHERE h % 6 = 0
            ), daily AS (
                SELECT list, pattern, date, max(action) AS action FROM entries GROUP BY ALL
            ), changes AS (
                SELECT * FROM daily QUALIFY action IS DISTINCT FROM lag(action) OVER (PARTITION BY list, pattern ORDER BY date)
            ), valid AS (
                SELECT *, lead(date) OVER (PARTITION BY list, pattern ORDER BY date) AS until FROM changes
            ), best AS (
                SELECT c.page_id, v.list, v.pattern, v.date AS listed_since
                FROM captures c JOIN valid v ON v.action = 'add' AND v.date <= c.fetched AND c.fetched < coalesce(v.until, DATE '9999-12-31')
                 AND (c.host = v.pattern OR ends_with(c.host, '.' || v.pattern) OR starts_with(c.host || c.path || '/', v.pattern || '/'))
                QUALIFY row_number() OVER (PARTITION BY c.page_id ORDER BY length(v.pattern) DESC, v.list, v.pattern) = 1
            )
            SELECT c.page_id, c.host, c.fetched::VARCHAR AS fetched, coalesce(b.list <> 'allow', false) AS blocked, coalesce(b.list = 'allow', false) AS allowed,
                   b.list, b.pattern, b.listed_since::VARCHAR AS listed_since
            FROM captures c LEFT JOIN best b USING (page_id)
        """,
        "op11_jaccard": oracles.JACCARD,
        "op12_divergence": oracles.DIVERGENCE,
        "op13_collocations": oracles.COLLOCATIONS,
    }
