"""How the sources of a language differ in their words.

Each language keeps the terms of at least ``least_docs`` of its documents. A group, that is a source in a language,
gives a kept term the smoothed share ``p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))``, where ``N`` is the
group's count over the ``V`` kept terms. Sources are compared over all kept terms, and each group names the
terms that it uses more than its language does.

The best terms of a group come from a dominance skyband. A term cannot be among the first ``k`` when ``k``
others have at least its count in the group, at most its count in the language and an earlier name: each
of them ranks before it. Every partition keeps only the terms with fewer than ``k`` such others, these skybands
are merged group by group as a stream, and what is left is ranked exactly. So a task holds skybands, not vocabularies.

Sources are compared in blocks of terms, as dense matrices of bounded size whose partial sums Spark adds up.
All arithmetic is on whole numbers. Nulls in text, lang or source read as ''. A language without kept
terms has its pairs of sources with value 0 and no terms. No rows give no rows. Other columns, and ids, are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.frames import small, staged

LEAST_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
#: Different terms that a task counts before it hands its counts on.
COUNTED = 1_000_000
#: What a document adds to the number of a term; below it are the occurrences, of which a task sees fewer before it hands on.
ONE_DOC = 1 << 36
#: Terms of a block, at most, and numbers of its matrix.
BLOCK_TERMS, BLOCK_NUMBERS = 2048, 1 << 20
#: Rows that a task adds to its skybands at once.
MERGED = 200_000
#: A to Z and whatever is not ASCII; A to Z become small letters.
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def term_counts(rows: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of ``lang, source, text``: occurrences and documents, several rows per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], dict[bytes, int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in groups.items():
                # A number holds the documents of a term above its occurrences.
                names, both = list(found), np.fromiter(found.values(), np.int64, len(found))
                for at in range(0, len(names), 50_000):
                    part, n = names[at : at + 50_000], both[at : at + 50_000]
                    same = lambda value: pa.array([value] * len(part), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [same(lang), same(source), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n & (ONE_DOC - 1)), pa.array(n >> ONE_DOC.bit_length() - 1)],
                        names=["lang", "source", "term", "n", "docs"],
                    )
            groups.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256).to_pydict()
                for lang, source, text in zip(piece["lang"], piece["source"], piece["text"]):
                    found = groups.setdefault((lang, source), {})
                    have = found.get
                    for term, n in Counter(terms(text)).items():
                        found[term] = have(term, 0) + n + ONE_DOC
                if sum(map(len, groups.values())) >= COUNTED:
                    yield from out()
        yield from out()

    return rows.mapInArrow(count, COUNTS)


def share(count: Column, total: Column, v: Column) -> Column:
    """The smoothed share of a term in ``SCALE`` parts, exactly."""
    # Decimals of 38 digits: counts stay exact beyond what SCALE times a long holds.
    above = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(18,0)")
    below = total.cast("decimal(38,0)") + F.lit(SMOOTH).cast("decimal(10,0)") * v.cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


def skyband(count: np.ndarray, overall: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Positions of the terms that fewer than ``k`` others dominate; ``name`` is the rank of their names."""
    order = np.lexsort((name, overall, -count))
    kept = np.empty(0, np.int64)
    for at in range(0, len(order), 512):
        # Whatever dominates a term stands before it, and k of those that do are themselves kept.
        part = order[at : at + 512]
        before = np.concatenate([kept, part])
        over = (overall[before][None, :] <= overall[part][:, None]) & (name[before][None, :] < name[part][:, None]) & (count[before][None, :] >= count[part][:, None])
        kept = np.concatenate([kept, part[over.sum(axis=1) < k]])
    return kept


SKYBAND = "lang string, source string, term string, n long, overall long, value long"


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The skyband of each group within each partition of ``lang, source, term, n, overall, value``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pd.DataFrame()
        waiting, size = [], 0

        def merged() -> pd.DataFrame:
            table = pd.concat([held, *waiting], ignore_index=True)
            if table.empty:
                return table
            table["name"] = pd.Series([t.encode() for t in table["term"]]).rank(method="min").astype("int64")
            parts = [g.iloc[np.sort(skyband(g["n"].to_numpy(), g["overall"].to_numpy(), g["name"].to_numpy(), k))] for _, g in table.groupby(["lang", "source"], sort=False)]
            return pd.concat(parts, ignore_index=True).drop(columns="name")

        for batch in batches:
            waiting.append(batch.to_pandas())
            size += batch.num_rows
            if size >= MERGED:
                held, waiting, size = merged(), [], 0
        held = merged()
        if len(held):
            yield pa.RecordBatch.from_pandas(held, preserve_index=False)

    return rows.mapInArrow(keep, SKYBAND)


def _block_sums(block: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences between each two sources of a block; rows without a term have a source's share of absent terms."""
    absent = block[block["term"].isna()].sort_values("source")
    present = block[block["term"].notna()]
    place = pd.Series(range(len(absent)), index=absent["source"])
    columns, names = pd.factorize(present["term"])
    shares = np.repeat(absent["p"].to_numpy(np.int64)[:, None], len(names), axis=1)
    shares[place[present["source"]].to_numpy(), columns] = present["p"].to_numpy(np.int64)
    sources, out = absent["source"].to_numpy(), []
    for i in range(len(sources) - 1):
        out.append(pd.DataFrame({"lang": absent["lang"].iloc[0], "source": sources[i], "item": sources[i + 1 :], "value": np.abs(shares[i + 1 :] - shares[i]).sum(axis=1)}))
    return pd.concat(out) if out else pd.DataFrame(columns=["lang", "source", "item", "value"])


def _pairs(groups: DataFrame, shares: DataFrame, blocks: int) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language, in both orders."""
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    absent = groups.filter("v > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), share(F.lit(0).cast("long"), F.col("total"), F.col("v")).alias("p"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    cells = shares.select("lang", "source", "term", "p", block.alias("block")).unionByName(absent)
    sums = (
        cells.groupBy("lang", "block").applyInPandas(_block_sums, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    # A language without kept terms has no block.
    bare = groups.filter("v = 0")
    other = bare.select(F.col("lang").alias("l"), F.col("source").alias("item"))
    zero = bare.join(other, (F.col("lang") == F.col("l")) & (F.col("source") < F.col("item"))).select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    sums = staged(sums.unionByName(zero), "source-pairs")
    return sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: the distance to each other source, and the terms that stand out."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = staged(term_counts(rows), "term-counts")
    kept = staged(
        counted.groupBy("lang", "term").agg(F.sum("n").alias("overall"), F.sum("docs").alias("in_docs")).filter(F.col("in_docs") >= least_docs)
        .select(F.col("lang").alias("k_lang"), F.col("term").alias("k_term"), "overall"),
        "kept-terms",
    )
    n_kept = kept.count()
    counts = staged(
        counted.join(small(kept, n_kept), (F.col("lang") == F.col("k_lang")) & (F.col("term") == F.col("k_term")))
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.first("overall").alias("overall")),
        "group-counts",
    )
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("k_lang").agg(F.count(F.lit(1)).alias("v"), F.sum("overall").alias("lang_total"))
    groups = staged(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, F.col("lang") == F.col("k_lang"), "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "lang_total")]),
        "groups", 0,
    )
    n_groups = groups.count()
    named = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "v", "lang_total")
    shares = counts.join(small(named, n_groups), (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))).select(
        "lang", "source", "term", "n", "overall", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("overall"), F.col("lang_total"), F.col("v")).alias("q")
    )
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    blocks = 1 + n_kept // max(1, min(BLOCK_TERMS, BLOCK_NUMBERS // sources))
    pairs = _pairs(groups, shares, blocks).withColumn("part", F.lit("pair"))
    above = shares.filter("p > q").select("lang", "source", "term", "n", "overall", (F.col("p") - F.col("q")).alias("value"))
    local = staged(skybands(above, top), "skybands")
    best = skybands(local.repartition("lang", "source"), top).select("lang", "source", F.col("term").alias("item"), "value", F.lit("term").alias("part"))
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    columns = ("lang", "source", "part", "item", "value", "rank")
    ranked = pairs.withColumn("rank", F.row_number().over(by_value)).select(*columns)
    return ranked.unionByName(best.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top).select(*columns))
