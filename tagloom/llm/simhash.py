"""Near-duplicate groups by SimHash, with pigeonhole blocks.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``d`` bits, cut into
``blocks`` blocks, agree in at least ``blocks - d`` whole blocks; each choice of that many
blocks is a join key, and what shares a key is verified by its Hamming distance.

Equal fingerprints are one node, so exact copies never meet each other. A key that many
different fingerprints share is not paired: these fingerprints are dealt to the values that
differ from them in at most one bit. Two that meet there differ in at most two bits, and two
that differ in at most two bits meet somewhere; a value has at most 65 visitors. So the work
per fingerprint is bounded, and no link is lost.

A null or empty text has no shingle and fingerprint zero, which links like any other.
Repeated rows each get a row. Other columns are not looked at; no rows give no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.frames import keep_one, row_key, staged, text_of

SEED = 42
BITS = 64
#: Fingerprints under one key that are compared in pairs; with more, see above.
PAIRED = 64
#: Hashes whose bits are counted at once, so that a very long text needs little memory.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of one text over shingles of lower-cased words, as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) and ``key`` of each row."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), fp(text_of(text)).alias("fp"), row_key(text).alias("key"))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def block_masks(distance: int, blocks: int) -> list[int]:
    """A mask for each choice of ``blocks - distance`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(parts, blocks - distance)]


def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, distance: int = 2, blocks: int = 5, paired: int = PAIRED, rows: int | None = None) -> DataFrame:
    """``u, v``: fingerprints of ``fps`` (distinct ``fp``, ``rows`` of them if known) such that all within ``distance`` bits are connected.

    Pairs from ordinary keys are all there; fingerprints that meet at a value are each linked
    to the smallest one there, from which each is at most ``distance`` bits away.
    """
    if distance not in (0, 1, 2):
        raise ValueError("the distance is at most two bits")
    if not distance:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("false")
    masks = block_masks(distance, blocks)
    rows = rows if rows is None else rows * len(masks)
    keyed = staged(
        fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])).alias("k"))
        .select("fp", "k.choice", "k.bits"),
        "blocks", rows,
    )
    sizes = staged(keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "block-sizes", rows)
    shared = staged(keyed.join(sizes, ["choice", "bits"]), "shared-blocks", rows)
    ordinary = shared.filter(F.col("n") <= paired)
    left, right = (ordinary.select("choice", "bits", F.col("fp").alias(side)) for side in ("u", "v"))
    pairs = left.join(right, ["choice", "bits"]).filter((F.col("u") < F.col("v")) & (_apart("u", "v") <= distance)).select("u", "v")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
    met = (
        shared.filter(F.col("n") > paired).select("fp").distinct()
        .select("fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
        .agg(F.collect_set("fp").alias("visitors"))
        .filter(F.size("visitors") > 1)
    )
    hub = F.array_min("visitors") if distance == 2 else F.col("at")
    met = met.select(F.explode("visitors").alias("u"), hub.alias("v"), "visitors").filter(F.array_contains("visitors", F.col("v")))
    return pairs.unionByName(met.select("u", "v").filter("u <> v")).distinct()


def group(prints: DataFrame, distance: int = 2, blocks: int = 5, paired: int = PAIRED) -> DataFrame:
    """Each stored row of ``fingerprints`` with ``component_id``, the smallest id that its links reach."""
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps", prints.count())
    rows = fps.count()
    roots = components(links(fps, distance, blocks, paired, rows), rows)
    rooted = staged(
        fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted", rows
    )
    named = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r"), "named", rows)
    placed = staged(rooted.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "root", "component_id"), "placed", rows)
    return prints.join(placed, F.col("fp") == F.col("f")).drop("f")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, blocks: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id``, and ``fp, root, key``, one row per row of ``docs``."""
    prints = staged(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    return group(prints, distance, blocks).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "root", "key"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, blocks: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each group, with all columns of ``docs``."""
    found = staged(near_duplicates(docs, shingle, distance, blocks, doc_id, text), "near")
    return keep_one(docs, found.select("doc_id", "key", F.col("root").alias("group")), largest=False, doc_id=doc_id, text=text)
