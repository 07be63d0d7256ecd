"""Similarity join of documents by the Jaccard index of their word shingles, with a token-group matrix.

Documents of equal sets are one class. Classes are put into groups of similar ones: sorted by the smallest hashes of
their sets and cut where these change, or where a group is full. The matrix holds, for each token, the groups
whose members have it. A class, as a query, meets the groups in the rows of its tokens; the number of rows it
shares with a group bounds what it can have in common with any member. Only groups that qualify are opened:
the union of a group's tokens, each with a bit per member, bounds the overlap once more and then gives it exactly.

What keeps this linear:

* Tokens are put in an order, rare ones first. Of two linked classes the larger has among its first
  ``n - least*n + c`` tokens, and the smaller among its first ``n - 2*least*n/(1+least) + c``, at least ``c`` in common, the
  smaller ``c`` of both, so queries and matrix hold only these. A class whose tokens there occur nowhere else is done after
  one shuffle, and its full set is never stored.
* Tokens of more than ``CROWD`` classes come last, by frequency, and ``c`` is as large as rare tokens allow. Only classes made of
  crowded tokens look them up. The list of these is bounded; beyond the bound a token counts as rare, which costs time and changes no result.
* A query opens its own group and the one that it shares most with; of the others only those that then hold another
  component. An opened group hands on one link for a query and joins its members, never all pairs.

Sets hold 64-bit hashes of shingles, and classes are told apart by 128 bits. A text of fewer words than a shingle
is one shingle; one without words, or null, has an empty set and no link. Repeated rows each get a row;
null ids are kept and never name a component that has another id. No rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.frames import row_key, small, staged, text_of

SHINGLE = 4
#: Hundredths of the union that two linked sets have in common.
LEAST = 85
#: Each this many tokens of a set, one more must be shared before a group is opened.
SHARED_EACH = 25
#: Classes up to which a token is rare, and how many tokens are known not to be (12 bytes each).
CROWD, MOST_CROWDED = 8, 500_000
#: Members of a group, one bit each, and the tokens after which it is full.
MEMBERS, GROUP_TOKENS = 64, 1 << 16
#: Queries that one task puts to a group.
QUERIES = 4096
#: Words whose hashes a worker remembers.
REMEMBERED = 200_000

MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: str, size: int, hashes: dict) -> np.ndarray:
    """The hashes of a text's different shingles, ascending."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    h = each[: len(each) - width + 1] + np.uint64(width)
    for k in range(1, width):
        h = (h * MIX) ^ each[k : len(each) - width + 1 + k]
        h ^= h >> np.uint64(29)
        h *= SPREAD
    return np.unique(h ^ (h >> np.uint64(32)))


def _common(n, least: int):
    """How many tokens of ``n`` a set of its size or less must share with it to be linked, at least."""
    return -(-least * n // 100)


def most_shared(n):
    """How many common tokens are asked for at most, of a set of ``n`` and one like it."""
    return 1 + n // SHARED_EACH


def query_length(n, least: int, shared):
    """The first tokens with which a set of ``n`` looks for sets of its size or less that have ``shared`` of them."""
    return n - _common(n, least) + shared


def matrix_length(n, least: int, shared):
    """The first tokens by which a set of ``n`` is found by sets of its size or more."""
    return n - -(-2 * least * n // (100 + least)) + shared


def _list(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def prints(docs: DataFrame, shingle: int, least: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, key, n, digest, tokens`` of each row: the size of its set, 128 bits of it, and the first tokens by hash."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, shingle, hashes) for t in part.column("text").to_pylist()]
                sizes = np.array([len(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(sizes), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), _list([s[: query_length(len(s), least, most_shared(len(s)))] for s in sets])],
                    names=["doc_id", "key", "n", "digest", "tokens"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(text).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(make, f"doc_id {kind}, key long, n long, digest binary, tokens array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, n_wanted: int, shingle: int, doc_id: str, text: str) -> DataFrame:
    """``cls, n, tokens`` of the classes ``cls, rep`` (a document's id and key), similar ones side by side; repeated rows give repeated sets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, shingle, hashes) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array([len(s) for s in sets], pa.int64()), _list(sets)], names=["cls", "n", "tokens"])

    reps = wanted.select("cls", F.col("rep.doc_id").alias("rep_id"), F.col("rep.key").alias("rep_key"))
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(text).alias("key"), text_of(text).alias("text"))
    sets = rows.join(small(reps, n_wanted), same).select("cls", "text").mapInArrow(make, "cls long, n long, tokens array<long>")
    # By unsigned value, as the hashes are sorted: flipping the sign bit keeps that order in a long.
    hashed = sets.select("*", *[F.get("tokens", F.lit(i)).bitwiseXOR(F.lit(-(1 << 63))).alias(f"s{i}") for i in range(2)])
    return hashed.repartitionByRange("s0", "s1", "n", "cls").sortWithinPartitions("s0", "s1", "n", "cls").drop("s0", "s1")


GROUPED = "grp long, cls long, n long, shared int, listed int, first array<long>"


def grouped(sets: DataFrame, crowded: tuple[np.ndarray, np.ndarray], least: int) -> DataFrame:
    """``grp, cls, n, shared, listed, first`` of sets that lie in order: the group, the first tokens, and how many of these the matrix has."""
    held = sets.sparkSession.sparkContext.broadcast(crowded)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = held.value
        grp, last, mark, members, size = TaskContext.get().partitionId() << 33, None, None, 0, 0
        for batch in batches:
            rows, firsts = [], []
            classes, sizes, sets = batch.column("cls").to_pylist(), batch.column("n").to_pylist(), batch.column("tokens")
            for i, (cls, n) in enumerate(zip(classes, sizes)):
                if cls == last:
                    continue
                last = cls
                tokens = sets[i].values.to_numpy().view(np.uint64)
                if members and (tokens[0] != mark or members == MEMBERS or size + n > GROUP_TOKENS):
                    grp, members, size = grp + 1, 0, 0
                mark, members, size = tokens[0], members + 1, size + n
                order = np.zeros(n, np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    order = np.where(known[place] == tokens, often[place], 0)
                rare = int((order == 0).sum())
                shared = max(1, min(most_shared(n), 1 + rare - query_length(n, least, 1)))
                rows.append((grp, cls, n, shared, matrix_length(n, least, shared)))
                firsts.append(tokens[np.argsort(order, kind="stable")[: query_length(n, least, shared)]])
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*rows), kinds)), _list(firsts)], names=["grp", "cls", "n", "shared", "listed", "first"])

    return sets.mapInArrow(make, GROUPED)


def qualifying(groups: DataFrame, least: int) -> DataFrame:
    """``cls, grp, rows, own``: the groups that a class may have a link into, by the rows of the matrix that they share."""
    n = F.col("n")
    entries = staged(groups.select("grp", "cls", "n", "shared", F.posexplode("first").alias("at", "token"), "listed").withColumn("listed", F.col("at") < F.col("listed")).drop("at"), "entries")
    matrix = staged(
        entries.filter("listed").groupBy("token", "grp").agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min("shared").alias("least_shared"), F.count(F.lit(1)).alias("members"))
        .select(F.col("token").alias("m_token"), F.col("grp").alias("m_grp"), "least_n", "most_n", "least_shared", "members"),
        "matrix",
    )
    common = F.ceil(F.lit(least) * n / 100)
    met = entries.join(matrix, F.col("token") == F.col("m_token")).filter((F.col("least_n") <= n) & (F.col("most_n") >= common) & ~((F.col("grp") == F.col("m_grp")) & F.col("listed") & (F.col("members") == 1)))
    return (
        met.groupBy("cls", F.col("m_grp").alias("grp")).agg(F.count(F.lit(1)).alias("rows"), F.least(F.first("shared"), F.min("least_shared")).alias("needed"), F.first(F.col("grp") == F.col("m_grp")).alias("own"))
        .filter(F.col("rows") >= F.col("needed")).select("cls", "grp", "rows", "own")
    )


def opened(chosen: DataFrame, groups: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links ``u, v`` that connect each query of ``cls, grp`` with the members of the group that it is linked to."""

    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, union = None, [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("grp", "salt", "query", "cls", "n")]
            sets = batch.column("tokens")
            for i, (grp, salt, query, cls, n) in enumerate(zip(*columns)):
                tokens = sets[i].values.to_numpy().view(np.uint64)
                if (grp, salt) != at:
                    at, members, union = (grp, salt), [], None
                if not query:
                    members.append((cls, n, tokens.copy()))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([m[2] for m in members]))
                    bits = np.zeros(len(union), np.uint64)
                    for k, (_, _, own) in enumerate(members):
                        bits[np.searchsorted(union, own)] |= np.uint64(1 << k)
                    ids, sizes = np.array([m[0] for m in members]), np.array([m[1] for m in members])
                    root = np.arange(len(members))
                place = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
                held = bits[place[union[place] == tokens]]
                if 100 * len(held) < least * n:
                    continue
                common = np.unpackbits(held.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)[: len(ids)]
                linked = np.flatnonzero((100 * common >= least * (n + sizes - common)) & (ids != cls))
                if not len(linked):
                    continue
                # One link for the query; members that it joins are linked once.
                out.append((cls, int(ids[linked[0]])))
                for k in linked[root[linked] != root[linked[0]]].tolist():
                    if root[k] != root[linked[0]]:
                        out.append((int(ids[linked[0]]), int(ids[k])))
                        root[root == root[k]] = root[linked[0]]
            if out:
                u, v = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    salts = staged(chosen.groupBy(F.col("grp").alias("c_grp")).agg((1 + F.expr(f"count(*) div {QUERIES}")).alias("salts")), "opened-groups")
    n_salts = salts.count()
    in_group = F.col("grp") == F.col("c_grp")
    holders = groups.select("grp", F.col("cls").alias("w_cls")).join(small(salts, n_salts), in_group).select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("query"), "w_cls")
    asking = chosen.join(small(salts, n_salts), in_group).select("grp", F.pmod(F.xxhash64("cls"), "salts").alias("salt"), F.lit(True).alias("query"), F.col("cls").alias("w_cls"))
    wanted = staged(holders.unionByName(asking), "wanted-sets")
    rows = sets.join(small(wanted, wanted.count()), F.col("cls") == F.col("w_cls")).select("grp", "salt", "query", "cls", "n", "tokens")
    return rows.repartition("grp", "salt").sortWithinPartitions("grp", "salt", "query").mapInArrow(open_groups, "u long, v long")


def class_links(docs: DataFrame, rows: DataFrame, classes: DataFrame, shingle: int, least: int, doc_id: str, text: str) -> DataFrame:
    """``node, root`` of the classes (``cls, digest, rep, n``) that are linked; ``rows`` are the prints."""
    known = classes.select("cls", F.col("digest").alias("c_digest"), "rep")
    first = (F.col("digest") == F.col("c_digest")) & F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("key") == F.col("rep.key"))
    entries = rows.join(small(known, classes.count()), first).select("cls", F.explode("tokens").alias("token"))
    met = staged(entries.withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("seen > 1").select("cls"), "met-tokens")
    met = met.groupBy(F.col("cls").alias("m_cls")).agg(F.count(F.lit(1)).alias("met"))
    # A linked set of no more tokens asks for as many in common as its own size gives.
    needed = F.expr(f"1 + cast(ceil({least} * n / 100.0) as long) div {SHARED_EACH}")
    chosen = staged(classes.select("cls", "rep", "n").join(met, F.col("cls") == F.col("m_cls")).filter(F.col("met") >= needed).select("cls", "rep"), "open-classes")
    n_chosen = chosen.count()
    sets = staged(full_sets(docs, chosen, n_chosen, shingle, doc_id, text), "full-sets")
    often = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD)
    listed = often.orderBy(F.desc("n"), "token").limit(MOST_CROWDED).toPandas()
    crowded = listed["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(crowded)
    groups = staged(grouped(sets, (crowded[order], listed["n"].to_numpy(np.int64)[order]), least), "groups")
    met_groups = staged(qualifying(groups, least), "qualifying")
    best = met_groups.filter("not own").groupBy(F.col("cls").alias("b_cls")).agg(F.max_by("grp", F.struct("rows", "grp")).alias("b_grp"))
    met_groups = staged(
        met_groups.join(best, F.col("cls") == F.col("b_cls"), "left").select("cls", "grp", (F.col("own") | F.col("grp").eqNullSafe(F.col("b_grp"))).alias("now")), "queries"
    )
    first_links = staged(opened(met_groups.filter("now"), groups, sets, least), "first-links")
    roots = staged(components(first_links, n_chosen), "first-components", n_chosen)
    place = staged(groups.select("grp", "cls").join(roots, F.col("cls") == F.col("node"), "left").select("grp", "cls", F.coalesce("root", "cls").alias("root")), "places", n_chosen)
    held = place.groupBy(F.col("grp").alias("h_grp")).agg(F.min("root").alias("one"), F.max("root").alias("other"))
    mine = place.select(F.col("cls").alias("p_cls"), "root")
    later = (
        met_groups.filter("not now").join(mine, F.col("cls") == F.col("p_cls")).join(held, F.col("grp") == F.col("h_grp"))
        .filter((F.col("one") != F.col("root")) | (F.col("other") != F.col("root"))).select("cls", "grp")
    )
    rest = staged(opened(staged(later, "later-queries"), groups, sets, least), "later-links")
    return components(first_links.unionByName(rest), n_chosen)


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` of each row; the component is named by the smallest id that links reach."""
    rows = staged(prints(docs, shingle, least, doc_id, text), "set-prints")
    classes = staged(
        rows.filter("n > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "key")).alias("rep"), F.min("doc_id").alias("least_id"), F.first("n").alias("n"))
        .select(F.monotonically_increasing_id().alias("cls"), "digest", "rep", "least_id", "n"),
        "classes",
    )
    roots = class_links(docs, rows, classes, shingle, least, doc_id, text)
    rooted = staged(classes.select("cls", "digest", "least_id").join(roots, F.col("cls") == F.col("node"), "left").select("digest", "least_id", F.coalesce("root", "cls").alias("root")), "rooted")
    named = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component_id"))
    placed = staged(rooted.join(named, F.col("root") == F.col("r")).select(F.col("digest").alias("d"), "component_id"), "placed")
    return rows.select("doc_id", "key", "n", "digest").join(placed, F.col("digest") == F.col("d"), "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
