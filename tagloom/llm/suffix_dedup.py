"""Passages that repeat across documents, by a sparse suffix array over words.

Suffixes are kept only at minimiser positions: of each ``window`` consecutive runs of
``seed`` words the run of smallest hash. Two equal passages of ``least`` words choose the same
positions inside, as ``window + seed - 1 <= least``. Of each passage at least half stands
on one side of such a position, so positions where neither the half after nor the half before stands
in another document match nothing and are dropped before any text moves. The others are sorted over the
whole cluster by the words that follow, then by the words that precede; each is compared
with its neighbours of other documents to the right and extended to the left, and
spans of at least ``least`` words are joined per document. A span that several minimisers
cover is as long as the passage, as contexts reach ``least`` words to either side.

Neighbours are told by what follows, so a passage that ends in words of many documents may have
its holders sorted apart. All windows of ``least`` words that hold a kept position are therefore hashed
too and met with those of other documents; so no passage depends on who its neighbours are.

Texts are cut at ASCII white space; words are compared by 32-bit hashes of which a span needs
``least`` to agree. Equal texts take part once: the smallest id stands for its copies, which get
the whole text as a span if it is long enough. Null, empty and short texts have no spans. Rows
that repeat id and text are one document, known by a 64-bit hash of both. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.byte_bpe import REMEMBERED, Units
from tagloom.llm.frames import keep_one, row_key, staged, text_of

LEAST = 50
SEED = 8
#: Rows of windows that are looked at together, so that a long text needs little memory.
CHUNK = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)

_WORDS = Units(xxhash.xxh64_intdigest, REMEMBERED)


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def minimisers(words: np.ndarray, seed: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the chosen runs and the hashes of these runs. Shorter texts choose the smallest run they have."""
    n = len(words) - seed + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = np.zeros(n, np.uint64)
    for k in range(seed):
        runs = runs * MIX + words[k : k + n]
    runs ^= runs >> np.uint64(29)
    runs *= MIX
    width = min(window, n)
    views = sliding_window_view(runs, width)
    chosen = [np.unique(views[at : at + CHUNK].argmin(axis=1) + np.arange(at, min(at + CHUNK, len(views)))) for at in range(0, len(views), CHUNK)]
    places = np.unique(np.concatenate(chosen))
    return places, runs[places]


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, put together from runs of powers of two."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    runs, length, power = words, 1, np.full(1, MIX)
    out, done = np.zeros(len(words) + 1, np.uint64), 0
    while True:
        if n & length:
            fits = len(words) - done - length + 1
            out = out[:fits] * power + runs[done : done + fits]
            done += length
        if done == n:
            break
        runs = runs[: len(runs) - length] * power + runs[length:]
        length, power = 2 * length, power * power
    out ^= out >> np.uint64(29)
    return out * MIX


def halves(least: int, seed: int) -> tuple[int, int]:
    """Words from a position on, and words up to the end of its seed: every passage that holds the seed has one of both."""
    most = (least - seed) // 2
    return least - most, min(least, most + 1 + seed)


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SEEDS = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("h", pa.int64())])
SUFFIXES = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("after", pa.binary()), ("before", pa.binary()), ("starts", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))])
SPANS = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("partner", pa.int64()), ("edge", pa.int32()), ("pos", pa.int32()), ("after", pa.binary()), ("before", pa.binary())])


def _seeds(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """``row, place, h`` of the halves at the minimisers of each text; ``place`` is twice the position, and one more for the half before."""
    forward, backward = halves(least, seed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows, places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                part = batch.slice(at, 512)
                for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist()):
                    words = word_hashes(text)
                    if len(words) < least:
                        continue
                    found, _ = minimisers(words, seed, least - seed + 1)
                    for side, length, first in ((0, forward, found), (1, backward, found + seed - backward)):
                        there = (first >= 0) & (first + length <= len(words))
                        places.append(2 * found[there] + side)
                        hashes.append(rolling(words, length)[first[there]].view(np.int64))
                        rows.append(np.full(len(places[-1]), row, np.int64))
                yield _batch(SEEDS, [np.concatenate(x) for x in (rows, places, hashes)])

    return texts.select("row", "text").mapInArrow(cut, "row long, place long, h long")


def _suffixes(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """``row, pos, after, before, starts, hashes``: the words from each kept position on, and those before it from the nearest.

    ``starts`` and ``hashes`` are the windows of ``least`` words that hold the position with a
    half that was kept and start after those of the position before.
    """
    most = least - halves(least, seed)[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), ([], [], [], [], [], [])
                for row, text, places in zip(*(part.column(c).to_pylist() for c in ("row", "text", "places"))):
                    hashed = word_hashes(text)
                    words = (hashed >> np.uint64(32)).astype(">u4")
                    backward = words[::-1].copy()
                    windows = rolling(hashed, least).view(np.int64)
                    held = np.zeros(len(windows), bool)
                    for place in places:
                        p = place >> 1
                        low, high = (p - least + seed, p - most) if place & 1 else (p - most, p + 1)
                        held[max(0, low) : max(0, high)] = True
                    starts, kept = np.flatnonzero(held), sorted({place >> 1 for place in places})
                    for p, mine in zip(kept, np.split(starts, np.searchsorted(starts, kept, "right"))):
                        q = len(words) - p
                        for column, value in zip(out, (row, p, words[p : p + least].tobytes(), backward[q : q + least].tobytes(), mine.astype(np.int32), windows[mine])):
                            column.append(value)
                yield _batch(SUFFIXES, list(out))

    return texts.select("row", "text", "places").mapInArrow(cut, "row long, pos int, after binary, before binary, starts array<int>, hashes array<long>")


def _shared_windows(suffixes: DataFrame, least: int) -> DataFrame:
    """``row, first, last, partner`` of each window that another document holds too."""
    windows = suffixes.select("row", F.inline(F.arrays_zip(F.col("starts").alias("first"), F.col("hashes").alias("h"))))
    holders = windows.groupBy("h").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low < high").withColumnRenamed("h", "again")
    partner = F.when(F.col("row") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return windows.join(staged(holders, "shared-windows"), F.col("h") == F.col("again")).select("row", "first", (F.col("first") + least).cast("int").alias("last"), partner.alias("partner"))


def _matrix(contexts: list[bytes], reach: int) -> np.ndarray:
    """Contexts as rows of words; words that are not there differ from all others."""
    out = np.zeros((len(contexts), reach), np.uint64)
    for i, c in enumerate(contexts):
        out[i, : len(c) // 4] = np.frombuffer(c, ">u4").astype(np.uint64) + np.uint64(1)
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words two rows share from their start; a missing word ends it."""
    differs = (a != b) | (a == 0)
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


class Neighbours:
    """Compares sorted suffixes with the nearest ones of other documents on both sides."""

    def __init__(self, reach: int, least: int):
        self.reach, self.least = reach, least
        self.rows = np.zeros(0, np.int64)
        self.pos = np.zeros(0, np.int64)
        self.after = np.zeros((0, reach), np.uint64)
        self.before = np.zeros((0, reach), np.uint64)
        self.lead = 0  # rows at the start that are there only to be compared with

    def add(self, rows, pos, after, before) -> list[np.ndarray]:
        self.rows = np.concatenate([self.rows, np.asarray(rows, np.int64)])
        self.pos = np.concatenate([self.pos, np.asarray(pos, np.int64)])
        self.after = np.concatenate([self.after, _matrix(after, self.reach)])
        self.before = np.concatenate([self.before, _matrix(before, self.reach)])
        return self._compare(False)

    def end(self) -> list[np.ndarray]:
        return self._compare(True)

    def _compare(self, ended: bool) -> list[np.ndarray]:
        n = len(self.rows)
        if not n:
            return []
        starts = np.flatnonzero(np.r_[True, self.rows[1:] != self.rows[:-1]])
        run = np.cumsum(np.r_[True, self.rows[1:] != self.rows[:-1]]) - 1
        stop = n if ended else int(starts[-1])  # the last run may go on
        here = np.arange(self.lead, max(stop, self.lead))
        following = np.r_[starts[1:], n]
        spans = []
        for other in (starts[run[here]] - 1, following[run[here]]):
            there = (other >= 0) & (other < n)
            i, j = here[there], other[there]
            right, left = _common(self.after[i], self.after[j]), _common(self.before[i], self.before[j])
            long = right + left >= self.least
            i, j, right, left = i[long], j[long], right[long], left[long]
            for a, b in ((i, j), (j, i)):
                spans.append(np.stack([self.rows[a], self.pos[a] - left, self.pos[a] + right, self.rows[b]], axis=1))
        if not ended:
            first = max(0, stop - 1)
            self.lead = stop - first
            self.rows, self.pos, self.after, self.before = self.rows[first:], self.pos[first:], self.after[first:], self.before[first:]
        return spans


def _spans(sorted_suffixes: DataFrame, reach: int, least: int) -> DataFrame:
    """Spans found within partitions, and the first and last suffixes of each to be compared across their borders."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, part = Neighbours(reach, least), TaskContext.get().partitionId()
        edges: dict[str, tuple] = {}

        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.unique(np.concatenate([np.zeros((0, 4), np.int64), *found]), axis=0)
            none = [None] * len(rows)
            return _batch(SPANS, [rows[:, 0], rows[:, 1].astype(np.int32), rows[:, 2].astype(np.int32), rows[:, 3], none, none, none, none])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                columns = [piece.column(c).to_pylist() for c in ("row", "pos", "after", "before")]
                edges.setdefault("first", tuple(c[0] for c in columns))
                edges["last"] = tuple(c[-1] for c in columns)
                yield out(near.add(*columns))
        yield out(near.end())
        ends = list(edges.values())
        if ends:
            yield _batch(SPANS, [[e[0] for e in ends], [None] * 2, [None] * 2, [None] * 2, [2 * part, 2 * part + 1], [e[1] for e in ends], [e[2] for e in ends], [e[3] for e in ends]])

    return sorted_suffixes.mapInArrow(compare, "row long, first int, last int, partner long, edge int, pos int, after binary, before binary")


def find_repeats(docs: DataFrame, least: int = LEAST, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, end, partner``: spans of words that stand in another document too, and the id of one that holds some of it.

    Of several such documents any may be named; of copies of a whole text it is the one with the smallest id, or the largest for that one.
    """
    if least < seed:
        raise ValueError("a passage must be longer than a seed")
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    n_words = F.size(F.regexp_extract_all(F.col("text"), F.lit(r"[^ \t-\r]+"), F.lit(0)))
    members = staged(
        slim.select("doc_id", row_key("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("group"), F.xxhash64("doc_id", "text").alias("row"), n_words.alias("n_words"))
        .distinct(),
        "texts",
    )
    classes = staged(
        members.groupBy("group").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("stands"), F.sort_array(F.array(F.min("doc_id"), F.max("doc_id"))).alias("ends"))
        .filter("copies > 1").withColumnRenamed("group", "g"),
        "text-classes",
    )
    copied = members.filter(F.col("n_words") >= least).join(classes, F.col("group") == F.col("g")).select(
        "doc_id", "key", F.lit(0).alias("start"), F.col("n_words").alias("end"), F.when(F.col("doc_id") != F.col("stands"), F.col("stands")).otherwise(F.col("ends")[1]).alias("partner")
    )
    texts = keep_one(slim, members.select("doc_id", "key", "group"), largest=False).select(F.xxhash64("doc_id", "text").alias("row"), "text")
    seeds = staged(_seeds(texts, least, seed), "seeds")
    repeated = staged(seeds.groupBy("h").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low < high").select(F.col("h").alias("again")), "repeated-seeds")
    kept = staged(seeds.join(repeated, F.col("h") == F.col("again"), "left_semi").groupBy(F.col("row").alias("r")).agg(F.collect_list("place").alias("places")), "kept-positions")
    suffixes = staged(_suffixes(texts.join(kept, F.col("row") == F.col("r")), least, seed), "suffixes")
    ordered = suffixes.select("row", "pos", "after", "before").repartitionByRange("after", "before", "row", "pos").sortWithinPartitions("after", "before", "row", "pos")
    found = staged(_spans(ordered, least, least), "spans")
    borders = found.filter("edge IS NOT NULL").select("row", "pos", "after", "before", "edge").coalesce(1).sortWithinPartitions("edge").drop("edge")
    across = _spans(borders, least, least).filter("edge IS NULL")
    spans = found.filter("edge IS NULL").unionByName(across).select("row", "first", "last", "partner").distinct().unionByName(_shared_windows(suffixes, least))
    # Overlapping spans of a document become one.
    earlier = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (
        spans.withColumn("new", (F.col("first") > F.coalesce(F.max("last").over(earlier), F.lit(-1))).cast("int"))
        .withColumn("span", F.sum("new").over(upto))
        .groupBy("row", "span").agg(F.min("first").alias("start"), F.max("last").alias("end"), F.min("partner").alias("partner_row"))
    )
    ids = members.select(F.col("row").alias("id_row"), "doc_id", "key", "group")
    merged = staged(joined, "merged-spans")
    named = merged.join(ids, F.col("row") == F.col("id_row")).join(classes.select("g"), F.col("group") == F.col("g"), "left_anti")
    partners = members.select(F.col("row").alias("p_row"), F.col("doc_id").alias("partner"))
    single = named.join(partners, F.col("partner_row") == F.col("p_row")).select("doc_id", "key", "start", "end", "partner")
    return single.unionByName(copied).select("doc_id", "start", "end", "partner")
