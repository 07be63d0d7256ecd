"""Phrases whose words keep company, mined by partitioning.

A phrase of frequency ``least`` in a language has, in at least one shard of it, a frequency that reaches
``least`` times the shard's share of the words. So each shard is mined completely at that lowered support, with
phrases of one more word made only from phrases that reach it; what any shard finds is joined; and these
candidates are counted once more over everything, exactly.

* While ``SHARDS`` blocks of words, each held by one task, make up the corpus, a block is a shard, and one pass mines it to the longest phrase.
* A larger corpus is dealt to as many shards of many tasks each, as more shards would lower the support towards one and mine more the larger the
  corpus is. Each length is then a pass: tasks count the phrases both of whose shorter parts are frequent in the shard, Spark sums
  them by shard. A bitmap of at most 2^29 bits carries the frequent phrases of a shard to its tasks.

A candidate is dropped before the last pass if its counts where it is frequent, and one less than the support
elsewhere, sum to less than ``least``. Hashes of 64 bits only select: a collision can add a candidate, never a count,
as the last pass compares words and Spark sums by phrase.

Nulls in text read as empty, in lang as ``und``. Repeated rows count as often as they stand there.
No rows, or no frequent phrase, give no rows. Other columns, and ids, are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.frames import small, staged

LEAST = 100
LONGEST = 5
TOP = 2000
#: A candidate goes if a longer one has at least so many hundredths of its frequency.
CONTAINED = 100
#: Shards at most, and the words that a task holds at once.
SHARDS = 16
BLOCK_WORDS = 10_000_000
#: Words that a task counts candidates in at once, where blocks need not be shards.
COUNT_WORDS = 5_000_000
#: Bits of a bitmap for each phrase in it, and the largest bitmap (64 MB).
BITS_EACH, MOST_BITS = 64, 1 << 29

WORDS = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
#: Marks that part a text into pieces become a byte that no UTF-8 has, tabs become blanks.
CUT = 0xFF
MARKS = bytes(CUT if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256))
SPACED = b" \xff "

#: Odd numbers that mix hashes.
MIX, SPREAD, OF_SHARD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


class _Ids(dict):
    """Numbers of words in the order they come; the cut is 0."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Block:
    """The words of some documents, language by language."""

    def __init__(self):
        self.ids, self.langs, self.size = _Ids(), {}, 0

    def add(self, lang: str, total: int, text: str) -> None:
        words = text.encode("utf-8", "surrogatepass").lower().translate(MARKS).replace(b"\xff", SPACED).split()
        parts = self.langs.setdefault(lang, (total, []))[1]
        parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        parts.append(np.zeros(1, np.int32))
        self.size += len(words) + 1

    def languages(self) -> Iterator[tuple[str, int, "Text"]]:
        words = list(self.ids)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        while self.langs:
            # What has been handed on is not kept.
            lang, (total, parts) = self.langs.popitem()
            ids = np.concatenate(parts)
            del parts
            yield lang, total, Text(ids, words, hashes)


class Text:
    """Words of one language as numbers. ``at`` are the places where phrases of the present length begin, ``h`` their hashes."""

    def __init__(self, ids: np.ndarray, words: list[bytes], hashes: np.ndarray):
        self.ids, self.words, self.hashes = ids, words, hashes
        self.length, self.at = 1, np.flatnonzero(ids)
        self.h = hashes[ids[self.at]]
        self.n = len(self.at)

    def lengthen(self, kept: np.ndarray) -> None:
        """Phrases of one more word, at places where both of their shorter parts are ``kept``."""
        starts = np.zeros(len(self.ids) + 1, bool)
        starts[self.at[kept]] = True
        chosen = kept & starts[self.at + 1]
        self.at, h = self.at[chosen], self.h[chosen]
        h = (h * MIX) ^ self.hashes[self.ids[self.at + self.length]]
        h ^= h >> np.uint64(29)
        h *= SPREAD
        self.h = h ^ (h >> np.uint64(32))
        self.length += 1

    def counted(self) -> Iterator[tuple[bytes, int]]:
        """Phrases and their counts. Places whose words differ from the first place of their hash are counted apart."""
        at, h = self.at, self.h
        while len(at):
            _, first, group, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            alike = np.ones(len(at), bool)
            for k in range(self.length):
                alike &= self.ids[at + k] == self.ids[at[first[group]] + k]
            if not alike.all():
                n = np.bincount(group[alike], minlength=len(first))
            for place, count in zip(at[first].tolist(), n.tolist()):
                yield b" ".join([self.words[i] for i in self.ids[place : place + self.length].tolist()]), count
            at, h = at[~alike], h[~alike]


def support(least: int, part: int, total: int) -> int:
    """The frequency that a phrase of frequency ``least`` among ``total`` words reaches in some shard of ``part`` words."""
    return max(1, -(-least * part // total))


def _blocks(rows: DataFrame, each: Callable[[Block], Iterator[pa.RecordBatch]], schema: str, block_words: int, side_by_side: int = 1) -> DataFrame:
    """What ``each`` makes of every block of ``lang, total, text``; a task deals its rows to so many blocks at a time, in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, i = [Block() for _ in range(side_by_side)], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256).to_pydict()
                for row in zip(piece["lang"], piece["total"], piece["text"]):
                    blocks[i % side_by_side].add(*row)
                    i += 1
                    if sum(block.size for block in blocks) >= block_words:
                        for k in range(side_by_side):
                            yield from each(blocks[k])
                            blocks[k] = Block()
        for k in range(side_by_side):
            yield from each(blocks[k])
            blocks[k] = Block()

    return rows.mapInArrow(run, schema)


def _batch(lang: str, shard: int, h: np.ndarray | pa.Array, n: np.ndarray, least: int) -> pa.RecordBatch:
    same = lambda value, kind: pa.array([value] * len(n), kind)
    h = h if isinstance(h, pa.Array) else pa.array(h)
    return pa.RecordBatch.from_arrays([same(lang, pa.string()), same(shard, pa.int32()), h, pa.array(n, pa.int64()), same(least, pa.int64())], schema=_arrow(MINED))


MINED = "lang string, shard int, h long, n long, least long"


def _mine_blocks(rows: DataFrame, least: int, longest: int, block_words: int, shards: int) -> DataFrame:
    """``lang, h, n, least`` of the phrases that are frequent in a block, and a row without ``h`` for each block.

    There are about ``shards`` blocks however many tasks there are, so that the support is lowered alike at every size.
    """
    rows = rows.coalesce(shards)
    side_by_side = max(1, shards // max(1, rows.rdd.getNumPartitions()))

    def mine(block: Block) -> Iterator[pa.RecordBatch]:
        for lang, total, text in block.languages():
            if not text.n:
                continue
            lowered = support(least, text.n, total)
            yield _batch(lang, 0, pa.array([None], pa.int64()), np.array([0]), lowered)
            while len(text.at):
                found, n = np.unique(text.h, return_counts=True)
                found, n = found[n >= lowered], n[n >= lowered]
                yield _batch(lang, 0, found.view(np.int64), n, lowered)
                if text.length == longest:
                    break
                # A place that the bitmap lets through by chance adds work, and at most a candidate.
                text.lengthen(_in_bitmap(_bitmap_of(found), text.h))

    return _blocks(rows, mine, MINED, block_words, side_by_side).drop("shard")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _bits(count: int) -> int:
    return 1 << min(MOST_BITS.bit_length() - 1, max(15, (BITS_EACH * count).bit_length()))


def _bitmap_of(h: np.ndarray) -> np.ndarray:
    """A bit for the low bits of each hash."""
    flags = np.zeros(_bits(len(h)), bool)
    flags[h & np.uint64(len(flags) - 1)] = True
    return np.packbits(flags, bitorder="little")


def bitmap(hashes: DataFrame, count: int) -> np.ndarray:
    """The same of a column ``h``. Spark builds it in pieces of 4 KB; its size is bounded."""
    bits = _bits(count)
    place = hashes.select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("place"))
    pieces = place.groupBy(F.expr("place div 32768").alias("piece")).agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.collect():
        out[row.piece * 4096 : (row.piece + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _signed(value: np.uint64) -> int:
    return int(np.uint64(value).astype(np.int64))


def _salt(shard: int) -> np.uint64:
    """Parts the hashes of a shard from those of others in one bitmap."""
    return np.uint64(shard * int(OF_SHARD) % (1 << 64))


def _mine_dealt(rows: DataFrame, least: int, longest: int, shards: int, block_words: int) -> DataFrame:
    """The same where a shard has many tasks: a pass for each length, sums by shard in between."""
    spark, totals = rows.sparkSession, rows.select(F.col("lang").alias("t_lang"), "total").distinct()
    salts = F.array(*[F.lit(_signed(_salt(i))) for i in range(shards)])
    mined, sizes, levels = None, None, []
    for length in range(1, longest + 1):
        held = spark.sparkContext.broadcast(levels)

        def count(block: Block, held=held) -> Iterator[pa.RecordBatch]:
            shard = TaskContext.get().partitionId() % shards
            for lang, _, text in block.languages():
                for bits in held.value:
                    text.lengthen(_in_bitmap(bits, text.h ^ _salt(shard)))
                found, n = np.unique(text.h, return_counts=True)
                yield _batch(lang, shard, found.view(np.int64), n, 0)

        counts = staged(_blocks(rows, count, MINED, block_words).groupBy("lang", "shard", "h").agg(F.sum("n").alias("n")), f"shard-phrases-{length}")
        if sizes is None:
            part = counts.groupBy("lang", "shard").agg(F.sum("n").alias("part"))
            lowered = F.expr(f"greatest(1L, (cast(part as decimal(19,0)) * cast({least} as decimal(18,0)) + total - 1) div total)")
            sizes = staged(part.join(totals, F.col("lang") == F.col("t_lang")).select(F.col("lang").alias("s_lang"), F.col("shard").alias("s_shard"), lowered.alias("least")), "shards")
            n_sizes = sizes.count()
        in_shard = (F.col("lang") == F.col("s_lang")) & (F.col("shard") == F.col("s_shard"))
        frequent = staged(counts.join(small(sizes, n_sizes), in_shard).filter(F.col("n") >= F.col("least")).select("lang", "shard", "h", "n", "least"), f"shard-frequent-{length}")
        mined = frequent if mined is None else mined.unionByName(frequent)
        found = frequent.count()
        if not found:
            break
        levels = [*levels, bitmap(frequent.select(F.col("h").bitwiseXOR(F.get(salts, F.col("shard"))).alias("h")), found)]
    summary = sizes.select(F.col("s_lang").alias("lang"), F.lit(None).cast("long").alias("h"), F.lit(0).cast("long").alias("n"), "least")
    return mined.drop("shard").unionByName(summary)


def candidates(mined: DataFrame, least: int) -> DataFrame:
    """``h`` of the phrases that may reach ``least``: counts where frequent, and one less than the support elsewhere."""
    slack = mined.filter("h is null").groupBy(F.col("lang").alias("s_lang")).agg(F.sum(F.col("least") - 1).alias("slack"))
    summed = mined.filter("h is not null").groupBy("lang", "h").agg(F.sum(F.col("n") - F.col("least") + 1).alias("over"))
    return summed.join(slack, F.col("lang") == F.col("s_lang")).filter(F.col("over") + F.col("slack") >= least).select("h").distinct()


COUNTED = "lang string, phrase string, length int, n long"


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, block_words: int = BLOCK_WORDS, stored: bool = False, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, length, f`` of all phrases, single words too, of frequency ``least`` or more; and ``lang, total``.

    ``stored`` tells that ``docs`` reads files as they are, so that a row stands in the same partition each time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if not stored:
        rows = staged(rows, "texts")
    words = F.regexp_count("text", F.lit(WORDS)).cast("long")
    totals = staged(rows.groupBy("lang").agg(F.sum(words).alias("total")).filter("total > 0"), "totals")
    n_langs, n_words = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("total"), F.lit(0))).first()
    rows = rows.join(small(totals, n_langs), "lang")
    if n_words <= shards * block_words:
        mined = _mine_blocks(rows, least, longest, block_words, shards)
        # A candidate comes once from each block that has it. So these blocks are not more than those that were mined.
        dealt, count_words = rows.coalesce(shards), block_words
    else:
        mined = _mine_dealt(rows, least, longest, shards, block_words)
        dealt, count_words = rows, min(block_words, COUNT_WORDS)
    chosen = staged(candidates(staged(mined, "mined"), least), "candidates")
    bits = spark.sparkContext.broadcast(bitmap(chosen, chosen.count()))

    def count(block: Block) -> Iterator[pa.RecordBatch]:
        for lang, _, found in block.languages():
            while True:
                kept = _in_bitmap(bits.value, found.h)
                found.at, found.h = found.at[kept], found.h[kept]
                rows = list(found.counted())
                for at in range(0, len(rows), 50_000):
                    phrases, n = zip(*rows[at : at + 50_000])
                    columns = [lang] * len(n), pa.array(phrases, pa.binary()).cast(pa.string()), [found.length] * len(n), n
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _arrow(COUNTED).types)], schema=_arrow(COUNTED))
                if not rows or found.length == longest:
                    break
                found.lengthen(np.ones(len(found.at), bool))

    counted = _blocks(dealt, count, COUNTED, count_words).groupBy("lang", "phrase", "length").agg(F.sum("n").alias("f"))
    return staged(counted.filter(F.col("f") >= least), "frequent-phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED, shards: int = SHARDS, block_words: int = BLOCK_WORDS, stored: bool = False, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language by their weakest cut."""
    found, totals = frequent_phrases(docs, least, longest, shards, block_words, stored, text, lang)
    phrases = found.filter("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    def joined(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", start, size), " ")

    cuts = phrases.select("lang", "phrase", "length", "a", "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    firsts, rests = (found.select(F.col("lang").alias(f"{x}_lang"), F.col("phrase").alias(f"{x}_phrase"), F.col("f").alias(x)) for x in "lr")
    # Products of three counts pass 64 bits; decimals of 38 digits hold them exactly.
    above, below = "cast(1000 * a as decimal(19,0)) * cast(total as decimal(18,0))", "cast(l as decimal(19,0)) * cast(r as decimal(18,0))"
    scored = (
        cuts.join(firsts, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase")))
        .join(rests, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
        .join(totals.withColumnRenamed("lang", "t_lang"), F.col("lang") == F.col("t_lang"))
        .groupBy("lang", "phrase", "a", F.col("total").alias("n"))
        .agg(F.min(F.struct(F.expr(f"({above}) div ({below})").alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    # What stands inside a longer phrase, with the largest frequency of one.
    inside = phrases.select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(2), F.col("length"))).alias("size")).filter("size < length")
    inside = inside.select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("start"))
    inside = inside.groupBy(F.col("lang").alias("i_lang"), joined(F.col("start"), F.col("size")).alias("i_phrase")).agg(F.max("a").alias("longer"))
    alone = scored.join(inside, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")), "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a"))
    )
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return alone.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
