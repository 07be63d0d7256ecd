"""Benchmark decontamination by template windows.

Texts become templates: numbers, names and units are replaced with typed placeholders, other
words are lower-cased, marks are dropped. Windows of a template's words are hashed and
joined between documents and benchmark items. An item has leaked into a document when at
least a share of its windows stand there, on alignments whose slots are consistent: a value
of the item always becomes the same value of the document, and different values stay
different. So a question asked again with other numbers or names is found.

A text is read in two ways, and an item may be found in either:

* by names: words that begin with a capital are a name, several of them beside each other one name, at the
  beginning of a sentence too. There ``Anna has``, ``Bob Smith has`` and ``The boy has`` differ in the value of a slot only;
* in any case: all words as lower-cased words, so that a copy in other case is found.

A number is a run of digits with inner points or commas, digit groups parted by blanks, or a number word; a unit is a
word of a fixed list after a number. An item of fewer words than a window, in one of these ways, is one window of its
own length, which documents are then cut to as well. It needs at least two words that are no placeholders, as
``in <number>`` tells nothing; an item that is short in any case is also compared with its values as written.

Null texts count as empty; empty texts match nothing, and so do empty tables. Rows of documents that repeat are one document, as are items that repeat
id and text. Other columns are not looked at. Everything runs in Spark's expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.frames import BROADCAST_ROWS, row_key, small, staged, text_of

#: Words per window, and the share of an item's windows that a document must hold.
WINDOW = 5
LEAST_SHARE = 0.8
#: Words at most that are looked up in every text before its windows are made.
ANCHORS = 5_000
#: Words that are no placeholders, which a window of fewer words needs.
TELLING = 2

# Words that are units when they follow a number, and words that are numbers.
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb lbs oz ml l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours day days "
    "week weeks month months year years meter meters metre metres kilometer kilometers inch inches foot feet mile miles gram grams "
    "kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars euro euros cent cents percent degrees mph kmh w kw"
).split()
NUMBERS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen"
).split()

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
DIGITS = r"[0-9]+(?:[.,][0-9]+)*+(?: [0-9]+(?:[.,][0-9]+)*+)*+"
#: The ways to read a text: pieces by names, pieces in any case, and these as written.
BY_NAMES, ANY_CASE, AS_WRITTEN = range(3)
PIECES = {
    BY_NAMES: r"\p{Lu}[\p{L}\p{M}]*+(?: \p{Lu}[\p{L}\p{M}]*+)*+|[\p{L}\p{M}]++|" + DIGITS,
    ANY_CASE: r"[\p{L}\p{M}]++|" + DIGITS,
}


def _has_digits(piece: Column) -> Column:
    # Pieces start with a letter or a digit, so that comparing tells which.
    return (piece >= "0") & (piece < ":")


def _is_number(piece: Column) -> Column:
    return _has_digits(piece) | piece.isin(NUMBERS)


def _as_read(text: Column, way: int) -> Column:
    """The pieces of a text, in order."""
    return F.regexp_extract_all(text if way == BY_NAMES else F.lower(text), F.lit(PIECES[min(way, ANY_CASE)]), F.lit(0))


def _template(pieces: Column, way: int, number, unit, name, word) -> Column:
    """What ``number``, ``unit``, ``name`` and ``word`` make of each piece."""

    def one(piece: Column, i: Column) -> Column:
        # Nearly all pieces are plain words, so the list of all others is looked up first.
        after = (i > 0) & _is_number(F.get(pieces, i - 1))
        listed = F.when(piece.isin(NUMBERS), number(piece)).when(after, unit(piece)).otherwise(word(piece))
        told = F.when(_has_digits(piece), number(piece))
        if way == BY_NAMES:
            told = told.when(F.lower(piece) != piece, name(piece))
        return told.when(piece.isin(NUMBERS + UNITS), listed).otherwise(word(piece))

    return F.transform(pieces, one)


def slots(pieces: Column, way: int) -> Column:
    """Template and value as written of each piece."""

    def slot(template: str | None):
        return lambda piece: F.struct((F.lit(template) if template else F.lower(piece)).alias("template"), piece.alias("value"))

    return _template(pieces, way, slot(NUMBER), slot(UNIT), slot(NAME), slot(None))


def hashes(pieces: Column, way: int) -> Column:
    """A hash of the template of each piece, or of the piece as written."""
    if way == AS_WRITTEN:
        return F.transform(pieces, lambda piece: F.xxhash64(piece))
    number, unit, name = ((lambda piece, x=x: F.xxhash64(F.lit(x))) for x in (NUMBER, UNIT, NAME))
    return _template(pieces, way, number, unit, name, lambda piece: F.xxhash64(piece))


def windows(words: Column, n: int, way: int, anchors: list[int] | None = None) -> Column:
    """A hash of each window of ``n`` hashes, in order; with ``anchors``, hashes of first words, null for windows that start otherwise."""

    def one(word: Column, i: Column) -> Column:
        made = F.xxhash64(word, *[F.get(words, i + k) for k in range(1, n)], F.lit(way))
        return made if anchors is None else F.when(word.isin(anchors), made)

    return F.slice(F.transform(words, one), F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(0)))


def telling_windows(words: Column, n: int, way: int) -> Column:
    """The same of short windows; null where these have too few words that are no placeholders."""
    placeholders = [F.xxhash64(F.lit(x)) for x in (NUMBER, NAME, UNIT)]

    def one(i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(n)]
        made = F.xxhash64(*parts, F.lit(way))
        return made if way == AS_WRITTEN else F.when(sum((~p.isin(*placeholders)).cast("int") for p in parts) >= TELLING, made)

    starts = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(starts, one)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _windowed(rows: DataFrame, n: int, *keep: str, short: list[tuple[int, int]], whole: bool = False, anchors: list[int] | None = None) -> DataFrame:
    """One row per window of ``text``: ``segment, pos, h``.

    The segments are the windows of ``n`` words by either way, then those of each ``(way, words)`` in ``short``; with ``whole``
    only of texts of just that length; with ``anchors`` only windows that start with one. Each step is a column, so that no array is made twice.
    """
    ways = [BY_NAMES, ANY_CASE, *([AS_WRITTEN] if any(way == AS_WRITTEN for way, _ in short) else [])]
    made = rows.select(*keep, *[_as_read(F.col("text"), way).alias(f"pieces{way}") for way in ways if way != AS_WRITTEN])
    made = made.select(*keep, *[hashes(F.col(f"pieces{min(way, ANY_CASE)}"), way).alias(f"w{way}") for way in ways])
    none = F.expr("cast(array() as array<bigint>)")
    arrays = [windows(F.col(f"w{way}"), n, way, anchors) for way in (BY_NAMES, ANY_CASE)]
    for way, k in short:
        cut = telling_windows(F.col(f"w{way}"), k, way)
        arrays.append(F.when(F.size(f"w{way}") == k, cut).otherwise(none) if whole else cut)
    names = [f"a{i}" for i in range(len(arrays))]
    made = made.select(*keep, *[a.alias(name) for a, name in zip(arrays, names)])
    # Arrays are laid end to end and told apart by their lengths when a window has been found.
    lengths = F.array(*[F.size(name) for name in names])
    made = made.select(*keep, lengths.alias("lengths"), F.posexplode(F.concat(*names)).alias("place", "h"))
    return made.filter("h is not null")


def _placed(found: DataFrame, *keep: str) -> DataFrame:
    """``keep, segment, pos, h``: the place in its segment of each window."""
    ends = F.transform("lengths", lambda _, i: F.aggregate(F.slice("lengths", F.lit(1), i + 1), F.lit(0), lambda a, b: a + b))
    segment = F.size(F.filter("ends", lambda e: e <= F.col("place")))
    placed = found.select(*keep, "h", "place", "lengths", ends.alias("ends")).select(*keep, "h", "place", "lengths", "ends", segment.alias("segment"))
    return placed.select(*keep, "segment", (F.col("place") - F.get("ends", F.col("segment")) + F.get("lengths", F.col("segment"))).alias("pos"), "h")


def anchor_words(items: DataFrame, item_windows: DataFrame, n: int, least_share: float) -> list[int] | None:
    """Hashes of words such that a document that holds an item holds one of the item's windows that starts with one of them.

    An item may lack some of its windows in a document; of one window more than that, those whose first words are rarest in
    the benchmark, the first words are taken. None if these are too many to be looked up.
    """
    placed = item_windows.filter(F.col("segment") < 2)
    read = items.select(*[F.col(c).alias(f"f_{c}") for c in ITEM], *[_as_read(F.col("text"), way).alias(f"pieces{way}") for way in (BY_NAMES, ANY_CASE)])
    made = read.select("f_item_id", "f_item_key", F.array(*[hashes(F.col(f"pieces{way}"), way) for way in (BY_NAMES, ANY_CASE)]).alias("made"))
    first = made.select("f_item_id", "f_item_key", F.posexplode("made").alias("f_way", "words"))
    same = _same(ITEM, ("f_item_id", "f_item_key")) & (F.col("way") == F.col("f_way"))
    words = staged(placed.join(first, same).select(*ITEM, "way", F.get("words", F.col("item_pos")).alias("word")), "first-words")
    often = words.groupBy("word").agg(F.count(F.lit(1)).alias("often")).withColumnRenamed("word", "o_word")
    group = Window.partitionBy(*ITEM, "way")
    ranked = words.join(often, F.col("word") == F.col("o_word")).select("word", F.row_number().over(group.orderBy("often", "word")).alias("rank"), F.count(F.lit(1)).over(group).alias("windows"))
    lacking = F.col("windows") - F.ceil(F.col("windows") * least_share)
    found = ranked.filter(F.col("rank") <= lacking + 1).select("word").distinct().limit(ANCHORS + 1).collect()
    return sorted(r.word for r in found) if len(found) <= ANCHORS else None


def short_items(items: DataFrame, n: int) -> list[tuple[int, int]]:
    """The ways and lengths of items that have fewer words than a window; at most ``3 * (n - 1)`` of them."""
    read = items.select(F.size(_as_read(F.col("text"), BY_NAMES)).alias("named"), F.size(_as_read(F.col("text"), ANY_CASE)).alias("plain"))
    lengths = F.array(*[F.struct(F.lit(way).alias("way"), F.col(c).alias("k")) for way, c in ((BY_NAMES, "named"), (ANY_CASE, "plain"), (AS_WRITTEN, "plain"))])
    return sorted((r.way, r.k) for r in read.select(F.inline(lengths)).filter(F.col("k").between(1, n - 1)).distinct().collect())


DOCUMENT, ITEM = ("doc_id", "key"), ("item_id", "item_key")


def _same(left: tuple, right: tuple):
    return F.col(left[0]).eqNullSafe(F.col(right[0])) & (F.col(left[1]) == F.col(right[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, least_share: float = LEAST_SHARE, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, key, item_id, windows, matched, share, changed`` of each document that holds an item.

    ``changed`` tells that slots have other values than in the benchmark. Of the ways to read, the one with the larger share counts.
    """
    items = staged(benchmark.select(F.col(item_id).alias("item_id"), row_key(text).alias("item_key"), text_of(text).alias("text")).distinct(), "items")
    short = short_items(items, n)
    ways = F.array(*[F.lit(way) for way in (BY_NAMES, ANY_CASE, *[way for way, _ in short])])
    made = _placed(_windowed(items, n, *ITEM, short=short, whole=True), *ITEM)
    item_windows = staged(made.select(*ITEM, "segment", F.get(ways, F.col("segment")).alias("way"), F.col("pos").alias("item_pos"), F.col("h").alias("item_h")), "item-windows")
    n_windows = item_windows.count()
    known = staged(item_windows.groupBy("item_h").agg(F.count(F.lit(1)).alias("items")), "window-hashes", n_windows)
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(text).alias("key"), text_of(text).alias("text"))
    anchors = anchor_words(items, item_windows, n, least_share)
    if anchors is not None:
        # All texts are searched for the windows that start with an anchor; all windows are made of the few that have one.
        hit = _windowed(rows, n, *DOCUMENT, short=short, anchors=anchors).join(small(known.select("item_h"), known.count()), F.col("h") == F.col("item_h"))
        hit = staged(hit.select(F.col("doc_id").alias("h_id"), F.col("key").alias("h_key")).distinct(), "anchored-documents", n_windows)
        n_hit = hit.count()
        rows = rows.join(small(hit, n_hit), _same(DOCUMENT, ("h_id", "h_key"))).drop("h_id", "h_key")
    met = _windowed(rows, n, *DOCUMENT, short=short).join(small(known.select("item_h"), known.count()), F.col("h") == F.col("item_h"))
    found = staged(_placed(met, *DOCUMENT).distinct(), "found-windows")
    n_found = found.count()
    # The windows of one alignment of a document with an item, in one way of reading.
    aligned = (
        found.withColumnRenamed("segment", "d_segment").join(small(item_windows, n_windows), (F.col("h") == F.col("item_h")) & (F.col("d_segment") == F.col("segment")))
        .groupBy(*DOCUMENT, *ITEM, "segment", "way", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set("item_pos").alias("at"))
    )
    described = item_windows.groupBy(*ITEM, "segment", "way").agg((F.max("item_pos") + 1).cast("long").alias("windows"))
    described = described.join(items.select(F.col("item_id").alias("t_id"), F.col("item_key").alias("t_key"), "text"), _same(ITEM, ("t_id", "t_key"))).select(
        F.col("item_id").alias("i"), F.col("item_key").alias("ik"), F.col("segment").alias("s"), "windows", F.col("way").alias("i_way"), "text"
    )
    described = staged(_slotted(described, "i_way", "i", "ik", "s", "windows").drop("i_way"), "described-items", n_windows)
    # A document can hold an item only if its alignments together reach the share.
    alignments = staged(
        aligned.join(small(described, described.count(), BROADCAST_ROWS // 10), _same(ITEM, ("i", "ik")) & (F.col("segment") == F.col("s")))
        .select(*DOCUMENT, *ITEM, "segment", "way", "shift", "at", "windows", F.transform(F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda s: s["word"]["template"].isin(NUMBER, NAME, UNIT)), lambda s: F.struct(s["at"].alias("at"), s["word"]["template"].alias("template"), s["word"]["value"].alias("value"))).alias("slots")),
        "alignments", n_found,
    )
    pair = (*DOCUMENT, *ITEM, "segment")
    enough = F.size(F.array_distinct(F.flatten(F.collect_list("at")))) >= F.col("windows") * least_share
    candidates = staged(
        alignments.groupBy(*pair, "windows").agg(enough.alias("enough")).filter("enough").select(*[F.col(c).alias(f"c_{c}") for c in pair]),
        "candidates", n_found,
    )
    chosen = staged(
        alignments.join(candidates, _same(DOCUMENT, ("c_doc_id", "c_key")) & _same(ITEM, ("c_item_id", "c_item_key")) & (F.col("segment") == F.col("c_segment"))).select(*pair, "way", "shift", "at", "windows", "slots"),
        "chosen", n_found,
    )
    plain = chosen.filter((F.size("slots") == 0) | (F.col("way") == AS_WRITTEN)).select(*pair, "at", "windows", F.lit(False).alias("changed"))
    checked = _consistent(rows, chosen.filter((F.size("slots") > 0) & (F.col("way") != AS_WRITTEN)), n).select(*pair, "at", "windows", "changed")
    held = plain.unionByName(checked).groupBy(*pair, "windows").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("matched"), F.max("changed").alias("changed"))
    held = held.filter(F.col("matched") >= F.col("windows") * least_share)
    best = F.struct((F.col("matched") / F.col("windows")).alias("share"), (~F.col("changed")).alias("same"), "windows", "matched")
    # Of equal shares an unchanged copy goes before a changed one; a copy that any way shows to be unchanged is so.
    return held.groupBy(*DOCUMENT, *ITEM).agg(F.max(best).alias("best"), F.min("changed").alias("changed")).select(
        *DOCUMENT, "item_id", "best.windows", F.col("best.matched").cast("long").alias("matched"), "best.share", "changed"
    )


def _slotted(rows: DataFrame, way: str, *keep: str) -> DataFrame:
    """``keep`` and ``words``, the slots of ``text`` in the way that a column names. The pieces are a column, so that a text is cut once."""
    named = F.col(way) == BY_NAMES
    cut = rows.select(*keep, way, F.when(named, _as_read(F.col("text"), BY_NAMES)).otherwise(_as_read(F.col("text"), ANY_CASE)).alias("pieces"))
    return cut.select(*keep, way, F.when(named, slots(F.col("pieces"), BY_NAMES)).otherwise(slots(F.col("pieces"), ANY_CASE)).alias("words"))


def _consistent(rows: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """The alignments whose slots map item values to document values one to one.

    Names of as many words on both sides are compared word by word, others as a whole.
    """
    wanted = staged(chosen.select(F.col("doc_id").alias("w_id"), F.col("key").alias("w_key"), F.col("way").alias("w_way")).distinct(), "slotted-documents", chosen.count())
    count = wanted.count()
    same = _same(DOCUMENT, ("w_id", "w_key"))
    texts = _slotted(rows.join(small(wanted, count), same), "w_way", "w_id", "w_key")
    texts = staged(texts.dropDuplicates(["w_id", "w_key", "w_way"]), "slotted-texts", count)
    covered = F.filter("slots", lambda s: F.exists("at", lambda a: (a <= s["at"]) & (s["at"] < a + n)))

    def values(s: Column) -> Column:
        item, doc = F.lower(s["value"]), F.lower(F.get("words", s["at"] + F.col("shift"))["value"])
        split = F.split(item, " "), F.split(doc, " ")
        each = F.transform(F.arrays_zip(split[0].alias("item"), split[1].alias("doc")), lambda p: F.struct(s["template"].alias("kind"), p["item"].alias("item"), p["doc"].alias("doc")))
        return F.when((s["template"] == NAME) & (F.size(split[0]) == F.size(split[1])), each).otherwise(F.array(F.struct(s["template"].alias("kind"), item.alias("item"), doc.alias("doc"))))

    met = chosen.join(texts, same & (F.col("way") == F.col("w_way"))).withColumn("covered", covered)
    met = met.withColumn("pairs", F.array_distinct(F.flatten(F.transform("covered", values))))

    def different(field: str) -> Column:
        return F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p[field]))))

    one_to_one = (different("item") == F.size("pairs")) & (different("doc") == F.size("pairs"))
    return met.filter(one_to_one).withColumn("changed", F.exists("pairs", lambda p: p["item"] != p["doc"]))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, least_share: float = LEAST_SHARE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that hold no item, with all columns of ``docs``."""
    found = staged(find_leaks(docs, benchmark, n, least_share, doc_id=doc_id, text=text).select(F.col("doc_id").alias("_leak_id"), F.col("key").alias("_leak_key")).distinct(), "leaks")
    same = docs[doc_id].eqNullSafe(found["_leak_id"]) & (F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == found["_leak_key"])
    return docs.join(small(found, found.count()), same, "left_anti")
