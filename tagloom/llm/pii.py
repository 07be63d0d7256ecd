"""Personal data: base patterns, and identifiers that their contexts reveal.

Base spans of four kinds come from patterns. Each occurrence has lexical patterns: the word, and the
two words, before it and after it. A graph links these patterns to the instances (values)
that stand in them, among which are also unseen ones: tokens of no kind that look like identifiers, and
runs of digit groups. Instances of a kind start with score 1 for it. A pattern's score for a kind is the share of the kind
among its typed instances, times the share of its unseen instances that have the form of the kind: that there are
many unseen ones speaks neither for nor against it, that they are of all sorts does. An unseen instance of that
form has the score of its best pattern, counts as typed from then on, and so for some rounds. In patterns of high score it becomes a span.

Offsets count code points, the end exclusive. Null texts count as empty and have no spans.
Rows that repeat each get a row. Contexts are counted once for each row. Other columns are
not looked at. Everything runs in Spark's expressions, joins and sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.frames import row_key, small, staged, text_of

# Kinds in their order and their patterns. Possessive repeats and the conditions on
# what stands before give the same matches as plain ones, in time that grows with the text.
LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What every match of a kind holds, so that other texts are passed over.
HOLDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
BYTE = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?$"
#: What looks like an identifier: groups of digits with single blanks, brackets or hyphens, or a token with a digit or an at sign;
#: of six characters or more. Shorter ones are words of the context.
TOKEN = (
    r"(?<![A-Za-z0-9._%+@(-])(?:(?=[0-9()\x20/.-]{6})\(?[0-9][0-9()/.-]*+(?:\x20\(?[0-9][0-9()/.-]*+)++(?![A-Za-z@])"
    r"|(?=[A-Za-z0-9._%+@(-]{6})\(?[A-Za-z._%+-]*+[0-9@][A-Za-z0-9._%+@-]*+)"
)
TOKEN_LENGTH = 6
#: The form of a kind: whether there are letters, how many digits, and a mark that it holds.
FORMS = {"email": (True, 0, 999, ""), "ip": (False, 4, 12, "."), "card": (False, 13, 19, ""), "phone": (False, 6, 15, "")}
#: Matches whose lengths are summed together.
BLOCK = 256
ROUNDS = 3
LEAST_SCORE = 0.8
LEAST_SUPPORT = 5

SIDES = ("before", "before2", "after", "after2")
SPAN = "array<struct<kind:string,start:int,end:int,value:string," + ",".join(f"{side}:string" for side in SIDES) + ">>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second from the right doubled, divides by ten."""
    from_right = F.reverse(digits)

    def weighed(i: Column) -> Column:
        digit = F.substr(from_right, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    doubled = F.transform(F.sequence(F.lit(1), F.length(digits)), weighed)
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(BYTE))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "":
        return F.length(F.rtrim(value, F.lit(".-"))) >= TOKEN_LENGTH
    return F.lit(True)


def _with_spans(rows: DataFrame, name: str, kind: str, pattern: str, worth: Column) -> DataFrame:
    """``rows`` with the valid matches of a pattern in their text, left to right, in a column ``name``.

    The pieces between matches give the places: a match starts after all that stands before it.
    Lengths are summed within blocks and over the blocks, so that a text of very many matches
    takes time in proportion. Each step is a column that the next uses twice, so that none is
    made again for every match.
    """
    matches, gaps, steps, sums, before = (f"_{x}" for x in ("matches", "gaps", "steps", "sums", "before"))
    n = F.size(matches)

    def total(array: str, first: Column, length: Column) -> Column:
        return F.aggregate(F.slice(array, first, length), F.lit(0), lambda a, x: a + x)

    def block(i: Column) -> Column:
        return F.floor(i / BLOCK).cast("int")

    def span(match: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        start = F.get(before, block(i)) + total(steps, block(i) * BLOCK + 1, i % BLOCK) + F.length(gap)
        value = F.rtrim(match, F.lit(".-")) if kind == "" else match
        following = F.get(gaps, i + 1)
        words = (r"(?<!\S)(\S++)\s*+$", r"(?<!\S)(\S++\s++\S++)\s*+$", r"^\s*+(\S++)", r"^\s*+(\S++\s++\S++)")
        contexts = [F.lower(F.regexp_extract(following if "after" in side else gap, word, 1)).alias(side) for side, word in zip(SIDES, words)]
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), *contexts)

    return (
        rows.withColumn(matches, F.when(worth, F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)")))
        .withColumn(gaps, F.when(n > 0, F.split("text", pattern, -1)))
        .withColumn(steps, F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(gaps, i))))
        .withColumn(sums, F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(0), block(n - 1)), lambda b: total(steps, b * BLOCK + 1, F.lit(BLOCK)))))
        .withColumn(before, F.when(F.size(sums) > 0, F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(sums, F.lit(1), b))))
        .withColumn(name, F.when(F.size(before) > 0, F.filter(F.transform(matches, span), lambda s: _valid(kind, s["value"]))).otherwise(F.expr(f"cast(array() as {SPAN})")))
        .drop(matches, gaps, steps, sums, before)
    )


def find_base(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, key``, the spans of each kind in a column of its name, and ``loose`` tokens of no kind."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(text).alias("key"), text_of(text).alias("text"))
    for kind, pattern in KINDS.items():
        worth = F.instr("text", HOLDS[kind]) > 0 if HOLDS[kind] else F.lit(True)
        rows = _with_spans(rows, kind, kind, pattern, worth if kind == "email" else worth & F.col("text").rlike("[0-9]"))
    rows = _with_spans(rows, "loose", "", TOKEN, F.col("text").rlike("[0-9@]")).drop("text")
    base = F.concat(*KINDS)
    apart = F.filter("loose", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.withColumn("loose", F.when((F.size("loose") > 0) & (F.size(base) > 0), apart).otherwise(F.col("loose")))


def _in_patterns(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per occurrence and context word: ``side`` and ``word``."""
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.regexp_replace(F.col(f"s.{side}"), r"\s+", " ").alias("word")) for side in SIDES])
    return rows.select(*keep, "s", F.explode(sides).alias("p")).select(*keep, "s", "p.side", "p.word").filter("word <> ''")


def _has_form(value: Column, kind: Column) -> Column:
    """Whether a value has the form of a kind."""
    letters, digits = value.rlike("[A-Za-z]"), F.length(_digits(value))
    told = F.lit(False)
    for name, (wanted, least, most, mark) in FORMS.items():
        told = F.when(kind == name, (letters == F.lit(wanted)) & digits.between(least, most) & value.contains(mark)).otherwise(told)
    return told


def patterns(found: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE, least_support: int = LEAST_SUPPORT) -> DataFrame:
    """``side, word, kind, score`` of the patterns that reveal a kind, from the spans of ``find_base``."""
    occurrences = found.select(F.explode(F.concat(*KINDS, F.col("loose"))).alias("s"))
    edges = staged(
        _in_patterns(occurrences).groupBy("side", "word", F.col("s.kind").alias("is"), F.col("s.value").alias("value")).agg(F.count(F.lit(1)).alias("n")),
        "pattern-instances",
    )
    rows = edges.count()
    seeds = edges.filter(F.col("is") != "").select("side", "word", F.col("is").alias("kind"), "value", "n", F.lit(1.0).alias("s"))
    loose = edges.filter(F.col("is") == "").select("side", "word", "value", "n")
    alike = loose.select("*", F.explode(F.array(*map(F.lit, KINDS))).alias("kind")).filter(_has_form(F.col("value"), F.col("kind")))
    alike = staged(alike, "unseen-of-a-form", 4 * rows)
    unseen = loose.groupBy("side", "word").agg(F.sum("n").alias("unseen"))
    fitting = alike.groupBy("side", "word", "kind").agg(F.sum("n").alias("fitting"))
    agreed = staged(fitting.join(unseen, ["side", "word"]).select(*[F.col(c).alias(f"f_{c}") for c in ("side", "word", "kind")], (F.col("fitting") / F.col("unseen")).alias("agreed")), "form-shares", 4 * rows)
    same = (F.col("side") == F.col("f_side")) & (F.col("word") == F.col("f_word")) & (F.col("kind") == F.col("f_kind"))
    typed = seeds
    for i in range(rounds):
        explained = typed.groupBy("side", "word", "kind").agg(F.sum(F.col("n") * F.col("s")).alias("explained"), F.count(F.lit(1)).alias("support"))
        explained = staged(explained, f"explained-{i}", rows)
        totals = explained.groupBy(F.col("side").alias("t_side"), F.col("word").alias("t_word")).agg(F.sum("explained").alias("total"))
        pure = explained.filter(F.col("support") >= least_support).join(totals, (F.col("side") == F.col("t_side")) & (F.col("word") == F.col("t_word")))
        # Without an unseen instance of the form there is nothing to find.
        scored = staged(pure.join(agreed, same).select("side", "word", "kind", (F.col("explained") / F.col("total") * F.col("agreed")).alias("score")), f"patterns-{i}", rows)
        if i + 1 < rounds:
            # Unseen instances take the score of their best pattern.
            instances = staged(
                alike.join(scored, ["side", "word", "kind"]).groupBy("value", "kind").agg(F.max("score").alias("s")).filter(F.col("s") >= least_score),
                f"instances-{i}", rows,
            )
            typed = seeds.unionByName(alike.join(instances, ["value", "kind"]).select("side", "word", "kind", "value", "n", "s"))
    return scored.filter(F.col("score") >= least_score)


def find(docs: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE, least_support: int = LEAST_SUPPORT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``added``: arrays of ``kind, start, end, value`` ordered by kind, then start."""
    found = staged(find_base(docs, doc_id, text), "base-spans")
    revealing = staged(patterns(found, rounds, least_score, least_support), "patterns")
    loose = found.filter(F.size("loose") > 0).select("doc_id", "key", F.explode("loose").alias("s")).distinct()
    hits = _in_patterns(loose, "doc_id", "key").join(small(revealing, revealing.count()), ["side", "word"]).filter(_has_form(F.col("s.value"), F.col("kind")))
    one = hits.groupBy("doc_id", "key", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.value").alias("value")).agg(
        F.max_by("kind", F.struct("score", "kind")).alias("kind")
    )
    added = staged(
        one.groupBy(F.col("doc_id").alias("a_id"), F.col("key").alias("a_key")).agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("added")),
        "added",
    )
    plain = F.transform(F.concat(*KINDS), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    rows = found.select("doc_id", "key", plain.alias("base"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS])
    same = F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("key") == F.col("a_key"))
    return rows.join(small(added, added.count(), 50_000), same, "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base", F.coalesce("added", F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string>>)")).alias("added")
    )


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ordered(*spans: Column) -> Column:
    """All spans by kind, then start."""
    together = F.concat(*spans)

    def of(kind: str) -> Column:
        return F.sort_array(F.filter(together, lambda s: s["kind"] == F.lit(kind)))

    return F.concat(*map(of, KINDS))


def summary(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of the rows of ``find``."""
    both = F.when(F.size("added") == 0, written(F.col("base"))).otherwise(written(ordered(F.col("base"), F.col("added"))))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"), both.alias("spans"), F.size("added").cast("long").alias("n_added"))
