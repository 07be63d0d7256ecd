"""Toxicity scores from a learned lexicon, misspelled terms included, and the context of each hit.

Learning: words of labelled documents are counted by label; their stems that toxic documents
hold far more often become the lexicon, weighted by log-odds. Each document is then reduced
to what its hits say (see ``Scorer``), and a logistic regression learns the score.

A hit is a word that starts with a stem, or nearly (see ``FuzzyLexicon``): with a letter more, less, other or swapped, or
with a mark inside, as in ``st*pid``. An edit takes a fixed amount off the log-odds of the stem, so a misspelled term
speaks for toxicity like the term itself, only less; a stem gets as many edits as leave it the odds of the lexicon. A spelling that
the labelled clean documents use is a word of its own and no misspelling. Words shorter than a stem count as whole words.

A window of words around a hit tells abuse from quotation: quotation marks and words of reporting speak for a
quotation, words of address against it; hits in quotations count as a feature of their own.

Null and empty texts get the score of a text without hits. Without labelled documents of both
kinds every score is the share of toxic ones (0 without any). Rows repeat as they do in the
input; a document that the labels name twice counts once, toxic if any of them says so.
Only the text is an input of a score; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.byte_bpe import REMEMBERED, Units
from tagloom.llm.frames import staged, text_of
from tagloom.llm.fuzzy_lexicon import FuzzyLexicon

WORD = re.compile(r"[^\W_]+")
#: The same words for Spark's expressions.
WORD_SQL = r"[\p{L}\p{N}\p{M}]+"
#: From the first letter of a token to its last, marks between them included.
INNER = re.compile(r"[^\W_].*[^\W_]")
LONGEST = 24
QUOTES = re.compile(r"[\"“”„«»]")
# Words of reporting and words of address.
REPORTING = frozenset(
    "said says wrote called calls calling word words term quote quoted quotes slur insult dit appelé mot terme "
    "citation sagte nannte wort begriff zitat dijo llamó palabra término cita".split()
)
ADDRESS = frozenset("you your youre u ur du dich dein deine ihr euch tu te toi ton ta vous votre tú tu eres usted ustedes".split())


@dataclass(frozen=True)
class Settings:
    #: Bound of the labelled rows to learn from, those with the smallest hash of their text.
    sample_rows: int = 40_000
    #: Lengths of stems, and documents that must hold one: so many, or that share of the toxic ones.
    shortest: int = 4
    longest: int = 12
    least_docs: int = 4
    least_share: float = 0.004
    #: Log-odds from which a stem enters the lexicon, and what an edit takes off them.
    least_odds: float = 2.5
    edit_odds: float = 2.4
    #: Clean documents that use a spelling, from which on it is no misspelling.
    known_docs: int = 2
    #: Words on either side of a hit that tell its context.
    window: int = 6


FEATURES = 4


@dataclass
class Scorer:
    """Turns texts into features and scores; small enough to be sent to every task."""

    stems: dict[str, float]
    window: int = 6
    #: Short words, which only match as a whole, and spellings that are words of their own.
    words: dict[str, float] = field(default_factory=dict)
    known: frozenset[str] = frozenset()
    least_odds: float = Settings.least_odds
    edit_odds: float = Settings.edit_odds
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0
    constant: float | None = None

    def __post_init__(self) -> None:
        self._lexicon = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lexicon": None, "_units": None}

    def match(self, word: str) -> tuple[float, int] | None:
        """Log-odds that a word adds, and the edits to its stem."""
        if word in self.words:
            return self.words[word], 0
        found = self._lexicon.match(word)
        if found is None or found[1] and word in self.known:
            return None
        return found[0] - self.edit_odds * found[1], found[1]

    def _hit(self, token: str) -> tuple[float, int] | None:
        """The best match among the words of a token between spaces, and the token itself where marks part its letters."""
        words = WORD.findall(token)
        if len(words) > 1 and (inner := INNER.search(token)) and len(inner[0]) <= LONGEST:
            words.append(inner[0])
        return max(filter(None, map(self.match, words)), default=None)

    def _hits(self) -> Units:
        if self._lexicon is None:
            self._lexicon = FuzzyLexicon(self.stems, edits={s: int((w - self.least_odds) / self.edit_odds) for s, w in self.stems.items()})
            self._units = Units(self._hit, REMEMBERED)
        return self._units

    def _quoted(self, tokens: list[str], i: int) -> bool:
        """Whether the words around a hit quote it rather than address someone."""
        before, after = tokens[max(0, i - self.window) : i], tokens[i + 1 : i + 1 + self.window]
        inside = any(map(QUOTES.search, [*before, tokens[i]])) and any(map(QUOTES.search, [tokens[i], *after]))
        around = [w for t in before + after for w in WORD.findall(t)]
        return 2 * inside + sum(w in REPORTING for w in around) > sum(w in ADDRESS for w in around)

    def features(self, text: str) -> list[float]:
        """Log-odds of hits, of quoted ones, the heaviest hit, and hits per word; damped sums."""
        tokens = text.lower().split()
        found = list(map(self._hits().__getitem__, tokens))
        if not any(found):
            return [0.0] * FEATURES
        plain = quoted = heaviest = 0.0
        hits = [(i, *hit) for i, hit in enumerate(found) if hit]
        for i, weight, _ in hits:
            if self._quoted(tokens, i):
                quoted += weight
            else:
                plain += weight
                heaviest = max(heaviest, weight)
        return [math.log1p(plain), math.log1p(quoted), heaviest, math.log1p(100 * len(hits) / len(tokens))]

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        z = self.intercept + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-min(700.0, max(-700.0, z))))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: one fifth, by the CRC-32 of its id. Null ids are kept too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """``text, toxic`` of a bounded sample of the labelled documents; equal texts once."""
    marked = (
        labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    chosen = staged(marked.orderBy(F.xxhash64("labelled"), "labelled").limit(settings.sample_rows), "labelled")
    known = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    return known.groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn_stems(rows: DataFrame, settings: Settings) -> tuple[dict[str, float], dict[str, float], DataFrame]:
    """The lexicon: stems, and words shorter than these, with the log-odds of toxic against other documents.

    And ``word, p, n``: the toxic and other documents of each word. The lexicon is as large as the bounded sample makes it.
    """
    total = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, other = (total[0] or 0), (total[1] or 0)
    words = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD_SQL), F.lit(0)))).alias("word"))
    counted = staged(words.groupBy("word").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")), "words")
    starts = F.sequence(F.lit(settings.shortest), F.least(F.length("word"), F.lit(settings.longest)))
    least = max(settings.least_docs, math.ceil(settings.least_share * toxic))
    odds = F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((F.col("n") + 0.5) / (other + 1))

    def telling(found: DataFrame) -> DataFrame:
        return found.filter(F.col("p") >= least).withColumn("odds", odds).filter(F.col("odds") >= settings.least_odds)

    stems = (
        counted.filter(F.length("word") >= settings.shortest).select("p", "n", F.explode(F.transform(starts, lambda k: F.substr("word", F.lit(1), k))).alias("stem"))
        .groupBy("stem").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    )
    found = {r["stem"]: (r["p"], r["odds"]) for r in telling(stems).collect()}
    short = {r["word"]: r["odds"] for r in telling(counted.filter(F.length("word") < settings.shortest)).collect()}
    return _closed(found), short, counted


def known_spellings(counted: DataFrame, scorer: Scorer, settings: Settings) -> frozenset[str]:
    """Words near a stem that clean documents use, and toxic ones not far more often."""

    @F.pandas_udf("boolean")
    def near(words: pd.Series) -> pd.Series:
        scorer._hits()
        return pd.Series([bool(hit and hit[1]) for hit in map(scorer.match, words)], dtype="bool")

    used = counted.filter((F.col("n") >= settings.known_docs) & (F.col("p") < 4 * F.col("n")) & near("word"))
    return frozenset(r["word"] for r in used.select("word").collect())


def _closed(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of nested stems the shortest, drawn out while a longer one is nearly as frequent."""
    out: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if any(stem[:k] in out for k in range(1, len(stem))):
            continue
        while longer := [s for s in found if len(s) == len(stem) + 1 and s.startswith(stem) and found[s][0] >= 0.9 * found[stem][0]]:
            stem = longer[0]
        out[stem] = found[stem][1]
    return out


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> Scorer:
    """A scorer learned from the labelled documents that are not held out."""
    rows = staged(training_rows(docs, labels, settings, doc_id, text), "training")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Scorer({}, settings.window, constant=float(next(iter(counts), 0)))
    stems, words, counted = learn_stems(rows, settings)
    scorer = Scorer(stems, settings.window, words, least_odds=settings.least_odds, edit_odds=settings.edit_odds)
    scorer.known = known_spellings(counted, scorer, settings)
    scorer._lexicon = None

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.features(t) for t in texts], dtype=object)

    frame = staged(rows.select(features("text").alias("x"), F.col("toxic").cast("double").alias("label")), "features")
    model = LogisticRegression(maxIter=50, regParam=1e-4).fit(frame.select(array_to_vector("x").alias("features"), "label"))
    scorer.weights, scorer.intercept = [float(w) for w in model.coefficients], float(model.intercept)
    return scorer


def scored(scorer: Scorer) -> Callable[[Column], Column]:
    """The score of a text as a column function."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return score


def score_documents(docs: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), scored(scorer)(text_of(text)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, scorer: Scorer, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all columns of ``docs``."""
    return docs.filter(scored(scorer)(F.coalesce(docs[text].cast("string"), F.lit(""))) < threshold)
