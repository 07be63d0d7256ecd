"""Tokens and stop words as Column expressions, equal to the MLlib stages of the model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words of Spark MLlib, in their published order.
STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
)


def tokenize(text: Column | str) -> Column:
    """Lower-case and split at each whitespace character.

    As in MLlib, empty tokens inside the text stay, those at its end go, an empty text
    has one empty token and a text of nothing but whitespace has none.
    """
    text = F.col(text) if isinstance(text, str) else text
    ended = F.regexp_replace(F.lower(text), r"(?<!\s)\s+\z", "")
    blank = (ended == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(ended, r"\s"))


def words(cleaned: Column | str) -> Column:
    """``tokenize`` for text from ``clean_text``, which needs no more than a split at spaces."""
    return F.split(F.col(cleaned) if isinstance(cleaned, str) else cleaned, " ")


def is_stop_word(token: Column | str) -> Column:
    token = F.col(token) if isinstance(token, str) else token
    return F.lower(token).isin(*STOP_WORDS)


def drop_stop_words(tokens: Column | str) -> Column:
    """The tokens that are not stop words, in order; empty tokens stay."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(tokens, lambda token: ~is_stop_word(token))
