"""Text cleaning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide the cleaned text.
HTML_TAG = r"<.*?>"
URL = r"http\S+"
NOT_A_LETTER = r"[^a-zA-Z]"
SPACES = r"\s+"

ORDERS = ("train", "infer")


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def strip_html(text: Column | str) -> Column:
    """Remove tags. A tag never spans lines, and neighbouring words are joined."""
    return F.regexp_replace(_column(text), HTML_TAG, "")


def strip_urls(text: Column | str) -> Column:
    """Remove every URL up to the next whitespace."""
    return F.regexp_replace(_column(text), URL, "")


def letters_only(text: Column | str) -> Column:
    """One space for every character that is not an ASCII letter."""
    return F.regexp_replace(_column(text), NOT_A_LETTER, " ")


def collapse_spaces(text: Column | str) -> Column:
    return F.regexp_replace(_column(text), SPACES, " ")


def clean_text(text: Column | str, order: str = "train") -> Column:
    """Lower-case ASCII words separated by single spaces.

    ``order="train"`` removes tags before URLs, ``order="infer"`` URLs before tags. The
    two differ where a tag holds a quoted link, so a model must see one order only.

    ``letters_only`` followed by ``collapse_spaces`` turns each run of other characters
    into one space; one pass with a repeated pattern does the same.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, not {order!r}")
    text = _column(text)
    bare = strip_urls(strip_html(text)) if order == "train" else strip_html(strip_urls(text))
    return F.trim(F.lower(F.regexp_replace(bare, f"{NOT_A_LETTER}+", " ")))
