"""Parsing of ``<a><b>`` tag strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tag encoding.
BRACKETS = "<>"
SEPARATOR = " "


def parse_tags(tags: Column | str) -> Column:
    """``<a><b>`` to ``[a, b]``: ``<`` becomes a space and ``>`` goes away.

    An empty string gives one empty tag, null stays null.
    """
    column = F.col(tags) if isinstance(tags, str) else tags
    return F.split(F.trim(F.translate(column, BRACKETS, SEPARATOR)), SEPARATOR)


def last_tag(parsed: Column | str) -> Column:
    """The last element of a parsed tag array, null where there are no tags."""
    column = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.try_element_at(column, F.lit(-1))
