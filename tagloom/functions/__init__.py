"""Column functions: text cleaning, tag parsing, tokens and batch stamps."""

from tagloom.functions.stamps import batch_stamp, current_batch, resolve_batch
from tagloom.functions.tags import last_tag, parse_tags
from tagloom.functions.text import clean_text, collapse_spaces, letters_only, strip_html, strip_urls
from tagloom.functions.tokens import STOP_WORDS, drop_stop_words, is_stop_word, tokenize, words

__all__ = [
    "STOP_WORDS",
    "batch_stamp",
    "clean_text",
    "collapse_spaces",
    "current_batch",
    "drop_stop_words",
    "is_stop_word",
    "last_tag",
    "letters_only",
    "parse_tags",
    "resolve_batch",
    "strip_html",
    "strip_urls",
    "tokenize",
    "words",
]
