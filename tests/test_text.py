"""Cleaning, tag parsing, tokens and stamps on small fixed inputs."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tagloom.functions import (
    STOP_WORDS,
    batch_stamp,
    clean_text,
    collapse_spaces,
    drop_stop_words,
    last_tag,
    letters_only,
    parse_tags,
    resolve_batch,
    strip_html,
    strip_urls,
    tokenize,
    words,
)


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [row[0] for row in rows.orderBy("i").select(column).collect()]


LINKED = '<p>See <a href="http://x.com/a">link text</a> now</p>'


@pytest.mark.parametrize(
    ("order", "text", "expected"),
    [
        ("train", LINKED, "see link text now"),
        ("infer", LINKED, "see now"),
        ("train", 'a <pre\nclass="q">b</pre> c', "a pre class q b c"),
        ("train", "Ünïcode É naïve İ", "n code na ve"),
        ("train", "<p>http://x.y</p><p>after</p>", ""),
        ("infer", "<p>http://x.y</p><p>after</p>", ""),
        ("train", "", ""),
        ("train", None, None),
        ("train", "no<br>space", "nospace"),
    ],
)
def test_clean_text(spark, order, text, expected):
    assert values(spark, clean_text("v", order), [text]) == [expected]


def test_clean_text_rejects_an_unknown_order():
    with pytest.raises(ValueError):
        clean_text("v", "other")


def _nasty_texts(n=400):
    rng = random.Random(7)
    pieces = ["<p>", "</a>", "<", ">", "http://a.b/c", "https", " ", "\n", "\t", "A", "ß", "İ", "9", "-", '"', "word", "漢", "😀"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("order", ["train", "infer"])
def test_one_pass_equals_the_single_steps(spark, order):
    texts = _nasty_texts()
    steps = strip_urls(strip_html("v")) if order == "train" else strip_html(strip_urls("v"))
    single = F.trim(F.lower(collapse_spaces(letters_only(steps))))
    assert values(spark, clean_text("v", order), texts) == values(spark, single, texts)


def test_clean_text_equals_python(spark):
    def clean(text):
        text = re.sub(r"http[^ \t\n\x0b\f\r]+", "", re.sub(r"<.*?>", "", text))
        return re.sub("[^a-zA-Z]+", " ", text).lower().strip(" ")

    texts = _nasty_texts()
    assert values(spark, clean_text("v"), texts) == [clean(text) for text in texts]


@pytest.mark.parametrize(
    ("text", "tags", "last"),
    [
        ("<a><b-c><c#>", ["a", "b-c", "c#"], "c#"),
        ("<a> <b>", ["a", "", "b"], "b"),
        ("", [""], ""),
        (None, None, None),
    ],
)
def test_parse_tags(spark, text, tags, last):
    assert values(spark, parse_tags("v"), [text]) == [tags]
    assert values(spark, last_tag(parse_tags("v")), [text]) == [last]


def test_tokens_equal_the_library_stages(spark):
    texts = ["", " ", "  ", "The  Cat i am", " lead", "trail  ", "Don't STOP", "a\tb\nc\n", *_nasty_texts()]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string")
    staged = StopWordsRemover(inputCol="t", outputCol="f").transform(
        Tokenizer(inputCol="v", outputCol="t").transform(rows)
    )
    both = staged.select("v", "t", "f", tokenize("v").alias("t2"), drop_stop_words(tokenize("v")).alias("f2")).collect()
    # Lower-casing of one Turkish letter differs between the two; cleaned text has none.
    different = [row for row in both if (row.t != row.t2 or row.f != row.f2) and "İ" not in row.v]
    assert different == []


def test_words_equal_tokens_on_cleaned_text(spark):
    cleaned = values(spark, clean_text("v"), _nasty_texts())
    assert values(spark, words("v"), cleaned) == values(spark, tokenize("v"), cleaned)


def test_stop_words_are_those_of_the_library(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize("batch", ["2023_10_22_02", datetime.datetime(2023, 10, 22, 2, 41, 7)])
def test_stamps_are_cut_to_the_hour(spark, batch):
    stamp = spark.range(1).select(batch_stamp(batch).cast("string")).first()[0]
    assert stamp == "2023-10-22 02:00:00"
    assert resolve_batch(spark, batch) == "2023_10_22_02"


def test_default_stamp_is_the_running_hour(spark):
    assert re.fullmatch(r"\d{4}_\d\d_\d\d_\d\d", resolve_batch(spark))
