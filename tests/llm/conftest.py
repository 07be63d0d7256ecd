from __future__ import annotations

import pytest

from tagloom.llm.frames import ship

#: Extra columns with names that operators use inside.
CLASHING = "key digest kept score fp group row words pos root n n_words start end h node root u v value side _out_id span pieces path kind base added".split()
SCHEMA = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in dict.fromkeys(CLASHING))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` pairs, with extra columns of clashing names."""
    extra = ["x"] * (1 + len(dict.fromkeys(CLASHING)))
    return lambda rows: spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3)


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))

ODD = [
    (None, "no id has this text of some words"),
    (None, "no id has this text of some words"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "same text here for all of these"),
    (6, "same text here for all of these"),
    (6, "same text here for all of these"),
    (7, "x" * 100_000),
    (8, LONG),
    (9, "naïve café 北京 🙂 ▁ \x00 tail"),
]


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and very long texts, repeated rows."""
    return make(ODD).cache()


@pytest.fixture(scope="session")
def nothing(make):
    return make(ODD[:1]).filter("false")
