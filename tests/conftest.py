from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tagloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, memory="4g", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
