import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from starmart.session import get_or_create  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_or_create(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="2",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A DataFrame's rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [str(v) for v in r])

    return collect


@pytest.fixture
def plan():
    """A DataFrame's physical plan as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
