import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratingloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture
def executed_plan():
    """The physical plan that ran, without the initial plan."""

    def run(df):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return text.split("+- == Initial Plan ==")[0]

    return run
