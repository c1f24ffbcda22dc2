import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from visitloom.schemas import USER_INFO, USER_VISIT_ACTION  # noqa: E402
from visitloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, **{"spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_actions(spark):
    """Actions from dicts; what a dict leaves out is NULL."""

    def build(*rows):
        names = USER_VISIT_ACTION.names
        filled = []
        for row in rows:
            row = {"date": (row.get("action_time") or "2024-01-10")[:10], "user_id": 1, **row}
            filled.append(tuple(row.get(n) for n in names))
        return spark.createDataFrame(filled, USER_VISIT_ACTION)

    return build


@pytest.fixture
def make_users(spark):
    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in USER_INFO.names) for r in rows], USER_INFO)

    return build


def final_plan(df):
    """The physical plan after AQE."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
