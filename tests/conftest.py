import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterqa import schema  # noqa: E402
from meterqa.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def observations(spark):
    """Build an observations table from (site, measurement, time, value) rows."""

    def build(rows):
        typed = [(s, m, ts(t) if isinstance(t, str) else t, v) for s, m, t, v in rows]
        return spark.createDataFrame(typed, schema.OBSERVATIONS)

    return build


@pytest.fixture(scope="session")
def catalog(spark):
    def build(rows):
        typed = [
            (s, m, ts(a) if isinstance(a, str) else a, ts(b) if isinstance(b, str) else b)
            for s, m, a, b in rows
        ]
        return spark.createDataFrame(typed, schema.CATALOG)

    return build


def rows(df, *order):
    """Rows as tuples, in a fixed order."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def final_plan(df) -> str:
    """The adaptive plan after it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
