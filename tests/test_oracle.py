"""Every registered query against its SQL."""

import pytest

duckdb = pytest.importorskip("duckdb")

from checks.cases import QUERIES  # noqa: E402
from checks.compare import compare, connect  # noqa: E402
from checks.oracles import ORACLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
