import pytest

from checks.compare import compare, connect
from meterqa.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        ok, note = compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF)
        assert ok, note
    elif name == "op12_embedding_whitening":
        assert QUERIES[name](spark, SF).count() == 32 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    else:
        assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
