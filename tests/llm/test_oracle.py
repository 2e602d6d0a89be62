"""The queries that SQL can express, on the smallest tables."""
import pytest

from conftest import SF001
from listenlab.llm.oracle import ORACLE
from listenlab.llm.queries import QUERIES
from oracle_check import compare


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_agrees(spark, name):
    r = compare(spark, SF001, [name])[name]
    assert r["cols"] and r["hash"] and r["rows"][0] == r["rows"][1], r
