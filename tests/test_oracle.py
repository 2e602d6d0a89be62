"""Every registered query against its DuckDB oracle on the smallest fixture
(the driver runs the same comparison at sf0.01)."""

import pytest

from conftest import SF001
from listenlab.plans.registry import QUERIES
from oracle_check import compare


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF001, sorted(QUERIES))


def test_every_key_has_an_oracle():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.oracle_sql())


def test_oracle_agreement(results):
    bad = {k: v for k, v in results.items()
           if v.get("oracle", 1) is not None and not (v["cols"] and v["hash"] and v["rows"][0] == v["rows"][1])}
    assert not bad, bad
