"""Registered queries against their SQL on the smallest tables."""

import pytest
from check import difference, open_tables
from tidemark.llm.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, df.collect(), duck, ORACLES[name]) is None


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
