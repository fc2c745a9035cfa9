"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from marketmill import plans
from oracle import compare, connect

QUERIES = plans.load().QUERIES
SQL = plans.load().ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    message = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
    # at the smallest scale a selective query may be empty on both sides
    assert message in (None, "no rows on both sides")


def test_entry(spark):
    assert entry.entry(spark).columns == ["symbol", "price", "change", "changesPercentage", "volume"]


def test_every_operator_is_registered():
    sizes = {"A": 12, "B": 22, "C": 14, "D": 21, "E": 10, "F": 16, "G": 6, "H": 5, "I": 9, "J": 9, "K": 6, "L": 8,
             "M": 4, "N": 9, "P": 4, "T": 5}
    known = {n.split("_")[0] for n in QUERIES}
    assert known == {f"{letter}{i}" for letter, n in sizes.items() for i in range(1, n + 1)}
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
