"""Registered queries against their DuckDB statements.

By default the ones of the core models; LEDGERLAKE_ALL_QUERIES=1 runs every query
(``tools/check_oracles.py`` does the same with more detail and any data folder).
"""

import os

import pytest

import __spark_entry__ as entry
import catalog
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
CORE = ("B", "V", "G3", "G4", "G5", "G6", "G7", "G10", "G12", "J1", "W6", "S3", "S8", "P", "R5")
EVERY = os.environ.get("LEDGERLAKE_ALL_QUERIES") == "1"
NAMES = [n for n in catalog.QUERIES if EVERY or n.startswith(CORE)]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["month", "status", "charges", "amount_usd"] and got.count() > 0


def test_every_query_has_a_statement():
    assert all(item.sql for item in catalog.QUERIES.values())
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.oracle_sql())
