"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from epilake.queries import ORACLES, QUERIES

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def oracle():
    def run(sf: str, sql: str):
        connection = duckdb.connect()
        for path in (TESTDATA / sf).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(sql)
        return [column[0] for column in result.description], result.fetchall()

    return run


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, oracle, sf, key):
    result = contract.queries()[key](spark, str(TESTDATA / sf))
    ours = in_name_order(result.columns, [tuple(row) for row in result.collect()])
    theirs = in_name_order(*oracle(sf, contract.oracle_sql()[key]))
    assert ours[0] == theirs[0]
    assert sum(ours[1].values()) > 0
    assert ours[1] == theirs[1]


def test_every_query_of_the_lake_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert QUERIES.items() <= contract.queries().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
