"""Every registered query against its oracle, and what their plans must not contain."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from helpers import plan

import __spark_entry__ as contract
from fixtures.oracles import ORACLES
from fixtures.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(records: list[dict]) -> list[tuple]:
    def value(v):
        return float(v) if isinstance(v, Decimal) else v

    return sorted(
        (tuple(value(record[c]) for c in sorted(record)) for record in records), key=str
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = [dict(zip(columns, record)) for record in cursor.fetchall()]
    assert normal([r.asDict() for r in result.collect()]) == normal(expected)

    text = plan(result)
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
