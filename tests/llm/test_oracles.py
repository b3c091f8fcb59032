"""Every query with SQL against DuckDB; every query registered and run."""

from __future__ import annotations

import math

import duckdb
import pytest

from adlytics.llm.oracles import ORACLES
from adlytics.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def cells(rows):
    plain = lambda x: round(x, 6) if isinstance(x, float) and math.isfinite(x) else x
    return sorted((tuple(map(plain, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    con.execute(f"CREATE TABLE want AS {ORACLES[name]}")
    columns = [r[0] for r in con.execute("DESCRIBE want").fetchall()]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    want = con.execute(f"SELECT {', '.join(sorted(columns))} FROM want").fetchall()
    assert cells(got.select(*sorted(columns)).collect()) == cells(want)


def test_entry_registers_every_operator():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
