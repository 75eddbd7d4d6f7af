"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    if not SF_DIR.exists():
        pytest.skip("test tables are absent")
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(SF_DIR))
    if name not in SQL:  # held against brute force by the tests of its own module
        assert frame.columns and frame.count() > 0
        return
    found = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck.execute(SQL[name])
    expected = comparable([d[0] for d in result.description], result.fetchall())
    assert found == expected


def test_entry_returns_rows(spark, duck):
    assert entry_point.entry(spark).count() > 0
