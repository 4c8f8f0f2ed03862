"""Every query of the library's own operators against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from cuesheet.plans.queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for x in TABLES:
        connection.execute(f"CREATE VIEW {x} AS SELECT * FROM '{DATA}/{x}.parquet'")
    return connection


def rows(table, columns):
    out = []
    for row in table.select(columns).to_pylist():
        out.append(tuple(round(x, 9) if isinstance(x, float) else x for x in row.values()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(DATA)).toArrow()
    assert got.num_rows > 0
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name]).to_arrow_table()
        columns = sorted(want.column_names)
        assert sorted(got.column_names) == columns
        assert rows(got, columns) == rows(want, columns)
