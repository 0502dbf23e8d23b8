"""Every registered query with SQL gives the rows DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b)) or (a != a and b != b)
    return a == b


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    theirs = [d[0] for d in result.description]
    assert sorted(theirs) == columns
    at = [theirs.index(c) for c in columns]

    def key(row):
        return tuple((v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)

    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    expected = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=key)
    assert len(ours) == len(expected)
    wrong = [(a, b) for a, b in zip(ours, expected) if not all(map(same, a, b))]
    assert not wrong, wrong[:3]


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["n"] > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
