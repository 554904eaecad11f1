"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda x: repr(round(x, 6)) if isinstance(x, float) else repr(x)
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


#: The training-data queries, where installed, have tests of their own.
OWN = [name for name in entry.queries() if name not in entry.training_data()[0]]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, SF)
    want = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), columns)


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
