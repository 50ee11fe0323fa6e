"""Every query of the catalogue against its SQL in DuckDB, and the driver contract."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(float(v), 9) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted(repr(tuple(value(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    found = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), list(found.columns))


@pytest.mark.parametrize("name", [q for q in sorted(entry.queries()) if q not in entry.oracle_sql() and not q.startswith(("op", "pipeline"))])
def test_query_runs(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
