"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as E
from sparkmine.sources.tables import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_registered_with_unique_oracle_names():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SMALL).count() >= 0


def test_entry(spark):
    assert E.entry(spark).count() > 0
