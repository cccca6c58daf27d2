"""Driver contract: entry() smoke, every query against its DuckDB oracle (sf0.001)."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from situate.plans.queries import QUERIES
from situate.sources.tables import TABLES
from conftest import SF001

ROWS_ONLY: set[str] = set()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, datetime.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, datetime.date):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["strategy_id", "strategy_name", "target_condition"]


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) - set(E.oracle_sql()) == ROWS_ONLY


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in (x.asDict() for x in sdf.collect()))
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    orows = sorted(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in cur.fetchall())
    assert srows == orows
