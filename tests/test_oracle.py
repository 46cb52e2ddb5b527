"""Every registered query against its DuckDB oracle on the smallest scale (full value equality)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from bizlens.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from bizlens.plans import queries as plans

    assert set(plans.QUERIES) == set(plans.ORACLE)
    assert set(plans.QUERIES) <= set(E.queries()) and set(plans.ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["ordem", "periodo"] and df.count() == 3


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, small_dir, duck, name):
    sdf = E.queries()[name](spark, small_dir)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c, t in sdf.dtypes:
        assert SPARK_TO_DUCK.get(t, t) == duck_types[c] or (t.startswith("decimal") and
                                                            duck_types[c].startswith("DECIMAL")), (c, t)
    assert _rows(sdf.columns, sdf.collect()) == _rows(rel.columns, rel.fetchall())
