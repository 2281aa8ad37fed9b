"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver entry points."""

import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry_mod
from runlens.plans.catalog import ORACLE, QUERIES
from runlens.plans.compare import compare, duckdb_conn
from runlens.plans.oracle_views import with_views
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert key in ORACLE, "a query without an oracle shows nothing"
    sql = with_views(ORACLE[key])
    r = compare(df, con, sql)
    assert r["ok"], r
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, (_duck_family(t) for t in rel.types)))
    spark_types = {f.name: _spark_family(f.dataType) for f in df.schema.fields}
    assert spark_types == duck


def _spark_family(t):
    if isinstance(t, T.IntegralType):
        return t.simpleString().replace("integer", "int")
    if isinstance(t, T.FractionalType):
        return "float"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "ts"
    return {T.StringType: "str", T.BooleanType: "bool"}.get(type(t), t.simpleString())


def _duck_family(t):
    t = str(t).upper()
    return {"TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "float",
            "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool", "TIMESTAMP": "ts"}.get(t, t)


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.queries()) >= 100
