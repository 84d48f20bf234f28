"""Every registered query against its DuckDB oracle on sf0.001 (the t2 gate in small)."""
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from drivelake.plans.written import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        if isinstance(v, (list, tuple)):
            return str([n(x) for x in v])
        return None if v is None else str(v)
    out = sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t))
    return [cols[i] for i in order], out


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "annualized_failure_rate_pct" in df.columns


def test_oracle_covers_all_queries():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


SPARK_T = {"string": "str", "bigint": "i64", "int": "i32", "double": "f64", "boolean": "bool", "date": "date",
           "timestamp": "ts", "timestamp_ntz": "ts", "array<string>": "list<str>"}
DUCK_T = {"VARCHAR": "str", "BIGINT": "i64", "INTEGER": "i32", "DOUBLE": "f64", "BOOLEAN": "bool", "DATE": "date",
          "TIMESTAMP": "ts", "VARCHAR[]": "list<str>"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s = _norm(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    d = _norm([x[0] for x in res.description], res.fetchall())
    assert s[0] == d[0]
    assert s[1] == d[1]
    rel = con.sql(ORACLE[name])
    duck_types = {c: DUCK_T.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_T.get(t, t) for c, t in df.dtypes} == duck_types
