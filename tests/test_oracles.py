"""Every registered query with an oracle equals its DuckDB SQL on the smallest data set."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _names():
    from abtforge.plans.registry import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from abtforge.plans.registry import oracle_sql, queries

    df = queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, df.collect()
    rel = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=_key)
    b = sorted((tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows), key=_key)
    assert a == b
