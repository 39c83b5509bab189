"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

    python tools/compare_oracles.py [sf_dir] [name ...]

Rows are compared order-insensitively after sorting columns by name; doubles are compared
after rounding to 6 places.  Prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, ".")

from abtforge.plans.registry import oracle_sql, queries  # noqa: E402
from abtforge.session import get_spark  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "float": "FLOAT", "smallint": "SMALLINT"}


def same_type(spark_t: str, duck_t: str) -> bool:
    return SPARK_TO_DUCK.get(spark_t, spark_t).upper() == duck_t.upper()


def rows_key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) if not isinstance(x, tuple) else (False, "t", str(x)) for x in r)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, ors = queries(), oracle_sql()
    ok = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            srows = df.collect()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {type(e).__name__}: {str(e)[:600]}")
            traceback.print_exc(limit=3)
            continue
        dt = time.time() - t0
        if name not in ors:
            print(f"ROWS-ONLY  {name}: {len(srows)} rows, {dt:.1f}s")
            continue
        try:
            rel = con.execute(ors[name])
            ocols = [d[0] for d in rel.description]
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {name}: {type(e).__name__}: {str(e)[:600]}")
            continue
        spark_types = dict(df.dtypes)
        duck_types = {d[0]: str(d[1]) for d in rel.description}
        tdiff = [(c, spark_types[c], duck_types.get(c)) for c in cols
                 if c in duck_types and not same_type(spark_types[c], duck_types[c])]
        if tdiff:
            print(f"TYPES      {name}: {tdiff}")
        if sorted(cols) != sorted(ocols):
            print(f"COLS       {name}: spark-only {sorted(set(cols)-set(ocols))} sql-only {sorted(set(ocols)-set(cols))}")
            continue
        order = sorted(cols)
        si = [cols.index(c) for c in order]
        oi = [ocols.index(c) for c in order]
        a = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=rows_key)
        b = sorted((tuple(norm(r[i]) for i in oi) for r in orows), key=rows_key)
        if a == b:
            ok += 1
            print(f"OK         {name}: {len(a)} rows, {dt:.1f}s")
        else:
            print(f"MISMATCH   {name}: spark {len(a)} rows, sql {len(b)} rows")
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                print("    spark:", x)
                print("    sql:  ", y)
    print(f"matched {ok}")


if __name__ == "__main__":
    main()
