"""Profile of appended data: the first half of the years is profiled, then the rest is added."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround
from abtforge.operators import profile_state as P
from abtforge.plans import standins as T
from abtforge.plans.registry import register
from abtforge.session import work_dir

_COLS = ["o_totalprice", "neto", "o_custkey"]
_G = (1 + P.ACCURACY) / (1 - P.ACCURACY)


def _bucket(v: str) -> str:
    return f"CASE WHEN {v} = 0 THEN 0 ELSE sign({v}) * (ceil(ln(abs({v})) / {math.log(_G)!r}) + 1000000) END"


def _column_sql(c: str) -> str:
    pick = lambda q: f"(SELECT v FROM r WHERE k = floor({q} * (SELECT count(*) - 1 FROM r)))"
    value = lambda v: f"CASE WHEN {v} = 0 THEN 0 ELSE sign({v}) * pow({_G!r}, ceil(ln(abs({v})) / {math.log(_G)!r})) * {2 / (_G + 1)!r} END"
    clipped = lambda q: f"round(greatest(least({value(pick(q))}, (SELECT max(v) FROM r WHERE b = (SELECT b FROM r WHERE k = floor({q} * (SELECT count(*) - 1 FROM r))))), " \
        f"(SELECT min(v) FROM r WHERE b = (SELECT b FROM r WHERE k = floor({q} * (SELECT count(*) - 1 FROM r))))) / (SELECT max(v) FROM r), 6)"  # noqa: E731
    return f"""SELECT * FROM (WITH r AS MATERIALIZED (SELECT v, {_bucket("v")} AS b, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT CAST({c} AS DOUBLE) AS v FROM o WHERE {c} IS NOT NULL))
SELECT '{c}' AS column_name, (SELECT count(*) FROM o) AS n_rows, (SELECT count_if({c} IS NULL) FROM o) AS n_unknown, count_if(v = 0) AS n_zero, round(min(v), 6) AS min, round(max(v), 6) AS max,
       round(avg(v) / max(v), 6) AS avg_to_max, round(stddev_samp(v) / max(v), 6) AS std_to_max, {clipped(0.5)} AS p50_to_max, {clipped(0.95)} AS p95_to_max FROM r)"""


@register("profile_appended", oracle="WITH o AS MATERIALIZED (SELECT o_totalprice, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 0 ELSE 150000 - o_totalprice END AS neto, "
          "o_custkey FROM orders)\n" + "\nUNION ALL\n".join(map(_column_sql, _COLS)))
def profile_appended(spark, d):
    o = T.table(spark, d, "orders").withColumn("neto", F.when(F.col("o_orderkey") % 9 == 0, None).when(F.col("o_orderkey") % 10 == 0, 0.0).otherwise(150000 - F.col("o_totalprice")))
    o = o.withColumn("anio", F.year("o_orderdate"))
    path = work_dir(spark, "profile_states")
    P.append_parts(o.where("anio < 1998"), _COLS, "anio", path)
    P.append_parts(o.where("anio >= 1998"), _COLS, "anio", path)
    out = P.summary(P.stored_state(spark, path))
    return out.select("column_name", "n_rows", "n_unknown", "n_zero", fround("min", 6).alias("min"), fround("max", 6).alias("max"),
                      *[fround(F.col(a) / F.col("max"), 6).alias(f"{a}_to_max") for a in ("avg", "std", "p50", "p95")])
