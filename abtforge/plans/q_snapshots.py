"""Queries over snapshot dates: month-window panel and arrears as of every analysis date.

The snapshots are the orders (client, order date), the events their line items.  A third of all
orders belongs to one client, so every stage meets a hot key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround
from abtforge.operators import snapshots
from abtforge.plans import standins as T
from abtforge.plans.registry import register

GRACE_DAYS = 60
MONTHS = (3, 6)

_EVENTS_SQL = f"""
WITH o AS MATERIALIZED (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS num_doc, CAST(o_orderdate AS DATE) AS f_analisis FROM orders
), e AS MATERIALIZED (
  SELECT num_doc, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS pago, l_suppkey AS canal, CASE WHEN l_returnflag = 'N' THEN l_extendedprice END AS app,
         CAST(greatest(date_diff('day', f_analisis, CAST(l_shipdate AS DATE)) - {GRACE_DAYS}, 0) AS DOUBLE) AS dias_mora
  FROM lineitem JOIN o ON l_orderkey = o_orderkey
), s AS MATERIALIZED (SELECT DISTINCT num_doc, f_analisis FROM o)"""


def _window_sql(m: int, value: str) -> str:
    return f"""w{m} AS (
  SELECT s.num_doc, s.f_analisis, count(e.d) AS n_events_{m}m, count(DISTINCT e.d) AS active_days_{m}m, round(sum({value}), 4) AS sum_value_{m}m,
         avg({value}) AS avg_value_{m}m, round(stddev_samp({value}), 4) AS std_value_{m}m, max({value}) AS max_value_{m}m,
         count_if(COALESCE({value} > 0, false)) AS n_above_{m}m,
         CASE WHEN count(DISTINCT e.d) > 1 THEN regr_slope({value}, date_diff('day', s.f_analisis, e.d)) END AS raw_{m}m,
         round(sum(app), 4) AS sum_app_{m}m, count(DISTINCT canal) AS n_kinds_{m}m
  FROM s LEFT JOIN e ON e.num_doc = s.num_doc AND e.d <= s.f_analisis AND e.d > s.f_analisis - INTERVAL {m} MONTH GROUP BY 1, 2)"""


def _last_sql(value: str) -> str:
    return f"""t AS (
  SELECT s.num_doc, s.f_analisis, max(e.ts) AS ts FROM s LEFT JOIN e ON e.num_doc = s.num_doc AND e.d <= s.f_analisis GROUP BY 1, 2
), l AS (
  SELECT t.num_doc, t.f_analisis, max({value}) AS last_value, max(date_diff('day', CAST(t.ts AS DATE), t.f_analisis)) AS days_since
  FROM t LEFT JOIN e ON e.num_doc = t.num_doc AND e.ts = t.ts GROUP BY 1, 2
)"""


def _orders(spark, d):
    o = T.table(spark, d, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).cast("long").alias("num_doc"),
                    F.col("o_orderdate").cast("date").alias("f_analisis"))


def _payments(spark, d):
    late = F.datediff(F.col("l_shipdate").cast("date"), "f_analisis") - GRACE_DAYS
    return T.table(spark, d, "lineitem").join(_orders(spark, d), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "num_doc", F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("pago"), F.col("l_suppkey").alias("canal"), "l_returnflag",
        F.greatest(late, F.lit(0)).cast("double").alias("dias_mora"))


@register("snapshot_panel", oracle=f"""{_EVENTS_SQL}, {", ".join(_window_sql(m, "pago") for m in MONTHS)}, {_last_sql("pago")}
SELECT * EXCLUDE (raw_3m, raw_6m) REPLACE (round(avg_value_3m / max_value_3m, 6) AS avg_value_3m, round(avg_value_6m / max_value_6m, 6) AS avg_value_6m), round(sum_app_3m / NULLIF(sum_value_3m, 0), 6) AS ratio_digital_3m,
       round(raw_3m / NULLIF(avg_value_3m, 0), 9) AS trend_3m, round(raw_6m / NULLIF(avg_value_6m, 0), 9) AS trend_6m
FROM l JOIN w3 USING (num_doc, f_analisis) JOIN w6 USING (num_doc, f_analisis)""")
def snapshot_panel(spark, d):
    app = F.when(F.col("l_returnflag") == "N", F.col("pago"))
    out = snapshots.snapshot_panel(_payments(spark, d), _orders(spark, d), "num_doc", "ts", "pago", months=MONTHS, kind="canal", amounts={"app": app})
    for m in MONTHS:  # means to the maximum, slopes to the mean: quotients of cents alone end on a half at any number of digits
        out = out.withColumn(f"trend_{m}m", F.try_divide(f"trend_{m}m", f"avg_value_{m}m"))
        out = out.withColumn(f"avg_value_{m}m", F.try_divide(f"avg_value_{m}m", f"max_value_{m}m"))
    digits = {f"avg_value_{m}m": 6 for m in MONTHS} | {f"trend_{m}m": 9 for m in MONTHS}
    out = out.select(*[fround(c, digits.get(c, 4)).alias(c) if t == "double" and not c.startswith(("max", "last")) else F.col(c) for c, t in out.dtypes])
    return out.withColumn("ratio_digital_3m", fround(F.try_divide("sum_app_3m", "sum_value_3m"), 6)).withColumn("days_since", F.col("days_since").cast("long"))


@register("arrears_features", oracle=f"""{_EVENTS_SQL}, {", ".join(_window_sql(m, "dias_mora") for m in MONTHS)}, {_last_sql("dias_mora")}
SELECT num_doc, f_analisis, last_value AS dias_mora_actual, {", ".join(f'''round(avg_value_{m}m, 10) AS dias_mora_promedio_{m}m, max_value_{m}m AS max_dias_mora_{m}m,
  n_above_{m}m AS numero_eventos_mora_{m}m, round(raw_{m}m, 10) AS tendencia_mora_{m}m''' for m in MONTHS)}
FROM l JOIN w3 USING (num_doc, f_analisis) JOIN w6 USING (num_doc, f_analisis)""")
def arrears_features(spark, d):
    out = snapshots.arrears_features(_payments(spark, d), _orders(spark, d), "num_doc", "ts", "dias_mora", months=MONTHS)
    return out.select(*[fround(c, 10).alias(c) if c.startswith(("dias_mora_promedio", "tendencia")) else F.col(c) for c in out.columns])
