"""Queries that choose columns of the wide stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround
from abtforge.operators import selection
from abtforge.operators.catalog import is_candidate
from abtforge.plans import sql_standins as S
from abtforge.plans import standins as T
from abtforge.plans.registry import register

ALIKE, LEAST, MOST = 0.9, 70, 80


def candidate_names() -> list[str]:
    """The names that the rules keep: totals, base totals per channel, statistics of the kept windows."""
    return [n for n in T.wide_names() if "smmlv" not in n.split("_")]


_CHOICE_SQL = "WITH RECURSIVE " + S.canales_wide() + f""",
u AS MATERIALIZED (
  SELECT num_doc, c, CAST(v AS DOUBLE) AS v FROM (UNPIVOT (SELECT num_doc, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in candidate_names())} FROM canales_wide)
  ON COLUMNS(* EXCLUDE (num_doc)) INTO NAME c VALUE v)
), st AS MATERIALIZED (
  SELECT c, count(*) AS n, avg(CASE WHEN v <> 0 THEN 1.0 ELSE 0.0 END) AS rate, var_samp(v) AS variance FROM u GROUP BY c
), ord AS MATERIALIZED (
  SELECT c, row_number() OVER (ORDER BY round(rate, 9) DESC, c) AS k FROM st WHERE rate >= 0.01 AND variance > 0
), w AS MATERIALIZED (SELECT num_doc, k, v FROM u JOIN ord ON u.c = ord.c),
pr AS MATERIALIZED (
  SELECT ka, kb FROM (
    SELECT a.k AS ka, b.k AS kb, count(*) AS n, covar_samp(a.v, b.v) AS cv, stddev_samp(a.v) AS sa, stddev_samp(b.v) AS sb, avg(abs(a.v)) AS ma, avg(abs(b.v)) AS mb
    FROM w a JOIN w b ON a.num_doc = b.num_doc AND a.k > b.k GROUP BY 1, 2)
  WHERE n >= 30 AND sa > 1e-9 * ma AND sb > 1e-9 * mb AND abs(cv) >= {ALIKE} * sa * sb
), nb AS MATERIALIZED (SELECT ka, list(kb ORDER BY kb) AS l FROM pr GROUP BY ka),
g AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS kept
  UNION ALL
  SELECT g.k + 1, CASE WHEN len(kept) >= {MOST} OR nb.l IS NOT NULL AND len(list_intersect(nb.l, kept)) > 0 THEN kept ELSE list_append(kept, g.k + 1) END
  FROM g LEFT JOIN nb ON nb.ka = g.k + 1 WHERE g.k < (SELECT count(*) FROM ord)
), f AS (SELECT kept FROM g ORDER BY k DESC LIMIT 1),
x AS (
  SELECT ord.c, ord.k, list_contains(f.kept, ord.k) AS chosen, list_min(list_intersect(coalesce(nb.l, []), f.kept)) AS near,
         len(f.kept) >= {MOST} AND ord.k > list_max(f.kept) AS past, len(f.kept) AS n_kept FROM ord LEFT JOIN nb ON nb.ka = ord.k, f
), y AS (
  SELECT *, NOT chosen AND NOT past AND sum(CASE WHEN NOT chosen AND NOT past THEN 1 ELSE 0 END) OVER (ORDER BY k) <= {min(LEAST, MOST)} - n_kept AS filled FROM x
)
SELECT CAST(CASE WHEN chosen OR filled THEN row_number() OVER (PARTITION BY chosen OR filled ORDER BY y.k) END AS INTEGER) AS place, st.c AS column_name, st.n,
       round(st.rate, 9) AS nonzero_rate, round(st.rate, 9) AS score,
       CASE WHEN y.c IS NULL THEN 'screened' WHEN chosen OR filled THEN 'chosen' WHEN past THEN 'beyond' ELSE 'redundant' END AS verdict,
       CASE WHEN NOT (chosen OR filled OR past) THEN o.c END AS "like"
FROM st LEFT JOIN y ON y.c = st.c LEFT JOIN ord o ON o.k = y.near
UNION ALL SELECT NULL, n, 0, 0.0, 0.0, 'screened', NULL FROM (VALUES {", ".join(f"('{c}')" for c in candidate_names())}) a(n) WHERE n NOT IN (SELECT c FROM st)"""


@register("column_choice", oracle=_CHOICE_SQL)
def column_choice(spark, d):
    names = spark.createDataFrame([(n,) for n in T.wide_names()], "col string").where(is_candidate())
    cols = [r["col"] for r in names.collect()]
    out = selection.choose_columns(T.canales_wide(spark, d), cols, alike=ALIKE, least=LEAST, most=MOST)
    return out.select("place", "column_name", "n", fround("nonzero_rate", 9).alias("nonzero_rate"), "score", "verdict", "like")


@register("pair_correlations", oracle=S.with_(S.ORDER_LINES) + """,
u AS MATERIALIZED (UNPIVOT (SELECT obl17, CAST(tq_sum_qty AS DOUBLE) AS tq_sum_qty, CAST(tq_avg_price AS DOUBLE) AS tq_avg_price, CAST(tq_std_price AS DOUBLE) AS tq_std_price,
    CAST(mo_n_returned AS DOUBLE) AS mo_n_returned, CAST(mo_avg_disc AS DOUBLE) AS mo_avg_disc, CAST(mo_dias_mora AS DOUBLE) AS mo_dias_mora FROM order_lines)
  ON COLUMNS(* EXCLUDE (obl17)) INTO NAME c VALUE v),
p(c, k) AS (VALUES ('tq_sum_qty', 0), ('tq_avg_price', 1), ('tq_std_price', 2), ('mo_n_returned', 3), ('mo_avg_disc', 4), ('mo_dias_mora', 5))
SELECT a.c AS column_a, b.c AS column_b, count(*) AS n, round(covar_samp(a.v, b.v) / (stddev_samp(a.v) * stddev_samp(b.v)), 6) AS corr
FROM u a JOIN p pa ON pa.c = a.c JOIN u b ON a.obl17 = b.obl17 JOIN p pb ON pb.c = b.c WHERE pa.k < pb.k GROUP BY 1, 2""")
def pair_correlations(spark, d):
    cols = ["tq_sum_qty", "tq_avg_price", "tq_std_price", "mo_n_returned", "mo_avg_disc", "mo_dias_mora"]
    out = selection.correlation_pairs(T.order_lines(spark, d), cols, block=4)
    return out.withColumn("corr", fround("corr", 6))
