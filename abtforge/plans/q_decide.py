"""Registered queries: scores to decisions, summaries, lookups, top-k, documented features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround
from abtforge.operators import decide, features, scoring
from abtforge.plans import sql_standins as S
from abtforge.plans import standins as T
from abtforge.plans.registry import register
from abtforge.session import work_dir

THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LOOKUP_OBLIGATION = "7"


def r6(c):
    return fround(c, 6)


def decision_frame(spark, d, with_timestamp=False):
    return decide.decisions(T.scores(spark, d), with_timestamp=with_timestamp)


DECISIONS_SQL = S.with_(S.SCORES) + """,
dec AS (SELECT *, CASE WHEN score = 1.0 THEN 0 ELSE 1 END AS gestion_cobro,
               CASE WHEN score = 1.0 THEN 'NO_ASIGNAR_GESTION' ELSE 'ASIGNAR_GESTION' END AS decision_label,
               'v1_score_eq_1' AS policy_version, 1.0::DOUBLE AS threshold_used FROM scores)
"""
DEC_COLS = ("num_doc_key, obl17_key, f_analisis, split_group, score, target_final, gestion_cobro, decision_label, "
            "policy_version, threshold_used")


# --------------------------------------------------------------------------- P33, P37
@register("decision_table", oracle=DECISIONS_SQL + f"SELECT {DEC_COLS} FROM dec")
def decision_table(spark, d):
    return decision_frame(spark, d).select(*[c.strip() for c in DEC_COLS.split(",")])


# --------------------------------------------------------------------------- A3, M15
@register("decision_counts", oracle=DECISIONS_SQL + "SELECT decision_label, count(*) AS n FROM dec GROUP BY decision_label")
def decision_counts(spark, d):
    return decide.decision_counts(decision_frame(spark, d))


# --------------------------------------------------------------------------- A4, A5
@register("score_summary", oracle=S.with_(S.SCORES) + """
SELECT count(*) AS n, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, round(avg(score), 6) AS avg_score,
       count_if(score = 1.0) AS n_score_1, count_if(score = 0.0) AS n_score_0 FROM scores""")
def score_summary(spark, d):
    out = decide.score_summary(T.scores(spark, d))
    return out.select("n", *[r6(F.col(c)).alias(c) for c in ("min_score", "max_score", "avg_score")], "n_score_1", "n_score_0")


# --------------------------------------------------------------------------- A6
@register("score_quantiles", oracle=S.with_(S.SCORES) + """
SELECT round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.9), 6) AS p90,
       round(quantile_cont(score, 0.95), 6) AS p95, round(quantile_cont(score, 0.99), 6) AS p99 FROM scores""")
def score_quantiles(spark, d):
    out = decide.score_quantiles(T.scores(spark, d))
    return out.select(*[r6(F.col(c)).alias(c) for c in out.columns])


# --------------------------------------------------------------------------- P34
def stored_decisions(spark, d) -> dict:
    """Decision table bucketed by client with its index by obligation, as the scoring job leaves them."""
    path = work_dir(spark, "lookup_decisions")
    return scoring.refresh(spark, T.scores(spark, d), decisions_table=f"decisions_{uuid.uuid4().hex[:8]}", database="abt_lookups", table_path=path)


def _columns(df):
    return df.select(*[c.strip() for c in DEC_COLS.split(",")])


@register("lookup_detail", oracle=DECISIONS_SQL + f"""
SELECT {DEC_COLS} FROM dec
WHERE obl17_key = '{LOOKUP_OBLIGATION}'
  AND num_doc_key = (SELECT min(num_doc_key) FROM dec WHERE obl17_key = '{LOOKUP_OBLIGATION}')
ORDER BY f_analisis DESC NULLS LAST LIMIT 1""")
def lookup_detail(spark, d):
    out = stored_decisions(spark, d)
    client = decide.clients_of(out["index"], LOOKUP_OBLIGATION)[0]
    return _columns(decide.lookup_detail(out["decisions"], client, LOOKUP_OBLIGATION))


# --------------------------------------------------------------------------- P35, P36
@register("lookup_client_topn", oracle=DECISIONS_SQL + f"""
SELECT {DEC_COLS} FROM dec
WHERE num_doc_key = (SELECT min(num_doc_key) FROM dec WHERE obl17_key = '{LOOKUP_OBLIGATION}')
ORDER BY score DESC, obl17_key, f_analisis DESC LIMIT 2000""")
def lookup_client_topn(spark, d):
    out = stored_decisions(spark, d)
    client = decide.clients_of(out["index"], LOOKUP_OBLIGATION)[0]
    return _columns(decide.lookup_by_client(out["decisions"], client, 2000))


@register("lookup_obligation", oracle=DECISIONS_SQL + f"""
SELECT {DEC_COLS} FROM dec WHERE obl17_key = '{LOOKUP_OBLIGATION}' ORDER BY f_analisis DESC, num_doc_key LIMIT 200""")
def lookup_obligation(spark, d):
    out = stored_decisions(spark, d)
    return _columns(decide.lookup_by_obligation(out["decisions"], LOOKUP_OBLIGATION, 200, out["index"]))


@register("obligation_index", oracle=S.with_(S.SCORES) + "SELECT DISTINCT obl17_key, num_doc_key FROM scores WHERE obl17_key IS NOT NULL")
def obligation_index(spark, d):
    return stored_decisions(spark, d)["index"]


# --------------------------------------------------------------------------- K1, K3
@register("topk_scores", oracle=S.with_(S.SCORES) + """
SELECT num_doc, obl17_key, split_group, score FROM scores ORDER BY score DESC, num_doc, obl17_key LIMIT 200""")
def topk_scores(spark, d):
    return decide.top_scores(T.scores(spark, d), 200).select("num_doc", "obl17_key", "split_group", "score")


# --------------------------------------------------------------------------- K2
@register("topk_oot", oracle=S.with_(S.SCORES) + """
SELECT num_doc, obl17_key, split_group, score FROM scores WHERE split_group = 'OOT'
ORDER BY score DESC, num_doc, obl17_key LIMIT 10""")
def topk_oot(spark, d):
    return decide.top_scores(T.scores(spark, d), 10, split="OOT").select("num_doc", "obl17_key", "split_group", "score")


# --------------------------------------------------------------------------- X1, X12
def _policy_frame(spark, d):
    ol = T.with_keys(T.order_lines(spark, d)).select("obl17_key", "mo_dias_mora")
    return T.scores(spark, d).join(ol, on="obl17_key", how="left")


@register("threshold_policy", oracle=S.with_(S.SCORES, S.ORDER_LINES) + """,
p AS (SELECT s.*, o.mo_dias_mora FROM scores s LEFT JOIN order_lines o ON s.obl17_key = CAST(CAST(o.obl17 AS DECIMAL(38,0)) AS VARCHAR)),
t(threshold) AS (VALUES """ + ", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS) + """)
SELECT t.threshold,
       count_if(p.mo_dias_mora BETWEEN 1 AND 30 AND p.score >= t.threshold) AS n_spared,
       round(count_if(p.mo_dias_mora BETWEEN 1 AND 30 AND p.score >= t.threshold) / count(*), 6) AS share_spared,
       round(count_if(p.mo_dias_mora BETWEEN 1 AND 30 AND p.score >= t.threshold AND p.target_final = 0)
             / NULLIF(count_if(p.mo_dias_mora BETWEEN 1 AND 30 AND p.score >= t.threshold), 0), 6) AS risk
FROM p, t GROUP BY t.threshold""")
def threshold_policy(spark, d):
    out = features.threshold_grid(_policy_frame(spark, d), THRESHOLDS, label="target_final", arrears="mo_dias_mora")
    return out.select("threshold", "n_spared", r6(F.col("share_spared")).alias("share_spared"), r6(F.col("risk")).alias("risk"))


@register("policy_decisions", oracle=S.with_(S.SCORES, S.ORDER_LINES) + """,
p AS (SELECT s.*, o.mo_dias_mora FROM scores s LEFT JOIN order_lines o ON s.obl17_key = CAST(CAST(o.obl17 AS DECIMAL(38,0)) AS VARCHAR))
SELECT CASE WHEN COALESCE(score >= 0.8 AND mo_dias_mora BETWEEN 1 AND 30, false) THEN 'NO_ASIGNAR_GESTION' ELSE 'ASIGNAR_GESTION' END
       AS decision_label, count(*) AS n FROM p GROUP BY 1""")
def policy_decisions(spark, d):
    dec = decide.decisions(_policy_frame(spark, d), policy="threshold", threshold=0.8, policy_version="v2_threshold",
                           arrears_col="mo_dias_mora", with_timestamp=False)
    return decide.decision_counts(dec)


# --------------------------------------------------------------------------- X3-X7
def _trailing_sql() -> str:
    parts = []
    for w in (6, 12):
        frame = f"PARTITION BY user_id ORDER BY dn RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW"
        parts.append(f"""
       count(*) OVER ({frame}) AS active_days_{w}d,
       CAST(sum(cnt) OVER ({frame}) AS BIGINT) AS n_events_{w}d,
       round(sum(s) OVER ({frame}), 4) AS sum_value_{w}d,
       round(sum(s) OVER ({frame}) / sum(cnt) OVER ({frame}), 4) AS avg_value_{w}d,
       round(max(mx) OVER ({frame}), 4) AS max_value_{w}d,
       CASE WHEN count(*) OVER ({frame}) > 1 THEN round(regr_slope(s, dn) OVER ({frame}), 4) END AS trend_value_{w}d,
       round(COALESCE(sum(COALESCE(dig, 0)) OVER ({frame}) / NULLIF(sum(s) OVER ({frame}), 0), 0), 4) AS share_digital_{w}d""")
    kinds = []
    for w in (6, 12):
        # from the raw rows of the window, not from daily sums
        kinds.append(f"round(stddev_samp(value) OVER (PARTITION BY user_id ORDER BY dn RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 4) AS std_value_{w}d")
        kinds.append(f"count(DISTINCT event_type) OVER (PARTITION BY user_id ORDER BY dn RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS n_kinds_{w}d")
    dig = ", ".join(f"'{k}'" for k in T.EVENT_FAMILIES["digital"])
    return f"""
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS dn,
                      count(*) AS cnt, sum(value) AS s, max(value) AS mx,
                      sum(CASE WHEN event_type IN ({dig}) THEN value END) AS dig
               FROM events GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT user_id, day, n_kinds_6d, n_kinds_12d, std_value_6d, std_value_12d FROM (
        SELECT user_id, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS dn, event_type, value,
               {", ".join(kinds)} FROM events)),
f AS (SELECT user_id, day, {",".join(parts)} FROM daily)
SELECT f.*, k.n_kinds_6d, k.n_kinds_12d, k.std_value_6d, k.std_value_12d FROM f JOIN k USING (user_id, day)"""


@register("trailing_features", oracle=_trailing_sql())
def trailing_features(spark, d):
    out = features.trailing_features(T.table(spark, d, "events"), digital_kinds=T.EVENT_FAMILIES["digital"])
    return out.select(*[fround(c, 4).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


# --------------------------------------------------------------------------- X2
@register("label_rule", oracle="""
SELECT l_orderkey, count(*) AS n_payments, count_if(l_linestatus = 'F') AS n_debit,
       round(avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END), 6) AS recurrence,
       CASE WHEN count_if(l_linestatus = 'F') = count(*) AND avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END) >= 0.4
            THEN 1 ELSE 0 END AS var_rta
FROM lineitem GROUP BY l_orderkey""")
def label_rule(spark, d):
    li = T.table(spark, d, "lineitem").withColumn("_rec", F.col("l_returnflag") == "N")
    out = features.payment_label(li, ["l_orderkey"], "l_linestatus", "F", "_rec")
    return out.withColumn("recurrence", r6(F.col("recurrence")))


# --------------------------------------------------------------------------- X10
_SCREEN_COLS = ["tq_sum_qty", "tq_avg_price", "mo_n_returned", "mo_n_open", "mo_avg_disc", "mo_dias_mora"]


@register("feature_screen", oracle=S.with_(S.ORDER_LINES) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c} <> 0 THEN 1.0 ELSE 0.0 END END), 6) AS nonzero_rate, "
    f"round(var_samp({c}), 4) AS variance, COALESCE(avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c} <> 0 THEN 1.0 ELSE 0.0 END END), 0) >= 0.01 "
    f"AND COALESCE(var_samp({c}), 0) > 0 AS keep FROM order_lines" for c in _SCREEN_COLS))
def feature_screen(spark, d):
    out = features.feature_screen(T.order_lines(spark, d), _SCREEN_COLS)
    return out.select("column_name", r6(F.col("nonzero_rate")).alias("nonzero_rate"), fround("variance", 4).alias("variance"), "keep")


# --------------------------------------------------------------------------- X11
@register("absence_log", oracle=S.with_(S.ORDER_LINES) + """
SELECT CAST(CAST(obl17 AS DECIMAL(38,0)) AS VARCHAR) AS obl17_key,
       CASE WHEN COALESCE(mo_n_returned, 0) = 0 THEN 1 ELSE 0 END AS mo_n_returned_absent,
       round(CASE WHEN mo_n_returned IS NOT NULL THEN ln(1 + LEAST(GREATEST(CAST(mo_n_returned AS DOUBLE), 0), 5)) END, 6) AS mo_n_returned_log1p,
       CASE WHEN COALESCE(tq_std_price, 0) = 0 THEN 1 ELSE 0 END AS tq_std_price_absent,
       round(CASE WHEN tq_std_price IS NOT NULL THEN ln(1 + LEAST(GREATEST(tq_std_price, 0), 5)) END, 6) AS tq_std_price_log1p
FROM order_lines""")
def absence_log(spark, d):
    ol = T.with_keys(T.order_lines(spark, d)).select("obl17_key", "mo_n_returned", "tq_std_price")
    out = features.absence_and_log(ol, ["mo_n_returned", "tq_std_price"], clip_at=5.0)
    return out.select("obl17_key", "mo_n_returned_absent", r6(F.col("mo_n_returned_log1p")).alias("mo_n_returned_log1p"),
                      "tq_std_price_absent", r6(F.col("tq_std_price_log1p")).alias("tq_std_price_log1p"))


# --------------------------------------------------------------------------- X6
@register("contact_features", oracle="""
SELECT user_id, count(*) AS n_contacts, round(count_if(event_type = 'purchase') / count(*), 6) AS agreement_rate,
       round(count_if(event_type = 'error') / count(*), 6) AS refusal_rate
FROM events GROUP BY user_id""")
def contact_features(spark, d):
    out = features.contact_features(T.table(spark, d, "events"), ["user_id"], "event_type", ["purchase"], ["error"])
    return out.select("user_id", "n_contacts", r6(F.col("agreement_rate")).alias("agreement_rate"),
                      r6(F.col("refusal_rate")).alias("refusal_rate"))


# --------------------------------------------------------------------------- X3
@register("payment_features", oracle="""
WITH p AS (SELECT o.o_custkey, l.l_shipdate, l.l_extendedprice AS due,
                  l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS paid
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
r AS (SELECT * FROM p WHERE l_shipdate > (SELECT max(l_shipdate) FROM p) - INTERVAL 3 MONTH
                        AND l_shipdate <= (SELECT max(l_shipdate) FROM p))
SELECT o_custkey, count(*) AS n_payments, round(avg(CASE WHEN paid >= due THEN 1.0 ELSE 0.0 END), 6) AS full_payment_ratio,
       round(avg(paid), 4) AS mean_paid, round(stddev_samp(paid), 4) AS std_paid,
       round(sum(greatest(paid - due, 0)) / NULLIF(sum(paid), 0), 6) AS surplus_share
FROM r GROUP BY o_custkey""")
def payment_features(spark, d):
    li = T.table(spark, d, "lineitem")
    o = T.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    pay = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "o_custkey", "l_shipdate", F.col("l_extendedprice").alias("due"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("paid"))
    # the latest payment comes from the payment table alone: the join runs once
    out = features.payment_features(pay, ["o_custkey"], "l_shipdate", "paid", "due", months=3, snapshot=li.select(F.max("l_shipdate")).scalar())
    return out.select("o_custkey", "n_payments", r6(F.col("full_payment_ratio")).alias("full_payment_ratio"),
                      fround(F.col("mean_paid"), 4).alias("mean_paid"), fround(F.col("std_paid"), 4).alias("std_paid"),
                      r6(F.col("surplus_share")).alias("surplus_share"))
