"""The stand-in tables written as DuckDB SQL (common table expressions) for the oracles.

Independent of the Spark builders in ``standins``: same definitions, other engine.
"""

from __future__ import annotations

from abtforge.plans.standins import EVENT_CHANNELS, SCORE_SCALE, SMMLV_UNIT, WIDE_CHANNELS, WIDE_WINDOWS

MD5_BUCKET = "(CAST(('0x' || substr(md5(COALESCE(CAST({x} AS VARCHAR), 'NA')), 1, 8)) AS BIGINT) % 10)"


def md5_split(x: str) -> str:
    b = MD5_BUCKET.format(x=x)
    return f"(CASE WHEN {b} < 7 THEN 'TRAIN' WHEN {b} < 9 THEN 'TEST' ELSE 'OOT' END)"


CLIENTES = """clientes AS (
  SELECT o.o_custkey AS num_doc, CAST(o.o_orderkey AS DOUBLE) AS obl17,
         CAST(o.o_orderdate AS DATE) AS f_analisis,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS var_rta,
         c.c_mktsegment AS segmento, o.o_orderpriority AS prioridad
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

CLIENTES_KEYS = """clientes_k AS (
  SELECT *, CAST(num_doc AS VARCHAR) AS num_doc_key,
         CAST(CAST(obl17 AS DECIMAL(38,0)) AS VARCHAR) AS obl17_key
  FROM clientes)"""

ORDER_LINES = """order_lines AS (
  SELECT o.o_custkey AS num_doc, CAST(o.o_orderkey AS DOUBLE) AS obl17,
         CAST(o.o_orderdate AS DATE) AS f_analisis,
         a.n_lines, a.tq_sum_qty, a.tq_avg_price, a.tq_min_price, a.tq_max_price, a.tq_std_price,
         a.mo_n_returned, a.mo_n_open, a.mo_avg_disc, a.mo_max_tax,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(a.first_ship AS DATE)) AS INTEGER) AS mo_dias_mora
  FROM (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS tq_sum_qty,
               avg(l_extendedprice) AS tq_avg_price, min(l_extendedprice) AS tq_min_price,
               max(l_extendedprice) AS tq_max_price, stddev_samp(l_extendedprice) AS tq_std_price,
               count_if(l_returnflag = 'R') AS mo_n_returned, count_if(l_linestatus = 'O') AS mo_n_open,
               avg(l_discount) AS mo_avg_disc, max(l_tax) AS mo_max_tax, min(l_shipdate) AS first_ship
        FROM lineitem GROUP BY l_orderkey) a
  JOIN orders o ON a.l_orderkey = o.o_orderkey)"""

TANQUE = """tanque AS (
  SELECT num_doc, obl17, f_analisis, tq_sum_qty, tq_avg_price, tq_min_price, tq_max_price, tq_std_price,
         CAST(num_doc AS VARCHAR) AS num_doc_key, CAST(CAST(obl17 AS DECIMAL(38,0)) AS VARCHAR) AS obl17_key
  FROM order_lines)"""

MORAS = """moras AS (
  SELECT num_doc, obl17, f_analisis, mo_n_returned, mo_n_open, mo_avg_disc, mo_max_tax, mo_dias_mora,
         CAST(num_doc AS VARCHAR) AS num_doc_key, CAST(CAST(obl17 AS DECIMAL(38,0)) AS VARCHAR) AS obl17_key
  FROM order_lines)"""


EXCEDENTES = """excedentes AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS num_doc_key, CAST(o.o_orderkey AS VARCHAR) AS obl17_key, CAST(o.o_orderdate AS DATE) AS f_analisis,
         avg(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS ex_avg_pago, max(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS ex_max_pago,
         sum(greatest(l_extendedprice * (1 - l_discount) * (1 + l_tax) - l_extendedprice, 0)) AS ex_surplus,
         avg(l_extendedprice * (1 - l_discount) * (1 + l_tax) / nullif(l_extendedprice, 0)) AS ex_porc_pago
  FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey GROUP BY ALL)"""

GESTIONES = """gestiones AS (
  SELECT CAST(user_id AS VARCHAR) AS num_doc_key, count(*) AS ge_n_contactos, count_if(event_type = 'purchase') AS ge_n_acuerdos,
         count_if(event_type = 'purchase') / count(*) AS ge_tasa_acuerdo, count(DISTINCT CAST(ts AS DATE)) AS ge_dias_activos
  FROM events GROUP BY user_id)"""


def canales_wide() -> str:
    last = "(SELECT max(ts) FROM events)"
    cols = ["sum(value) AS trx_mnt_total", "CAST(count(*) AS DOUBLE) AS trx_cnt_total"]
    event = {t: f"event_type = '{EVENT_CHANNELS[i // 5]}' AND event_id % 5 = {i % 5}" for i, t in enumerate(WIDE_CHANNELS)}
    for t in WIDE_CHANNELS:
        cols += [f"sum(CASE WHEN {event[t]} THEN value END) AS trx_mnt_can_{t}",
                 f"sum(CASE WHEN {event[t]} THEN 1.0::DOUBLE END) AS trx_cnt_can_{t}"]
    for w in WIDE_WINDOWS:
        for t in WIDE_CHANNELS:
            c = f"{event[t]} AND ts > {last} - INTERVAL {w} DAY"
            cols += [
                f"sum(CASE WHEN {c} THEN value END) AS sum_trx_mnt_{t}_ult{w}",
                f"sum(CASE WHEN {c} THEN 1.0::DOUBLE END) AS sum_trx_cnt_{t}_ult{w}",
                f"avg(CASE WHEN {c} THEN value END) AS avg_trx_mnt_{t}_ult{w}",
                f"sum(CASE WHEN {c} THEN 1.0::DOUBLE END) / {float(w)}::DOUBLE AS avg_trx_cnt_{t}_ult{w}",
                f"sum(CASE WHEN {c} THEN value END) / {SMMLV_UNIT}::DOUBLE AS sum_trx_mnt_{t}_smmlv_ult{w}",
            ]
    c6 = f"ts > {last} - INTERVAL 6 DAY"
    cols += [f"sum(CASE WHEN {c6} THEN value END) AS sum_trx_mnt_total_ult6",
             f"sum(CASE WHEN {c6} THEN 1.0::DOUBLE END) AS sum_trx_cnt_total_ult6"]
    body = ",\n         ".join(cols)
    return f"canales_wide AS (\n  SELECT user_id AS num_doc,\n         {body}\n  FROM events GROUP BY user_id)"


SCORES = f"""scores AS (
  SELECT o_custkey AS num_doc, CAST(o_orderkey AS DOUBLE) AS obl17, CAST(o_orderdate AS DATE) AS f_analisis,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target_final,
         CAST(LEAST(floor(o_totalprice / {SCORE_SCALE}::DOUBLE) / 1000.0::DOUBLE, 1.0::DOUBLE) AS DOUBLE) AS score,
         CAST(o_custkey AS VARCHAR) AS num_doc_key, CAST(o_orderkey AS VARCHAR) AS obl17_key,
         {md5_split('o_custkey')} AS split_group
  FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
