"""Registered queries: sources, cleaning, keys, joins, quality and profiling."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from abtforge.functions.keys import client_key
from abtforge.functions.numeric import fround

from abtforge.operators import clean, joins, profile, quality, split
from abtforge.operators.wide import build_compact
from abtforge.plans import sql_standins as S
from abtforge.plans import standins as T
from abtforge.plans.registry import register
from abtforge.session import work_dir
from abtforge.sources import tables

KEYS3 = ["num_doc_key", "obl17_key", "f_analisis"]


def r6(c):
    return fround(c, 6)


def keyed_clientes(spark, d):
    return clean.drop_null_keys(clean.add_key_columns(clean.clean_dataset(T.clientes_raw(spark, d))))


# --------------------------------------------------------------------------- P1, P2
@register("clean_names_trim", oracle="""
SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal,
       trim(c_mktsegment) AS c_mktsegment
FROM customer""")
def clean_names_trim(spark: SparkSession, d: str):
    c = T.table(spark, d, "customer")
    messy = c.select(F.col("c_custkey").alias(" C_CustKey"),
                     F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("C Name"),
                     F.col("c_nationkey").alias("c.NationKey"),
                     F.col("c_acctbal").alias("C_AcctBal "),
                     F.concat(F.col("c_mktsegment"), F.lit("   ")).alias("C.MktSegment"))
    out = clean.clean_dataset(messy)
    return out.withColumn("c_acctbal", r6(F.col("c_acctbal")))


# --------------------------------------------------------------------------- P3-P6
@register("canonical_keys", oracle=S.with_(S.CLIENTES) + """
SELECT CAST(num_doc AS VARCHAR) AS num_doc_key, CAST(CAST(obl17 AS DECIMAL(38,0)) AS VARCHAR) AS obl17_key,
       f_analisis, var_rta
FROM clientes WHERE obl17 IS NOT NULL""")
def canonical_keys(spark, d):
    return keyed_clientes(spark, d).select("num_doc_key", "obl17_key", "f_analisis", "var_rta")


# --------------------------------------------------------------------------- S1, S12
@register("csv_roundtrip_scan", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def csv_roundtrip_scan(spark, d):
    o = T.table(spark, d, "orders")
    folder = work_dir(spark, "csv_export")
    path = tables.export_csv(o, folder, "orders")
    schema = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
    back = (spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .schema(schema).csv(path))
    return back.withColumn("o_totalprice", r6(F.col("o_totalprice")))


# --------------------------------------------------------------------------- S8, S10
@register("parquet_scan_view", oracle=S.with_(S.CLIENTES) + """
SELECT segmento, count(*) AS n, CAST(sum(var_rta) AS BIGINT) AS n_label_1, min(f_analisis) AS first_date
FROM clientes GROUP BY segmento""")
def parquet_scan_view(spark, d):
    folder = work_dir(spark, "gold_staging")
    T.clientes_raw(spark, d).write.mode("overwrite").parquet(folder)
    gold = tables.read_parquet_folder(spark, folder)
    name = f"dataset_modelo_{uuid.uuid4().hex[:8]}"
    tables.create_view(gold, name)
    return spark.sql(f"SELECT segmento, count(*) AS n, CAST(sum(var_rta) AS BIGINT) AS n_label_1, "
                     f"min(f_analisis) AS first_date FROM {name} GROUP BY segmento")


# --------------------------------------------------------------------------- S13
_FAMILY_VALUES = ", ".join(f"('{e}', '{f}')" for e, f in T.FAMILY_OF_EVENT)


@register("seed_dimension_join", oracle=f"""
WITH fam(event_type, family) AS (VALUES {_FAMILY_VALUES})
SELECT f.family, count(*) AS n_events, round(sum(e.value), 4) AS sum_value,
       count(DISTINCT e.user_id) AS n_users
FROM events e LEFT JOIN fam f ON e.event_type = f.event_type
GROUP BY f.family""")
def seed_dimension_join(spark, d):
    fam = spark.createDataFrame(T.FAMILY_OF_EVENT, "event_type string, family string")
    ev = T.table(spark, d, "events")
    # The seed has a fixed handful of rows: broadcasting it is safe at any data size.
    j = ev.join(F.broadcast(fam), on="event_type", how="left")
    return j.groupBy("family").agg(F.count(F.lit(1)).alias("n_events"), fround(F.sum("value"), 4).alias("sum_value"),
                                   F.count_distinct("user_id").alias("n_users"))


# --------------------------------------------------------------------------- S5-S7, S9, S11
@register("save_skip_overwrite", oracle="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def save_skip_overwrite(spark, d):
    db = "abt_silver"
    name = f"nation_{uuid.uuid4().hex[:8]}"
    base = work_dir(spark, "tables")
    nation = T.table(spark, d, "nation")
    region = T.table(spark, d, "region").select(F.col("r_regionkey").alias("n_nationkey"),
                                                 F.col("r_name").alias("n_name"),
                                                 F.col("r_regionkey").alias("n_regionkey"))
    tables.save_table(nation, name, db, mode="overwrite", path=f"{base}/{name}")
    wrote = tables.save_table(region, name, db, mode="skip", path=f"{base}/{name}")
    assert not wrote, "skip mode must leave an existing table alone"
    # read-or-build: the table exists, so the builder must not run
    out = tables.ensure_table(spark, name, lambda df: region, source_database=db, target_database=db)
    return out.select("n_nationkey", "n_name", "n_regionkey")


# --------------------------------------------------------------------------- J1, P7, P8
def base_table(spark, d):
    """clientes LEFT JOIN its five sources: moras, tanque and excedentes by obligation, canales and
    gestiones by client."""
    cl = keyed_clientes(spark, d)
    by_order = [T.with_keys(side) for side in T.stored_order_sides(spark, d)]
    ge = T.gestiones(spark, d).withColumn("num_doc_key", client_key("num_doc"))
    ca = build_compact(T.canales_wide(spark, d), T.WIDE_CONFIG)
    ca = ca.withColumn("num_doc_key", F.trim(F.col("num_doc")))
    return joins.build_base_table(cl, [*by_order, (ca, ["num_doc_key"]), (ge, ["num_doc_key"])], keys=KEYS3)


def _base_table_sql() -> str:
    from abtforge.plans.q_wide import compact_select_sql
    comp = compact_select_sql()
    return S.with_(S.CLIENTES, S.CLIENTES_KEYS, S.ORDER_LINES, S.TANQUE, S.MORAS, S.EXCEDENTES, S.GESTIONES, S.canales_wide(),
                   f"canales AS ({comp})")


def _base_select() -> tuple[str, list[str]]:
    from abtforge.plans.q_wide import compact_feature_names
    side = {"m": T.MORAS_COLS, "t": T.TANQUE_COLS, "e": T.EXCEDENTES_COLS, "w": compact_feature_names(), "g": T.GESTIONES_COLS}
    num = [c for cols in side.values() for c in cols]
    num_expr = []
    for src, c in ((s, c) for s, cols in side.items() for c in cols):
        num_expr.append(f"COALESCE({src}.{c}, 0) AS {c}")
    sel = ("c.num_doc, c.obl17, c.f_analisis, c.var_rta, c.segmento, c.prioridad, "
           "c.num_doc_key, c.obl17_key, " + ", ".join(num_expr))
    frm = """FROM clientes_k c
LEFT JOIN moras m ON c.num_doc_key = m.num_doc_key AND c.obl17_key = m.obl17_key AND c.f_analisis = m.f_analisis
LEFT JOIN tanque t ON c.num_doc_key = t.num_doc_key AND c.obl17_key = t.obl17_key AND c.f_analisis = t.f_analisis
LEFT JOIN excedentes e ON c.num_doc_key = e.num_doc_key AND c.obl17_key = e.obl17_key AND c.f_analisis = e.f_analisis
LEFT JOIN canales w ON c.num_doc_key = trim(w.num_doc)
LEFT JOIN gestiones g ON c.num_doc_key = g.num_doc_key
WHERE c.obl17_key IS NOT NULL"""
    return sel, frm, num


def _round_doubles(df):
    return df.select(*[fround(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _base_oracle() -> str:
    sel, frm, num = _base_select()
    inner = f"SELECT {sel} {frm}"
    outer = ["num_doc", "round(obl17, 6) AS obl17", "f_analisis", "var_rta", "segmento", "prioridad",
             "num_doc_key", "obl17_key"]
    from abtforge.plans.q_wide import DOUBLE_FEATURES
    for c in num:
        outer.append(f"round({c}, 6) AS {c}" if c in DOUBLE_FEATURES | {*T.EXCEDENTES_COLS, "ge_tasa_acuerdo"} else c)
    return _base_table_sql() + f"SELECT {', '.join(outer)} FROM ({inner}) b"


@register("base_table_left_joins", oracle=_base_oracle())
def base_table_left_joins(spark, d):
    return _round_doubles(base_table(spark, d))


# --------------------------------------------------------------------------- J2
@register("base_table_hot_client", oracle="""
WITH c AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'HOT' ELSE CAST(o_custkey AS VARCHAR) END AS num_doc_key, o_orderstatus, o_orderpriority, o_totalprice FROM orders),
g AS (SELECT num_doc_key, count(*) AS n_obligaciones, max(o_totalprice) AS max_total FROM c GROUP BY num_doc_key),
f AS (SELECT num_doc_key, min(o_orderpriority) AS prioridad_min FROM c WHERE o_orderstatus = 'F' GROUP BY num_doc_key)
SELECT num_doc_key, count(*) AS n_filas, count(prioridad_min) AS n_con_f, max(n_obligaciones) AS n_obligaciones, max(max_total) AS max_total
FROM c LEFT JOIN g USING (num_doc_key) LEFT JOIN f USING (num_doc_key) GROUP BY num_doc_key""")
def base_table_hot_client(spark, d):
    """A third of all obligations on one client; both sides are aggregated on the join key and a grouping follows."""
    o = T.table(spark, d, "orders")
    drv = o.select(F.when(F.col("o_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("o_custkey").cast("string")).alias("num_doc_key"),
                   F.col("o_orderkey").cast("string").alias("obl17_key"), F.col("o_orderdate").cast("date").alias("f_analisis"),
                   "o_orderstatus", "o_orderpriority", "o_totalprice")
    clients = drv.groupBy("num_doc_key").agg(F.count(F.lit(1)).alias("n_obligaciones"), F.max("o_totalprice").alias("max_total"))
    closed = drv.where("o_orderstatus = 'F'").groupBy("num_doc_key").agg(F.min("o_orderpriority").alias("prioridad_min"))
    base = joins.build_base_table(drv, [(clients, ["num_doc_key"]), (closed, ["num_doc_key"])], keys=KEYS3, fill_numeric=False)
    return base.groupBy("num_doc_key").agg(F.count(F.lit(1)).alias("n_filas"), F.count("prioridad_min").alias("n_con_f"),
                                           F.max("n_obligaciones").alias("n_obligaciones"), F.max("max_total").alias("max_total"))


@register("key_match_rate", oracle=S.with_(S.CLIENTES, S.CLIENTES_KEYS, S.ORDER_LINES, S.MORAS, S.TANQUE) + """
, l AS (SELECT DISTINCT num_doc_key, obl17_key, f_analisis FROM clientes_k),
  lc AS (SELECT DISTINCT num_doc_key FROM clientes_k),
  ev AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS num_doc_key FROM events)
SELECT 'moras' AS name, (SELECT count(*) FROM l) AS left_keys,
       (SELECT count(*) FROM l WHERE EXISTS (SELECT 1 FROM moras r WHERE r.num_doc_key = l.num_doc_key
              AND r.obl17_key = l.obl17_key AND r.f_analisis = l.f_analisis)) AS matched_keys
UNION ALL
SELECT 'tanque', (SELECT count(*) FROM l),
       (SELECT count(*) FROM l WHERE EXISTS (SELECT 1 FROM tanque r WHERE r.num_doc_key = l.num_doc_key
              AND r.obl17_key = l.obl17_key AND r.f_analisis = l.f_analisis))
UNION ALL
SELECT 'canales', (SELECT count(*) FROM lc),
       (SELECT count(*) FROM lc WHERE num_doc_key IN (SELECT num_doc_key FROM ev))""".replace(
    "SELECT 'moras' AS name", "SELECT * , round(matched_keys / left_keys, 6) AS match_rate FROM (\nSELECT 'moras' AS name") + ")")
def key_match_rate(spark, d):
    cl = keyed_clientes(spark, d)
    ev = T.table(spark, d, "events").select(F.col("user_id").cast("string").alias("num_doc_key"))
    out = joins.match_rates(cl, [("moras", T.with_keys(T.moras(spark, d)), KEYS3), ("tanque", T.with_keys(T.tanque(spark, d)), KEYS3),
                                 ("canales", ev, ["num_doc_key"])])
    return out.withColumn("match_rate", r6(F.col("match_rate")))


# --------------------------------------------------------------------------- J3
@register("orphans_anti", oracle="""
SELECT 'orders_without_lines' AS check_name,
       (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS n_orphans
UNION ALL
SELECT 'lines_without_orders',
       (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
UNION ALL
SELECT 'events_without_customer',
       (SELECT count(*) FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id))""")
def orphans_anti(spark, d):
    o, li = T.table(spark, d, "orders"), T.table(spark, d, "lineitem")
    ev, cu = T.table(spark, d, "events"), T.table(spark, d, "customer")
    parts = [
        joins.orphan_count(o, li, ["o_orderkey"], ["l_orderkey"]).select(F.lit("orders_without_lines").alias("check_name"), "n_orphans"),
        joins.orphan_count(li, o, ["l_orderkey"], ["o_orderkey"]).select(F.lit("lines_without_orders").alias("check_name"), "n_orphans"),
        joins.orphan_count(ev, cu, ["user_id"], ["c_custkey"]).select(F.lit("events_without_customer").alias("check_name"), "n_orphans"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --------------------------------------------------------------------------- V6
@register("duplicate_grain", oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_grain(spark, d):
    return quality.duplicate_grain(T.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --------------------------------------------------------------------------- A10
@register("duplicates_by_key", oracle="""
SELECT 'l_orderkey' AS key_name, count(*) AS rows_total, count(DISTINCT l_orderkey) AS distinct_keys,
       count(*) - count(DISTINCT l_orderkey) AS dup_rows FROM lineitem
UNION ALL
SELECT 'o_custkey', count(*), count(DISTINCT o_custkey), count(*) - count(DISTINCT o_custkey) FROM orders""")
def duplicates_by_key(spark, d):
    a = quality.duplicates_by_key(T.table(spark, d, "lineitem"), "l_orderkey").select(F.lit("l_orderkey").alias("key_name"), "*")
    b = quality.duplicates_by_key(T.table(spark, d, "orders"), "o_custkey").select(F.lit("o_custkey").alias("key_name"), "*")
    return a.unionByName(b)


# --------------------------------------------------------------------------- V4, V5
def _null_sql(table: str, cte_cols: list[str]) -> str:
    parts = []
    for k in ("num_doc", "obl17", "f_analisis"):
        if k in cte_cols:
            parts.append(f"SELECT '{table}' AS table_name, '{k}' AS column_name, count(*) AS n_rows, "
                         f"count_if({k} IS NULL) AS n_nulls FROM {table}")
    return "\nUNION ALL\n".join(parts)


@register("null_key_counts", oracle=S.with_(S.CLIENTES, S.ORDER_LINES, S.MORAS, S.TANQUE, S.canales_wide()) + "\n".join([
    _null_sql("clientes", ["num_doc", "obl17", "f_analisis"]), "UNION ALL",
    _null_sql("moras", ["num_doc", "obl17", "f_analisis"]), "UNION ALL",
    _null_sql("tanque", ["num_doc", "obl17", "f_analisis"]), "UNION ALL",
    _null_sql("canales_wide", ["num_doc"])]))
def null_key_counts(spark, d):
    tabs = {"clientes": T.clientes_raw(spark, d), "moras": T.moras(spark, d), "tanque": T.tanque(spark, d),
            "canales_wide": T.canales_wide(spark, d)}
    return quality.null_key_counts(tabs, ["num_doc", "obl17", "f_analisis"])


# --------------------------------------------------------------------------- V4 (row counts)
@register("row_counts", oracle="""
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'events', count(*) FROM events""")
def row_counts(spark, d):
    return quality.row_counts({t: T.table(spark, d, t) for t in ("orders", "lineitem", "customer", "events")})


# --------------------------------------------------------------------------- A7
def _null_profile_sql() -> str:
    names = ["num_doc"] + T.wide_names()
    parts = [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS nulls, count(*) AS n FROM canales_wide" for c in names]
    return (S.with_(S.canales_wide()) + "SELECT column_name, nulls, round(nulls / greatest(n, 1), 4) AS null_pct FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) ORDER BY nulls DESC, column_name LIMIT 20")


@register("null_profile", oracle=_null_profile_sql())
def null_profile(spark, d):
    return profile.null_profile(T.canales_wide(spark, d), top=20)


# --------------------------------------------------------------------------- A8
_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("numeric_summary", oracle="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(min({c}), 6) AS min, round(avg({c}), 6) AS avg, round(max({c}), 6) AS max, "
    f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.95), 6) AS p95, "
    f"round(quantile_cont({c}, 0.99), 6) AS p99 FROM lineitem" for c in _LI_NUM))
def numeric_summary(spark, d):
    li = T.table(spark, d, "lineitem")
    out = profile.numeric_summary(li)
    return out.select("column_name", *[r6(F.col(c)).alias(c) for c in ("min", "avg", "max", "p50", "p95", "p99")])


# --------------------------------------------------------------------------- A9, K4
@register("top_values", oracle="""
SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, value LIMIT 10""")
def top_values(spark, d):
    return profile.top_values(T.table(spark, d, "lineitem"), "l_partkey", 10)


# --------------------------------------------------------------------------- A11
@register("table_profile", oracle=S.with_(S.CLIENTES) + """
SELECT 'clientes' AS table_name, 'rows' AS metric, NULL::VARCHAR AS column_name, count(*) AS value FROM clientes
UNION ALL SELECT 'clientes', 'columns', NULL, 6
UNION ALL SELECT 'clientes', 'nulls', 'num_doc', count_if(num_doc IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'nulls', 'obl17', count_if(obl17 IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'nulls', 'f_analisis', count_if(f_analisis IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'nulls', 'var_rta', count_if(var_rta IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'nulls', 'segmento', count_if(segmento IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'nulls', 'prioridad', count_if(prioridad IS NULL) FROM clientes
UNION ALL SELECT 'clientes', 'distinct_keys', 'num_doc', count(DISTINCT num_doc) FROM clientes
UNION ALL SELECT 'clientes', 'dup_rows', 'num_doc', count(*) - count(DISTINCT num_doc) FROM clientes""")
def table_profile(spark, d):
    return profile.table_profile(T.clientes_raw(spark, d), "clientes")


# --------------------------------------------------------------------------- V7
def _sanity_oracle() -> str:
    sel, frm, num = _base_select()
    return (_base_table_sql() + f", b AS (SELECT {sel} {frm})\n"
            "SELECT 'mo_n_returned' AS column_name, round(CAST(sum(mo_n_returned) AS DOUBLE), 6) AS total FROM b\n"
            "UNION ALL SELECT 'tq_sum_qty', round(sum(tq_sum_qty), 6) FROM b\n"
            "UNION ALL SELECT 'total_mnt_all_ult6', round(sum(total_mnt_all_ult6), 6) FROM b")


@register("sanity_sums", oracle=_sanity_oracle())
def sanity_sums(spark, d):
    out = quality.sanity_sums(base_table(spark, d), ["mo_n_returned", "tq_sum_qty", "total_mnt_all_ult6", "absent_col"])
    return out.withColumn("total", r6(F.col("total")))


# --------------------------------------------------------------------------- S4, S15-S17, K5
@register("preview_sample", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 20""")
def preview_sample(spark, d):
    name = f"orders_{uuid.uuid4().hex[:8]}"
    tables.create_view(T.table(spark, d, "orders"), name)
    df = tables.query(spark, f"SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice "
                             f"FROM {name} WHERE o_orderstatus = :status", {"status": "F"})
    return tables.preview(df, n=20, order_by=["o_orderkey"])


# --------------------------------------------------------------------------- S14
def _listing_oracle() -> str:
    def describe(name: str, query: str) -> str:
        typ = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' "
               "WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END")
        return (f"SELECT '{name}' AS table_name, CAST(row_number() OVER () AS INTEGER) AS ordinal_position, "
                f"column_name, {typ} AS data_type FROM (DESCRIBE {query})")
    cl = S.with_(S.CLIENTES) + "SELECT * FROM clientes"
    tq = (S.with_(S.ORDER_LINES) + "SELECT num_doc, obl17, f_analisis, tq_sum_qty, tq_avg_price, tq_min_price, "
          "tq_max_price, tq_std_price FROM order_lines")
    return describe("clientes", cl) + "\nUNION ALL\n" + describe("tanque", tq)


@register("catalog_listing", oracle=_listing_oracle())
def catalog_listing(spark, d):
    db = "abt_catalog"
    base = work_dir(spark, "catalog")
    suffix = uuid.uuid4().hex[:8]
    for name, df in (("clientes", T.clientes_raw(spark, d)), ("tanque", T.tanque(spark, d))):
        tables.save_table(df, f"{name}_{suffix}", db, mode="overwrite", path=f"{base}/{name}")
    cols = [tables.list_columns(spark, db, f"{n}_{suffix}").select(F.lit(n).alias("table_name"), "*")
            for n in ("clientes", "tanque")]
    return cols[0].unionByName(cols[1])


# --------------------------------------------------------------------------- flagship
def flagship(spark: SparkSession, d: str):
    """Split counts of the analytic base table: read -> clean -> keys -> left join -> md5 split -> count."""
    cl = keyed_clientes(spark, d)
    tq = T.with_keys(T.tanque(spark, d))
    base = joins.build_base_table(cl, [tq], keys=KEYS3)
    return split.split_counts(split.with_hash_split(base, "num_doc_key"))


register("flagship_split_counts", oracle=S.with_(S.CLIENTES) + f"""
SELECT {S.md5_split('CAST(num_doc AS VARCHAR)')} AS split_group, count(*) AS n FROM clientes GROUP BY 1""")(flagship)


# --------------------------------------------------------------------------- S1-S3
_CLIENTES_SCHEMA = ("num_doc bigint, obl17 double, f_analisis date, var_rta int, segmento string, "
                    "prioridad string")


@register("csv_ingest_raw", oracle=S.with_(S.CLIENTES) + "SELECT * FROM clientes")
def csv_ingest_raw(spark, d):
    land = work_dir(spark, "landing")
    # the landing folder holds only some of the mapped files: the others are skipped
    T.clientes_raw(spark, d).write.mode("overwrite").option("header", True).csv(f"{land}/clientes.csv")
    T.moras(spark, d).write.mode("overwrite").option("header", True).csv(f"{land}/moras.csv")
    db = f"abt_raw_{uuid.uuid4().hex[:8]}"
    counts = tables.ingest_csv_files(
        spark, land, database=db, location=work_dir(spark, "raw"),
        schemas={"clientes": _CLIENTES_SCHEMA,
                 "moras": "num_doc bigint, obl17 double, f_analisis date, mo_n_returned bigint, mo_n_open bigint, "
                          "mo_avg_disc double, mo_max_tax double, mo_dias_mora int"})
    assert set(counts) == {"clientes", "moras"}
    return tables.read_table(spark, "clientes", db)


# --------------------------------------------------------------------------- S1, streaming form
@register("stream_ingest_events", oracle="""
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events""")
def stream_ingest_events(spark, d):
    from abtforge.streaming import ingest_new_files

    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    land, sink, cp = work_dir(spark, "events_landing"), work_dir(spark, "events_raw"), work_dir(spark, "events_cp")
    ev = T.table(spark, d, "events")
    # two arrivals split by event day: the first run ingests the files of the first arrival,
    # the second run picks up only the files that arrived after it
    mid = ev.select(F.min("ts") + (F.max("ts") - F.min("ts")) / 2).scalar()
    first, second = ev.filter(F.col("ts") <= mid), ev.filter(~(F.col("ts") <= mid))
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    first.write.mode("append").options(**opts).option("header", True).csv(land)
    ingest_new_files(spark, land, schema, sink, cp, options=opts)
    second.write.mode("append").options(**opts).option("header", True).csv(land)
    ingest_new_files(spark, land, schema, sink, cp, options=opts)
    return spark.read.parquet(sink).withColumn("value", r6(F.col("value")))
