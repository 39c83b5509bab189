"""Stand-ins for the source tables, derived from the driver tables by Spark.

| source role              | built from                                            | grain        |
|--------------------------|-------------------------------------------------------|--------------|
| clientes (base + label)  | orders joined to customer; label = status 'F'         | order        |
| tanque_movimiento        | lineitem aggregated per order (price statistics)      | order        |
| moras                    | lineitem aggregated per order (flags, status, delay)  | order        |
| excedentes               | lineitem payments per order                           | order        |
| gestiones                | events as contacts per client                         | user         |
| canales (raw, wide)      | events pivoted per user into the wide naming grammar  | user         |
| scores                   | order total scaled to [0, 1], some exactly 1.0        | order        |

Every builder reads whole tables; the order-level sides come from one aggregation of
``lineitem`` by order key (partial aggregation before the shuffle) joined 1:1 to
``orders`` for the canonical keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abtforge.functions.keys import client_key, obligation_key
from abtforge.functions.split import hash_split
from abtforge.operators.catalog import CHANNEL_CATALOG
from abtforge.operators.wide import Compaction
from abtforge.session import work_dir

# The event types of the driver's events table, and families that group them.
EVENT_CHANNELS = ("click", "error", "purchase", "signup", "view")
EVENT_FAMILIES = {
    "digital": ["view", "click"],
    "fisico": ["signup"],
    "efectivo": ["purchase"],
    "tarjeta": ["pos"],
    "otros": ["error"],
}
FAMILY_OF_EVENT = [("view", "digital"), ("click", "digital"), ("signup", "fisico"),
                   ("purchase", "efectivo"), ("error", "otros")]
WIDE_WINDOWS = (6, 12)
# Amounts in "minimum wage" units for the redundant *_smmlv_* variants.
SMMLV_UNIT = 1000.0
SCORE_SCALE = 400.0

# the 25 real channel codes, every fifth with an operation after it
WIDE_CHANNELS = tuple(code + ("_cmpr" if i % 5 == 4 else "") for i, (code, _) in enumerate(CHANNEL_CATALOG))
WIDE_CONFIG = Compaction(keys=("num_doc",), text_keys=("num_doc",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clientes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """num_doc BIGINT, obl17 DOUBLE, f_analisis DATE, var_rta INT, segmento, prioridad."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_custkey").alias("num_doc"),
        F.col("o_orderkey").cast("double").alias("obl17"),
        F.col("o_orderdate").cast("date").alias("f_analisis"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("var_rta"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("o_orderpriority").alias("prioridad"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem aggregated per order, with the order's keys."""
    return order_facts(spark, sf_dir).drop(*EXCEDENTES_COLS)


EXCEDENTES_COLS = ("ex_avg_pago", "ex_max_pago", "ex_surplus", "ex_porc_pago")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the order-level sources take from lineitem, from one aggregate: prices, flags,
    delays and payments (paid = price less discount plus tax, against the price)."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    paid = price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    agg = li.groupBy(F.col("l_orderkey").alias("_ok")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("tq_sum_qty"),
        F.avg(price).alias("tq_avg_price"),
        F.min(price).alias("tq_min_price"),
        F.max(price).alias("tq_max_price"),
        F.stddev_samp(price).alias("tq_std_price"),
        F.count_if(F.col("l_returnflag") == "R").alias("mo_n_returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("mo_n_open"),
        F.avg("l_discount").alias("mo_avg_disc"),
        F.max("l_tax").alias("mo_max_tax"),
        F.min("l_shipdate").alias("_first_ship"),
        F.avg(paid).alias("ex_avg_pago"),
        F.max(paid).alias("ex_max_pago"),
        F.sum(F.greatest(paid - price, F.lit(0.0))).alias("ex_surplus"),
        F.avg(F.try_divide(paid, price)).alias("ex_porc_pago"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = agg.join(o, agg._ok == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("num_doc"),
        F.col("o_orderkey").cast("double").alias("obl17"),
        F.col("o_orderdate").cast("date").alias("f_analisis"),
        "n_lines", "tq_sum_qty", "tq_avg_price", "tq_min_price", "tq_max_price", "tq_std_price",
        "mo_n_returned", "mo_n_open", "mo_avg_disc", "mo_max_tax",
        F.datediff(F.col("_first_ship").cast("date"), F.col("o_orderdate").cast("date")).alias("mo_dias_mora"),
        *EXCEDENTES_COLS,
    )


TANQUE_COLS = ("tq_sum_qty", "tq_avg_price", "tq_min_price", "tq_max_price", "tq_std_price")
MORAS_COLS = ("mo_n_returned", "mo_n_open", "mo_avg_disc", "mo_max_tax", "mo_dias_mora")


def tanque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select("num_doc", "obl17", "f_analisis", *TANQUE_COLS)


def moras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select("num_doc", "obl17", "f_analisis", *MORAS_COLS)


GESTIONES_COLS = ("ge_n_contactos", "ge_n_acuerdos", "ge_tasa_acuerdo", "ge_dias_activos")


def excedentes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments per order: what was paid (price less discount plus tax) against the price."""
    return order_facts(spark, sf_dir).select("num_doc", "obl17", "f_analisis", *EXCEDENTES_COLS)


def stored_order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(moras, tanque, excedentes) as columns of one stored table, as the silver layer keeps them: lineitem is
    aggregated and joined once."""
    path = f"{work_dir(spark, 'order_sides')}/facts"
    order_facts(spark, sf_dir).write.parquet(path)
    facts = spark.read.parquet(path)
    return tuple(facts.select("num_doc", "obl17", "f_analisis", *cols) for cols in (MORAS_COLS, TANQUE_COLS, EXCEDENTES_COLS))


def gestiones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts per client: events, those that end in an agreement (purchase), active days."""
    ev = table(spark, sf_dir, "events")
    agreed = F.count_if(F.col("event_type") == "purchase")
    return ev.groupBy(F.col("user_id").alias("num_doc")).agg(
        F.count(F.lit(1)).alias("ge_n_contactos"), agreed.alias("ge_n_acuerdos"), (agreed / F.count(F.lit(1))).alias("ge_tasa_acuerdo"),
        F.count_distinct(F.to_date("ts")).alias("ge_dias_activos"))


def wide_names() -> list[str]:
    """Column names of the wide stand-in, in table order (without the key)."""
    names = ["trx_mnt_total", "trx_cnt_total"]
    for t in WIDE_CHANNELS:
        names += [f"trx_mnt_can_{t}", f"trx_cnt_can_{t}"]
    for w in WIDE_WINDOWS:
        for t in WIDE_CHANNELS:
            names += [f"sum_trx_mnt_{t}_ult{w}", f"sum_trx_cnt_{t}_ult{w}", f"avg_trx_mnt_{t}_ult{w}",
                      f"avg_trx_cnt_{t}_ult{w}", f"sum_trx_mnt_{t}_smmlv_ult{w}"]
    names += ["sum_trx_mnt_total_ult6", "sum_trx_cnt_total_ult6"]
    return names


def canales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events pivoted per user into 300 columns: one aggregate per (user, channel), then a pivot.

    An event's channel is one of the 25 real codes, by its type and id.  Windows are the ``d``
    days before the last event of the table (a scalar subquery, evaluated once and attached to
    each row as a flag per window).
    """
    ev = table(spark, sf_dir, "events")
    last = ev.select(F.max("ts")).scalar()
    kind = F.array_position(F.array(*[F.lit(t) for t in EVENT_CHANNELS]), F.col("event_type"))
    at = ((kind - 1) * 5 + F.col("event_id") % 5 + 1).cast("int")
    flagged = ev.select("user_id", F.element_at(F.array(*[F.lit(c) for c in WIDE_CHANNELS]), at).alias("channel"),
                        F.col("value").cast("double").alias("v"),
                        *[(F.col("ts") > last - F.expr(f"INTERVAL {w} DAYS")).alias(f"_w{w}") for w in WIDE_WINDOWS])
    sums = [F.sum("v").alias("trx_mnt_can"), F.sum(F.lit(1.0)).alias("trx_cnt_can")]
    for w in WIDE_WINDOWS:
        sums += [F.sum(F.when(F.col(f"_w{w}"), F.col("v"))).alias(f"mnt_{w}"), F.sum(F.when(F.col(f"_w{w}"), 1.0)).alias(f"cnt_{w}"),
                 F.avg(F.when(F.col(f"_w{w}"), F.col("v"))).alias(f"avg_{w}")]
    per = flagged.groupBy(F.col("user_id").alias("num_doc"), "channel").agg(*sums)
    values = [c for c in per.columns if c not in ("num_doc", "channel")]
    wide = per.groupBy("num_doc").pivot("channel", list(WIDE_CHANNELS)).agg(*[F.first(c).alias(c) for c in values])
    total = per.groupBy("num_doc").agg(F.sum("trx_mnt_can").alias("trx_mnt_total"), F.sum("trx_cnt_can").alias("trx_cnt_total"),
                                       F.sum("mnt_6").alias("sum_trx_mnt_total_ult6"), F.sum("cnt_6").alias("sum_trx_cnt_total_ult6"))
    out = {n: F.col(n) for n in total.columns}
    for t in WIDE_CHANNELS:
        out |= {f"trx_mnt_can_{t}": F.col(f"{t}_trx_mnt_can"), f"trx_cnt_can_{t}": F.col(f"{t}_trx_cnt_can")}
        for w in WIDE_WINDOWS:
            out |= {f"sum_trx_mnt_{t}_ult{w}": F.col(f"{t}_mnt_{w}"), f"sum_trx_cnt_{t}_ult{w}": F.col(f"{t}_cnt_{w}"),
                    f"avg_trx_mnt_{t}_ult{w}": F.col(f"{t}_avg_{w}"), f"avg_trx_cnt_{t}_ult{w}": F.col(f"{t}_cnt_{w}") / F.lit(float(w)),
                    f"sum_trx_mnt_{t}_smmlv_ult{w}": F.col(f"{t}_mnt_{w}") / F.lit(SMMLV_UNIT)}
    return wide.join(total, "num_doc").select("num_doc", *[out[n].alias(n) for n in wide_names()])


def with_keys(df: DataFrame) -> DataFrame:
    """Canonical keys for a stand-in (num_doc BIGINT, obl17 DOUBLE, f_analisis DATE)."""
    cols = [F.col(c) for c in df.columns]
    out = cols + [client_key("num_doc").alias("num_doc_key")]
    if "obl17" in df.columns:
        out.append(obligation_key("obl17", df.schema["obl17"].dataType).alias("obl17_key"))
    return df.select(*out)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score per order: floor(total / 400) / 1000 capped at 1.0; label = var_rta."""
    o = table(spark, sf_dir, "orders")
    s = F.least(F.floor(F.col("o_totalprice") / F.lit(SCORE_SCALE)) / F.lit(1000.0), F.lit(1.0))
    df = o.select(
        F.col("o_custkey").alias("num_doc"),
        F.col("o_orderkey").cast("double").alias("obl17"),
        F.col("o_orderdate").cast("date").alias("f_analisis"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target_final"),
        s.cast("double").alias("score"),
    )
    df = with_keys(df)
    return df.withColumn("split_group", hash_split(F.col("num_doc_key")))
