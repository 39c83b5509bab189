"""Column-name catalog (C1-C4, A14, A15) and the channel dimension seed.

Column names of a wide table are data too: parsed into (stat, tipo, canal, operacion,
window, is_smmlv) they can be grouped, filtered and joined like any table.  Parsing is a
set of column expressions over a string column, so the same code parses a handful of
names or a catalog of millions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abtforge.functions.stats import safe_corr

# Channel codes with their description.
CHANNEL_CATALOG = [
    ("gr", "gr"),
    ("cajero", "cajero"),
    ("app_per", "app personas"),
    ("pos", "pos"),
    ("suc_fis", "sucursal fisica"),
    ("svp", "sucursal virtual personas"),
    ("cr_bcrio", "cr_bcrio"),
    ("rec_e_v", "rec_e_v"),
    ("sve", "sucursal virtual empresa"),
    ("app_per_pag", "app_per_pag"),
    ("app_per_tfy", "app_per_tfy"),
    ("app_per_ut_c", "app_per_ut_c"),
    ("app_pyme", "app pymes"),
    ("bill_mvl", "billetera movil"),
    ("btn_bco", "boton banco"),
    ("pse_emp", "pse empresas"),
    ("pse_per", "pse personas"),
    ("suc_fis_dep", "suc_fis_dep"),
    ("suc_tel_pag", "sucursal telefonica"),
    ("suc_tel_ut_c", "suc_tel_ut_c"),
    ("sv_pyme", "sucursal virtual pymes"),
    ("sve_dvs", "sve_dvs"),
    ("sve_pag", "sve_pag"),
    ("sve_ut_c", "sve_ut_c"),
    ("svp_dvs", "svp_dvs"),
]

# Statistic prefixes and window suffixes of the naming grammar.
STATS = ("trx", "avg", "max", "min", "stddev", "sum")
WINDOWS = ("ult3", "ult6", "ult9", "ult12")


def channel_dimension(spark: SparkSession, rows: Sequence[tuple[str, str]] = CHANNEL_CATALOG) -> DataFrame:
    """The channel dictionary as a two-column table (canal, canal_desc)."""
    return spark.createDataFrame(list(rows), "canal string, canal_desc string")


def longest_code(tokens: Column, codes: Sequence[str]) -> Column:
    """(start, n, code) of the longest code among the token spans of ``tokens``; NULL if there is none.

    Every span of up to as many tokens as a code has is looked up in the set of codes, so the work grows
    with the spans, whatever the number of codes.  Equal lengths go by the order of ``codes``, equal
    codes by place.
    """
    codes = list(dict.fromkeys(codes))
    most = max((c.count("_") + 1 for c in codes), default=1)
    size = F.size(tokens)
    text = lambda start, n: F.array_join(F.slice(tokens, start, n), "_")
    from_start = lambda start: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), size - start + 1)),
                                           lambda n: F.struct(start.alias("start"), n.alias("n"), text(start, n).alias("code")))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), size), from_start))
    known = F.filter(spans, lambda x: x["code"].isin(codes))
    order = F.array(*[F.lit(c) for c in codes])
    best = F.array_max(F.transform(known, lambda x: F.struct(F.length(x["code"]).alias("length"), (-F.array_position(order, x["code"])).alias("order"),
                                                             (-x["start"]).alias("at"), x.alias("span"))))
    return F.when(size > 0, best["span"])


def parse_column_names(names: DataFrame, channels: Sequence[str], col: str = "col") -> DataFrame:
    """Add stat, tipo, canal, operacion, window, is_smmlv to a DataFrame of column names.

    The channel is the longest code (ties: catalog order) found as a '_'-delimited block of
    what is left after stat and tipo; the rest is the operation ('none' when empty).
    """
    last = F.element_at("_toks", -1)
    step = names.select("*", F.split(F.col(col), "_").alias("_toks"))
    step = step.select("*", F.when(last.isin(*WINDOWS), last).otherwise(F.lit("none")).alias("_window"))
    step = step.withColumn("_toks", F.when(F.col("_window") != "none", F.slice("_toks", 1, F.size("_toks") - 1)).otherwise(F.col("_toks")))
    step = step.select("*", F.array_contains("_toks", "smmlv").alias("_smmlv"), F.filter("_toks", lambda x: x != "smmlv").alias("_t"))
    first, second = F.try_element_at("_t", F.lit(1)), F.try_element_at("_t", F.lit(2))
    stat = F.when(first.isin(*STATS), first)
    # index (1-based) of the tipo token
    step = step.select("*", stat.alias("_stat"), F.when(stat == "trx", F.lit(2)).when(second == "trx", F.lit(3)).otherwise(F.lit(2)).alias("_at"))
    step = step.select("*", F.slice("_t", F.col("_at") + 1, F.greatest(F.size("_t") - F.col("_at"), F.lit(0))).alias("_rest"))
    step = step.select("*", longest_code(F.col("_rest"), channels).alias("_span"))
    start, after = F.col("_span.start"), F.col("_span.start") + F.col("_span.n")
    without = F.concat(F.slice("_rest", F.lit(1), start - 1), F.slice("_rest", after, F.greatest(F.size("_rest") - after + 1, F.lit(0))))
    operacion = F.coalesce(F.btrim(F.array_join(without, "_"), F.lit("_")), F.array_join("_rest", "_"))
    has = F.col("_stat").isNotNull()
    return step.select(*names.columns, F.col("_stat").alias("stat"), F.when(has, F.try_element_at("_t", "_at")).alias("tipo"),
                       F.when(has, F.col("_span.code")).alias("canal"), F.when(has, F.when(operacion == "", "none").otherwise(operacion)).alias("operacion"),
                       F.col("_window").alias("window"), F.col("_smmlv").alias("is_smmlv"))


def describe_channels(parsed: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach ``canal_desc`` from the channel dimension (Spark decides by its size whether to broadcast it)."""
    return parsed.join(dimension, on="canal", how="left")


def is_candidate(col: str = "col", keep_prefixes: Sequence[str] = ("sum_trx_", "avg_trx_"),
                 keep_windows: Sequence[str] = ("ult6", "ult12"), drop_smmlv: bool = True) -> Column:
    """Rule-based selection: totals, per-channel base totals, and kept stats in kept windows."""
    c = F.col(col)
    toks = F.split(c, "_")
    cond = c.isin("trx_cnt_total", "trx_mnt_total") | c.startswith("trx_cnt_can_") | c.startswith("trx_mnt_can_")
    pref = F.lit(False)
    for p in keep_prefixes:
        pref = pref | c.startswith(p)
    cond = cond | (pref & F.element_at(toks, -1).isin(*keep_windows))
    if drop_smmlv:
        cond = cond & ~F.array_contains(toks, "smmlv")
    return cond


def smmlv_pairs(names: DataFrame, col: str = "col") -> DataFrame:
    """(base, smmlv) pairs: a name containing 'smmlv' whose '_smmlv'-less form is also a name."""
    sm = names.filter(F.col(col).contains("smmlv")).select(
        F.col(col).alias("smmlv"), F.replace(F.col(col), F.lit("_smmlv"), F.lit("")).alias("base"))
    base = names.select(F.col(col).alias("base"))
    return sm.join(base, on="base", how="inner").select("base", "smmlv")


def smmlv_column_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """The same pairs from a list of names, in order of the base name."""
    there = set(columns)
    pairs = [(c.replace("_smmlv", ""), c) for c in columns if "smmlv" in c]
    return sorted(p for p in pairs if p[0] in there and p[0] != p[1])


def pair_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(base, smmlv, corr) for every pair of columns, from one scan (A14); NULL where a side is
    constant or fewer than two rows hold both values."""
    named = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "_position int, base string, smmlv string")
    both = [F.struct(F.col(f"`{a}`").cast("double").alias("x"), F.col(f"`{b}`").cast("double").alias("y")) for a, b in pairs]
    if not both:
        return named.select("base", "smmlv", F.lit(None).cast("double").alias("corr"))
    rows = df.select(F.posexplode(F.array(*both)).alias("_position", "p"))
    found = rows.groupBy("_position").agg(safe_corr(F.col("p.x"), F.col("p.y")).alias("corr"))
    return named.join(found, "_position", "left").select("base", "smmlv", "corr")


def name_part_counts(names: DataFrame, top: int = 20, col: str = "col") -> DataFrame:
    """(part, value, n_cols): the ``top`` most frequent prefixes, suffixes and prefix-suffix
    combinations of the names (A15, K4); ties by value."""
    tokens = F.split(F.col(col), "_")
    first, last = F.element_at(tokens, 1), F.element_at(tokens, -1)
    parts = names.select(F.explode(F.array(
        F.struct(F.lit("prefix").alias("part"), first.alias("value")), F.struct(F.lit("suffix").alias("part"), last.alias("value")),
        F.struct(F.lit("prefix_suffix").alias("part"), F.concat_ws("|", first, last).alias("value")))).alias("x"))
    counts = parts.groupBy("x.part", "x.value").agg(F.count(F.lit(1)).alias("n_cols"))
    best = Window.partitionBy("part").orderBy(F.desc("n_cols"), "value")
    return counts.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= top).drop("_rank")


def catalog_counts(parsed: DataFrame) -> DataFrame:
    """Columns per value of each catalog dimension (A15): (dimension, value, n_cols)."""
    dims = ["stat", "tipo", "canal", "operacion", "window"]
    exploded = parsed.select(
        F.explode(F.array(
            *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims],
            F.struct(F.lit("is_smmlv").alias("dimension"), F.col("is_smmlv").cast("string").alias("value")),
            F.struct(F.lit("stat_tipo_window").alias("dimension"),
                     F.concat_ws("|", F.col("stat"), F.col("tipo"), F.col("window")).alias("value")),
            F.struct(F.lit("detected_canal").alias("dimension"),
                     F.col("canal").isNotNull().cast("string").alias("value")),
        )).alias("d"))
    return exploded.groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n_cols"))
