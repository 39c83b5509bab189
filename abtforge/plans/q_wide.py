"""Registered queries: wide-table compaction and the column catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround
from abtforge.operators import catalog
from abtforge.operators.columnwise import column_stats
from abtforge.operators.wide import build_compact, compact_columns
from abtforge.plans import sql_standins as S
from abtforge.plans import standins as T
from abtforge.plans.registry import register

FAMILIES = T.WIDE_CONFIG.families


# ---------------------------------------------------------------- oracle-side compaction
def compact_feature_names() -> list[str]:
    return compact_columns(T.wide_names(), T.WIDE_CONFIG)


DOUBLE_FEATURES = set(compact_feature_names())


def _feature_sql(name: str) -> str:
    """A feature's value over ``per`` (one row per client, metric, window, family; family 'all' for
    the global totals)."""
    pick = lambda family, w, metric="mnt", of="total": (
        f"COALESCE(max({of}) FILTER (family = '{family}' AND metric = '{metric}' AND win = '{w}'), 0)")
    kind, *mid, last = name.split("_")
    if kind in ("total", "max"):
        return pick(mid[1], last, mid[0], kind)
    if kind == "share":
        return f"{pick(mid[1], last)} / ({pick('all', last)} + 1)"
    if kind == "index":
        return f"{pick('digital', last)} / ({pick('digital', last)} + {pick('fisico', last)} + 1)"
    if kind == "preferencia":
        return f"{pick('efectivo', last)} / ({pick('all', last)} + 1)"
    return f"{pick(mid[1], 'ult6')} / ({pick(mid[1], 'ult12')} + 1)"


def compact_select_sql() -> str:
    """The compact table by unpivoting the wide one: names are parsed in SQL and grouped by family."""
    grammar = "'^(sum|avg)_trx_(mnt|cnt)_(.*)_(ult6|ult12)$'"
    part = lambda i: f"regexp_extract(col, {grammar}, {i})"
    codes = ", ".join(f"('{code}', '{family}')" for family, cs in FAMILIES.items() for code in cs)
    features = ", ".join(f"{_feature_sql(n)} AS {n}" for n in compact_feature_names())
    return f"""
  WITH long AS (
    SELECT num_doc, col, v FROM canales_wide UNPIVOT INCLUDE NULLS (v FOR col IN ({", ".join(T.wide_names())}))
  ), parsed AS (
    SELECT num_doc, col, COALESCE(v, 0) AS v, {part(1)} AS stat, {part(2)} AS metric, {part(3)} AS subject, {part(4)} AS win
    FROM long WHERE regexp_matches(col, {grammar}) AND NOT contains(col, 'smmlv')
  ), member AS (
    SELECT DISTINCT num_doc, col, metric, win, family, v
    FROM parsed JOIN (VALUES {codes}) f(code, family) ON contains('_' || subject || '_', '_' || code || '_')
  ), fam AS (
    SELECT num_doc, metric, win, family, sum(v) AS total, max(v) AS max FROM member GROUP BY ALL
  ), ready AS (
    SELECT num_doc, metric, win, arg_max(v, stat) AS total FROM parsed WHERE subject = 'total' GROUP BY ALL
  ), per AS (
    SELECT * FROM fam
    UNION ALL
    SELECT f.num_doc, f.metric, f.win, 'all', COALESCE(max(r.total), sum(f.total)), NULL
    FROM fam f LEFT JOIN ready r USING (num_doc, metric, win) GROUP BY f.num_doc, f.metric, f.win
  )
  SELECT CAST(num_doc AS VARCHAR) AS num_doc, {features} FROM per GROUP BY num_doc"""


def _compact_oracle(cols: list[str]) -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return S.with_(S.canales_wide(), f"canales AS ({compact_select_sql()})") + f"SELECT num_doc, {sel} FROM canales"


_L1 = [n for n in compact_feature_names() if n.startswith(("total_", "max_"))]
_L2 = [n for n in compact_feature_names() if n not in set(_L1)]


def _compact(spark, d):
    return build_compact(T.canales_wide(spark, d), T.WIDE_CONFIG)


# --------------------------------------------------------------------------- P9-P13
@register("wide_totals_max", oracle=_compact_oracle(_L1))
def wide_totals_max(spark, d):
    c = _compact(spark, d)
    return c.select("num_doc", *[fround(n, 6).alias(n) for n in _L1])


# --------------------------------------------------------------------------- P14-P20
@register("wide_shares_trend", oracle=_compact_oracle(_L2))
def wide_shares_trend(spark, d):
    c = _compact(spark, d)
    return c.select("num_doc", *[fround(n, 6).alias(n) for n in _L2])


# --------------------------------------------------------------------------- C1-C3, A15, S13
CHANNELS = [code for code, _ in catalog.CHANNEL_CATALOG]


def _names_df(spark, d):
    """The catalog's rows: one per column of the wide table, with its non-NULL count (one scan)."""
    wide = T.canales_wide(spark, d)
    cols = [c for c in wide.columns if c != "num_doc"]
    counts = column_stats(wide, cols, {"n_nonnull": F.count_if}, value=F.isnotnull, empty={"n_nonnull": 0})
    return counts.withColumnRenamed("column_name", "col")


def _catalog_oracle() -> str:
    names = [c for c in T.wide_names()]
    channels = sorted(CHANNELS, key=len, reverse=True)
    counts = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, count({c}) AS n_nonnull FROM canales_wide" for c in names)
    canal = "CASE " + " ".join(f"WHEN regexp_matches(remaining, '(^|_){ch}(_|$)') THEN '{ch}'" for ch in channels) + " END"
    oper = "CASE " + " ".join(
        f"WHEN regexp_matches(remaining, '(^|_){ch}(_|$)') THEN "
        f"COALESCE(NULLIF(trim(regexp_replace(remaining, '(^|_){ch}(_|$)', '_'), '_'), ''), 'none')"
        for ch in channels) + " ELSE COALESCE(NULLIF(remaining, ''), 'none') END"
    stats = ", ".join(f"'{s}'" for s in catalog.STATS)
    wins = ", ".join(f"'{w}'" for w in catalog.WINDOWS)
    return S.with_(S.canales_wide()) + f"""
, n AS ({counts}),
a AS (SELECT col, n_nonnull, string_split(col, '_') AS toks FROM n),
b AS (SELECT *, CASE WHEN toks[-1] IN ({wins}) THEN toks[-1] ELSE 'none' END AS "window" FROM a),
c AS (SELECT *, CASE WHEN "window" <> 'none' THEN toks[1:len(toks) - 1] ELSE toks END AS bt FROM b),
d AS (SELECT col, n_nonnull, "window", list_contains(bt, 'smmlv') AS is_smmlv,
             list_filter(bt, lambda x: x <> 'smmlv') AS t FROM c),
e AS (SELECT *, CASE WHEN t[1] IN ({stats}) THEN t[1] END AS stat FROM d),
f AS (SELECT *, CASE WHEN stat = 'trx' THEN 2 WHEN t[2] = 'trx' THEN 3 ELSE 2 END AS ti FROM e),
g AS (SELECT *, t[ti] AS tipo0, array_to_string(t[ti + 1:], '_') AS remaining FROM f),
h AS (SELECT *, {canal} AS canal0, {oper} AS oper0 FROM g)
SELECT col, n_nonnull, stat,
       CASE WHEN stat IS NOT NULL THEN tipo0 END AS tipo,
       CASE WHEN stat IS NOT NULL THEN canal0 END AS canal,
       CASE WHEN stat IS NOT NULL THEN oper0 END AS operacion,
       "window", is_smmlv, dim.canal_desc,
       (NOT is_smmlv) AND (col IN ('trx_cnt_total', 'trx_mnt_total') OR starts_with(col, 'trx_cnt_can_')
         OR starts_with(col, 'trx_mnt_can_')
         OR ((starts_with(col, 'sum_trx_') OR starts_with(col, 'avg_trx_')) AND toks_last IN ('ult6', 'ult12'))) AS is_candidate
FROM (SELECT *, string_split(col, '_')[-1] AS toks_last FROM h) h2
LEFT JOIN (VALUES {", ".join(f"('{c}', '{n}')" for c, n in catalog.CHANNEL_CATALOG)}) dim(code, canal_desc)
  ON CASE WHEN h2.stat IS NOT NULL THEN h2.canal0 END = dim.code"""


@register("column_catalog", oracle=_catalog_oracle())
def column_catalog(spark, d):
    names = _names_df(spark, d)
    parsed = catalog.parse_column_names(names, CHANNELS)
    out = catalog.describe_channels(parsed, catalog.channel_dimension(spark))
    return out.select("col", "n_nonnull", "stat", "tipo", "canal", "operacion", "window", "is_smmlv", "canal_desc",
                      catalog.is_candidate("col").alias("is_candidate"))


def _catalog_counts_oracle() -> str:
    cat = _catalog_oracle()
    dims = [("stat", "stat"), ("tipo", "tipo"), ("canal", "canal"), ("operacion", "operacion"), ("window", '"window"'),
            ("is_smmlv", "CAST(is_smmlv AS VARCHAR)"), ("stat_tipo_window", "concat_ws('|', stat, tipo, \"window\")"),
            ("detected_canal", "CAST(canal IS NOT NULL AS VARCHAR)")]
    parts = [f"SELECT '{d}' AS dimension, CAST({e} AS VARCHAR) AS value, count(*) AS n_cols FROM cat GROUP BY 2"
             for d, e in dims]
    return "SELECT * FROM (WITH cat AS (" + cat + ")\n" + "\nUNION ALL\n".join(parts) + ")"


@register("catalog_counts", oracle=_catalog_counts_oracle())
def catalog_counts(spark, d):
    parsed = catalog.parse_column_names(_names_df(spark, d), CHANNELS)
    return catalog.catalog_counts(parsed)


_PARTS_SQL = "\nUNION ALL\n".join(
    f"(SELECT '{part}' AS part, {e} AS value, count(*) AS n_cols FROM n GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)"
    for part, e in (("prefix", "string_split(col, '_')[1]"), ("suffix", "string_split(col, '_')[-1]"),
                    ("prefix_suffix", "string_split(col, '_')[1] || '|' || string_split(col, '_')[-1]")))


@register("name_parts_top", oracle=S.with_(S.canales_wide()) + """
, n AS (SELECT col FROM (SELECT count(*) FROM canales_wide) one, (VALUES """ + ", ".join(f"('{c}')" for c in T.wide_names()) + ") v(col))\n" + _PARTS_SQL)
def name_parts_top(spark, d):
    return catalog.name_part_counts(_names_df(spark, d), top=5)


# --------------------------------------------------------------------------- A14, C4
def _pairs() -> list[tuple[str, str]]:
    names = set(T.wide_names())
    return sorted((c.replace("_smmlv", ""), c) for c in names if "smmlv" in c and c.replace("_smmlv", "") in names)


def _pair_oracle() -> str:
    parts = []
    for b, s in _pairs():
        parts.append(
            f"SELECT '{b}' AS base, '{s}' AS smmlv, covar_samp({b}, {s}) AS cv, var_samp({b}) AS vb, var_samp({s}) AS vs "
            f"FROM canales_wide WHERE {b} IS NOT NULL AND {s} IS NOT NULL")
    return (S.with_(S.canales_wide()) + "SELECT base, smmlv, round(cv / (sqrt(vb) * sqrt(vs)), 6) AS corr FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) WHERE vb > 0 AND vs > 0")


@register("pair_correlation", oracle=_pair_oracle())
def pair_correlation(spark, d):
    wide = T.canales_wide(spark, d)
    out = catalog.pair_correlation(wide, catalog.smmlv_column_pairs(wide.columns))
    return out.where("corr IS NOT NULL").select("base", "smmlv", fround("corr", 6).alias("corr"))
