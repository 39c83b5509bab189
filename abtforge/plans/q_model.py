"""Registered queries: labels, splits, feature preparation, leakage, metrics, model, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from abtforge.functions.numeric import fround

from abtforge.functions.names import LEAK_NAME_PATTERNS
from abtforge.operators import leakage, metrics, model, prep, runs, split
from abtforge.operators.features import create_features
from abtforge.plans import sql_standins as S
from abtforge.plans import standins as T
from abtforge.plans.q_core import KEYS3, base_table, keyed_clientes
from abtforge.plans.q_wide import compact_feature_names
from abtforge.plans.registry import register
from abtforge.session import work_dir

TRAIN_BEFORE, TEST_START, TEST_END = "1999-01-01", "1999-01-01", "2000-06-01"
CLIP_COLS = ["tq_avg_price", "tq_max_price", "tq_std_price", "mo_dias_mora"]
LEAK_FEATURES = ["tq_sum_qty", "tq_avg_price", "tq_std_price", "mo_n_returned", "mo_n_open", "mo_avg_disc",
                 "mo_dias_mora", "estado_f", "estado_no_f", "label_x", "const_one", "casi_target"]


def r6(c):
    return fround(c, 6)


def with_planted_leaks(df):
    y = F.col("target_final")
    return df.select("*", y.cast("double").alias("estado_f"), (1 - y).cast("double").alias("estado_no_f"),
                     y.alias("label_x"), F.lit(1.0).alias("const_one"),
                     (y * F.lit(1000.0) + F.col("mo_avg_disc")).alias("casi_target"))


def gold_frame(spark, d):
    """The five-source base table with label, hash split and planted leak columns.  Its text columns
    (segment, priority) are not numbers: coercion makes them all NULL and training drops them."""
    return with_planted_leaks(split.with_hash_split(base_table(spark, d), "num_doc_key"))


def training_frame(spark, d):
    """Keyed clientes + order-level features + label + hash split + planted leak columns."""
    cl = keyed_clientes(spark, d)
    ol = T.with_keys(T.order_lines(spark, d)).drop("num_doc", "obl17")
    return with_planted_leaks(split.with_hash_split(cl.join(ol, on=KEYS3, how="left"), "num_doc_key"))


TRAIN_FRAME_SQL = S.with_(S.CLIENTES, S.CLIENTES_KEYS, S.ORDER_LINES) + f""",
tf AS (
  SELECT c.var_rta AS target_final, {S.md5_split('c.num_doc_key')} AS split_group, c.num_doc_key, c.obl17_key, c.f_analisis,
         o.tq_sum_qty, o.tq_avg_price, o.tq_min_price, o.tq_max_price, o.tq_std_price, o.mo_n_returned, o.mo_n_open,
         o.mo_avg_disc, o.mo_max_tax, o.mo_dias_mora,
         CAST(c.var_rta AS DOUBLE) AS estado_f, CAST(1 - c.var_rta AS DOUBLE) AS estado_no_f, c.var_rta AS label_x,
         1.0::DOUBLE AS const_one, c.var_rta * 1000.0::DOUBLE + o.mo_avg_disc AS casi_target
  FROM clientes_k c LEFT JOIN order_lines o
    ON c.num_doc_key = CAST(o.num_doc AS VARCHAR) AND c.obl17_key = CAST(CAST(o.obl17 AS DECIMAL(38,0)) AS VARCHAR)
   AND c.f_analisis = o.f_analisis
  WHERE c.obl17_key IS NOT NULL)
"""


# --------------------------------------------------------------------------- P21, P22
@register("ratio_and_flag", oracle="""
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_extendedprice * l_tax = 0 THEN NULL ELSE (l_extendedprice * l_discount) / (l_extendedprice * l_tax) END, 6) AS ratio_digital,
       CASE WHEN CAST(l_quantity AS INTEGER) > 30 THEN 1 ELSE 0 END AS flag_mora_alta
FROM lineitem""")
def ratio_and_flag(spark, d):
    li = T.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_discount")).alias("monto_app"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("monto_total"), F.col("l_quantity").cast("int").alias("dias_mora"))
    out = create_features(li)
    return out.select("l_orderkey", "l_linenumber", r6(F.col("ratio_digital")).alias("ratio_digital"), "flag_mora_alta")


# --------------------------------------------------------------------------- P23, P24
@register("label_projection", oracle=S.with_(S.CLIENTES, S.CLIENTES_KEYS) + """
SELECT CAST(var_rta AS INTEGER) AS target_final, num_doc, obl17, f_analisis, segmento, prioridad, num_doc_key, obl17_key
FROM clientes_k WHERE obl17_key IS NOT NULL""")
def label_projection(spark, d):
    return split.add_label(keyed_clientes(spark, d))


# --------------------------------------------------------------------------- V1, A1
@register("hash_split_counts", oracle=S.with_(S.CLIENTES) + f"""
SELECT {S.md5_split('CAST(num_doc AS VARCHAR)')} AS split_group, count(*) AS n FROM clientes GROUP BY 1""")
def hash_split_counts(spark, d):
    return split.split_counts(split.with_hash_split(keyed_clientes(spark, d), "num_doc_key"))


# --------------------------------------------------------------------------- V2, V3, A2
@register("temporal_split_counts", oracle=S.with_(S.CLIENTES) + f"""
SELECT CASE WHEN f_analisis IS NULL THEN NULL WHEN f_analisis < DATE '{TRAIN_BEFORE}' THEN 'TRAIN'
            WHEN f_analisis >= DATE '{TEST_START}' AND f_analisis < DATE '{TEST_END}' THEN 'TEST' ELSE 'OOT' END AS split_group,
       var_rta AS target_final, count(*) AS n
FROM clientes GROUP BY 1, 2""")
def temporal_split_counts(spark, d):
    df = split.with_temporal_split(keyed_clientes(spark, d), TRAIN_BEFORE, TEST_START, TEST_END)
    split.require_splits(df)
    return df.groupBy("split_group", "target_final").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- X8
@register("latest_month_oot", oracle=S.with_(S.CLIENTES) + f"""
SELECT CASE WHEN date_trunc('month', f_analisis) = (SELECT max(date_trunc('month', f_analisis)) FROM clientes) THEN 'OOT'
            ELSE {S.md5_split('CAST(num_doc AS VARCHAR)')} END AS split_group, count(*) AS n
FROM clientes GROUP BY 1""")
def latest_month_oot(spark, d):
    base = split.with_hash_split(keyed_clientes(spark, d), "num_doc_key").withColumnRenamed("split_group", "_hash_split")
    base = base.withColumn("var_rta", F.col("target_final")).drop("target_final")
    df = split.with_latest_month_oot(base, test_fraction_col="_hash_split")
    return split.split_counts(df)


# --------------------------------------------------------------------------- P25, P26
@register("numeric_coerce_inf", oracle="""
SELECT p_partkey, round(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE), 6) AS price_txt,
       TRY_CAST(trim(p_brand) AS DOUBLE) AS brand_txt,
       CASE WHEN p_size > 45 OR p_size < 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size_inf
FROM part""")
def numeric_coerce_inf(spark, d):
    p = T.table(spark, d, "part")
    inf = float("inf")
    raw = p.select("p_partkey", F.col("p_retailprice").cast("string").alias("price_txt"), F.col("p_brand").alias("brand_txt"),
                   F.when(F.col("p_size") > 45, F.lit(inf)).when(F.col("p_size") < 3, F.lit(-inf))
                   .otherwise(F.col("p_size").cast("double")).alias("size_inf"))
    out = prep.coerce_numeric(raw, ["price_txt", "brand_txt", "size_inf"], keep=["p_partkey"])
    return out.withColumn("price_txt", r6(F.col("price_txt")))


@register("inf_counts", oracle="""
SELECT 'size_inf' AS column_name, count_if(p_size > 45 OR p_size < 3) AS n_inf FROM part
UNION ALL SELECT 'price_txt', CAST(0 AS BIGINT)""")
def inf_counts(spark, d):
    p = T.table(spark, d, "part")
    inf = float("inf")
    raw = p.select(F.col("p_retailprice").cast("string").alias("price_txt"),
                   F.when(F.col("p_size") > 45, F.lit(inf)).when(F.col("p_size") < 3, F.lit(-inf))
                   .otherwise(F.col("p_size").cast("double")).alias("size_inf"))
    return prep.infinite_counts(raw, ["size_inf", "price_txt"])


# --------------------------------------------------------------------------- P27, P29
@register("drop_null_cols_align", oracle=TRAIN_FRAME_SQL + """
SELECT obl17_key, NULL::DOUBLE AS tq_avg_price, mo_n_open FROM tf""")
def drop_null_cols_align(spark, d):
    tf = training_frame(spark, d)
    train = tf.filter(F.col("split_group") == "TRAIN").select("tq_avg_price", F.lit(None).cast("double").alias("vacia"), "mo_n_open")
    feats = [c for c in train.columns if c not in prep.all_null_columns(train, train.columns)]
    later = tf.select("obl17_key", "mo_n_open", "tq_std_price")
    return prep.align_features(later, feats, keep=["obl17_key"])


# --------------------------------------------------------------------------- P28
def _clip_sql(rows: str, cols: list[str], out_keys: str) -> str:
    b = ", ".join(f"quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}" for c in cols)
    sel = ", ".join(
        f"round(CASE WHEN {c} IS NULL THEN NULL WHEN lo_{c} IS NOT NULL AND hi_{c} IS NOT NULL AND hi_{c} > lo_{c} "
        f"THEN LEAST(GREATEST(CAST({c} AS DOUBLE), lo_{c}), hi_{c}) ELSE CAST({c} AS DOUBLE) END, 6) AS {c}" for c in cols)
    return TRAIN_FRAME_SQL + f", bnd AS (SELECT {b} FROM tf WHERE split_group = 'TRAIN')\nSELECT {out_keys}, {sel} FROM ({rows}) r, bnd"


@register("quantile_clip", oracle=_clip_sql("SELECT * FROM tf", CLIP_COLS, "obl17_key"))
def quantile_clip(spark, d):
    tf = training_frame(spark, d)
    bounds = prep.bounds_dict(prep.quantile_bounds(tf.filter(F.col("split_group") == "TRAIN"), CLIP_COLS))
    out = prep.apply_clip(tf.select("obl17_key", *[F.col(c).cast("double").alias(c) for c in CLIP_COLS]), bounds)
    return out.select("obl17_key", *[r6(F.col(c)).alias(c) for c in CLIP_COLS])


# --------------------------------------------------------------------------- M10, P30
@register("fitted_sanitise", oracle=_clip_sql("SELECT * FROM tf WHERE split_group <> 'TRAIN'",
                                              ["tq_avg_price", "tq_std_price", "mo_dias_mora"], "obl17_key, split_group"))
def fitted_sanitise(spark, d):
    tf = training_frame(spark, d).withColumn("vacia", F.lit(None).cast("string"))
    feats = prep.feature_candidates(["tq_avg_price", "tq_std_price", "mo_dias_mora", "vacia", "split_group", "num_doc_key"])
    train = tf.filter(F.col("split_group") == "TRAIN")
    _, kept, bounds = prep.sanitize_fit(train, feats)
    rest = tf.filter(F.col("split_group") != "TRAIN")
    out = prep.sanitize_apply(rest, kept, bounds, keep=["obl17_key", "split_group"])
    return out.select("obl17_key", "split_group", *[r6(F.col(c)).alias(c) for c in kept])


# --------------------------------------------------------------------------- A12, M9
def _corr_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        f = f"FILTER (WHERE {c} IS NOT NULL AND target_final IS NOT NULL)"
        parts.append(f"SELECT '{c}' AS column_name, covar_samp({x}, target_final) {f} AS cv, var_samp({x}) {f} AS vx, "
                     f"var_samp(target_final) {f} AS vy FROM tf WHERE split_group = 'TRAIN'")
    return "\nUNION ALL\n".join(parts)


@register("target_correlation", oracle=TRAIN_FRAME_SQL + "SELECT column_name, round(corr, 6) AS corr, "
          "COALESCE(abs(corr) >= 0.999, false) AS flagged FROM (SELECT column_name, CASE WHEN vx > 0 AND vy > 0 "
          "THEN cv / (sqrt(vx) * sqrt(vy)) END AS corr FROM (" + _corr_sql(LEAK_FEATURES) + "))")
def target_correlation(spark, d):
    train = training_frame(spark, d).filter(F.col("split_group") == "TRAIN")
    out = leakage.target_correlation(train, LEAK_FEATURES, "target_final")
    return out.select("column_name", r6(F.col("corr")).alias("corr"), "flagged")


# --------------------------------------------------------------------------- A13, P31
def _leak_sql() -> str:
    pat = "|".join(LEAK_NAME_PATTERNS).replace("'", "''")
    names = ", ".join(f"('{c}')" for c in LEAK_FEATURES)
    by_name = f"SELECT c AS column_name, 'name' AS reason FROM (VALUES {names}) v(c) WHERE regexp_matches(c, '{pat}', 'i')"
    perf = []
    for c in LEAK_FEATURES:
        x = f"CAST({c} AS DOUBLE)"
        perf.append(
            f"SELECT '{c}' AS column_name, COALESCE(bool_and({x} IS NULL OR {x} IN (0, 1)), false) AND count({x}) > 0 AS bin, "
            f"COALESCE(bool_and({x} IS NOT DISTINCT FROM CAST(target_final AS DOUBLE)), false) AS eq, "
            f"COALESCE(bool_and(1 - {x} IS NOT DISTINCT FROM CAST(target_final AS DOUBLE)), false) AS inv "
            f"FROM tf WHERE split_group = 'TRAIN'")
    perf_sql = "\nUNION ALL\n".join(perf)
    return (TRAIN_FRAME_SQL + f", nm AS ({by_name}),\n safe AS (SELECT * FROM (VALUES {names}) v(c) WHERE c NOT IN (SELECT column_name FROM nm)),\n"
            f" pf AS ({perf_sql}),\n cr AS (SELECT column_name, CASE WHEN vx > 0 AND vy > 0 THEN cv / (sqrt(vx) * sqrt(vy)) END AS corr "
            f"FROM ({_corr_sql(LEAK_FEATURES)}))\n"
            "SELECT * FROM nm\nUNION ALL SELECT column_name, 'perfect' FROM pf WHERE bin AND (eq OR inv) AND column_name IN (SELECT c FROM safe)\n"
            "UNION ALL SELECT column_name, 'corr' FROM cr WHERE abs(corr) >= 0.999 AND column_name IN (SELECT c FROM safe)")


@register("perfect_leak", oracle=_leak_sql())
def perfect_leak(spark, d):
    train = training_frame(spark, d).filter(F.col("split_group") == "TRAIN")
    return leakage.leakage_report(train, LEAK_FEATURES, "target_final")


# --------------------------------------------------------------------------- M4-M6
def _metric_sql(score_expr: str = "score", where: str = "") -> str:
    return S.with_(S.SCORES) + f""",
sc AS (SELECT split_group, target_final AS label, {score_expr} AS score FROM scores {where}),
g AS (SELECT split_group, score, sum(label) AS p, count(*) - sum(label) AS n FROM sc GROUP BY split_group, score),
c AS (SELECT split_group, score, p, n,
             sum(p) OVER (PARTITION BY split_group ORDER BY score DESC) AS cp,
             sum(n) OVER (PARTITION BY split_group ORDER BY score DESC) AS cn,
             sum(p) OVER (PARTITION BY split_group) AS tp, sum(n) OVER (PARTITION BY split_group) AS tn FROM g),
m AS (SELECT split_group, sum((cp - p) * n + 0.5 * p * n) / max(tp * tn) AS auc, max(cp / tp - cn / tn) AS ks,
             sum(p / tp * cp / (cp + cn)) AS ap FROM c GROUP BY split_group)
"""


@register("auc_ks_ap", oracle=_metric_sql() + "SELECT split_group, round(auc, 6) AS auc, round(ks, 6) AS ks, round(ap, 6) AS ap FROM m")
def auc_ks_ap(spark, d):
    out = metrics.ranking_metrics(T.scores(spark, d), label="target_final", score="score", by=["split_group"])
    return out.select("split_group", *[r6(F.col(c)).alias(c) for c in ("auc", "ks", "ap")])


# --------------------------------------------------------------------------- M7
@register("threshold_metrics", oracle=S.with_(S.SCORES) + """,
t AS (SELECT split_group, count_if(target_final = 0 AND score < 0.5) AS tn, count_if(target_final = 0 AND score >= 0.5) AS fp,
             count_if(target_final = 1 AND score < 0.5) AS fn, count_if(target_final = 1 AND score >= 0.5) AS tp
      FROM scores GROUP BY split_group)
SELECT split_group, round(COALESCE(tp / NULLIF(tp + fp, 0), 0), 6) AS precision, round(COALESCE(tp / NULLIF(tp + fn, 0), 0), 6) AS recall,
       round(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1, tn, fp, fn, tp FROM t""")
def threshold_metrics(spark, d):
    out = metrics.threshold_metrics(T.scores(spark, d), label="target_final", score="score", thr=0.5, by=["split_group"])
    return out.select("split_group", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "tn", "fp", "fn", "tp")


# --------------------------------------------------------------------------- M11-M13, X9
_RUN_SCORES = {"run_total": "score", "run_inverse": "1.0 - score", "run_leaky": "CAST(target_final AS DOUBLE)"}


def _runs_table(spark, d):
    sc = T.scores(spark, d)
    exprs = {"run_total": F.col("score"), "run_inverse": F.lit(1.0) - F.col("score"),
             "run_leaky": F.col("target_final").cast("double")}
    path = work_dir(spark, "model_runs")
    for run_id, e in exprs.items():
        m = metrics.ranking_metrics(sc.withColumn("_s", e), label="target_final", score="_s", by=["split_group"])
        vals = {r["split_group"]: r["auc"] for r in m.collect()}
        rec = runs.run_record(spark, "debito_recurrente", {"scorer": run_id}, dict(runs.REQUIRED_TAGS),
                              {"auc_test": vals.get("TEST"), "auc_oot": vals.get("OOT")},
                              features=["score"], run_id=run_id)
        runs.log_run(rec, path)
    return spark.read.parquet(path)


@register("run_log_best", oracle="\n".join([
    _metric_sql("score")
    + "SELECT 'run_total' AS run_id, round(auc, 6) AS metric_value, true AS tags_ok, 1 AS n_features FROM m WHERE split_group = 'OOT'"
    " AND auc >= 0.5"
    "\nUNION ALL\n"
    "SELECT 'run_inverse', round(1 - auc, 6), true, 1 FROM m WHERE split_group = 'OOT' AND auc < 0.5"]))
def run_log_best(spark, d):
    best = runs.best_run(_runs_table(spark, d), "auc_oot")
    return best.select("run_id", r6(F.col("metric_value")).alias("metric_value"), "tags_ok",
                       F.size("features").alias("n_features"))


def _stability_oracle() -> str:
    parts = []
    for run_id, expr in _RUN_SCORES.items():
        body = _metric_sql(expr)
        parts.append(f"SELECT '{run_id}' AS run_id, max(CASE WHEN split_group = 'TEST' THEN auc END) AS auc_test, "
                     f"max(CASE WHEN split_group = 'OOT' THEN auc END) AS auc_oot FROM ({body} SELECT * FROM m)")
    union = "\nUNION ALL\n".join(parts)
    return (f"SELECT run_id, round(auc_test, 6) AS auc_test, round(auc_oot, 6) AS auc_oot, "
            f"round(auc_test - auc_oot, 6) AS gap FROM ({union})")


@register("run_stability", oracle=_stability_oracle())
def run_stability(spark, d):
    from abtforge.operators.features import stability

    out = stability(_runs_table(spark, d))
    return out.select("run_id", *[r6(F.col(c)).alias(c) for c in ("auc_test", "auc_oot", "gap")])


# --------------------------------------------------------------------------- M1-M3, M8, M11-M15
def trained_run(spark, d):
    """One training run: the run row, its folder and the gold table.

    The analytic base table is materialised once (as the gold layer is), then read by training,
    evaluation and scoring.  Training splits by hash, so no date filter would prune partitions
    here: plain files (scoring.materialize_gold partitions by period for temporal splits).
    """
    from abtforge.operators import scoring

    base = work_dir(spark, "forest")
    gold_frame(spark, d).write.mode("overwrite").parquet(f"{base}/gold")
    gold = spark.read.parquet(f"{base}/gold")
    return scoring.train_and_log(gold, f"{base}/model_runs", f"{base}/model", run_id="forest_run", gold_table="gold"), base, gold


def _scored(spark, base, gold):
    from abtforge.operators import scoring

    return scoring.score_best(gold, f"{base}/model_runs", "scores_best", database="abt_model_results", table_path=f"{base}/scores_best")


@register("forest_scores")
def forest_scores(spark, d):
    _, base, gold = trained_run(spark, d)
    return _scored(spark, base, gold)


@register("forest_decisions")
def forest_decisions(spark, d):
    from abtforge.operators import scoring

    _, base, gold = trained_run(spark, d)
    out = scoring.refresh(spark, _scored(spark, base, gold), decisions_table="decision_final_v1", database="abt_model_results",
                          table_path=f"{base}/decision_final_v1")
    return out["counts"]


@register("forest_importances")
def forest_importances(spark, d):
    from pyspark.ml import PipelineModel

    res, _, _ = trained_run(spark, d)
    return model.feature_importances(PipelineModel.load(res.model_path), res.features, top=30)


# what SQL can say about a run without growing the forest itself: M9, M11, M13, M14
@register("forest_run_facts", oracle=TRAIN_FRAME_SQL + """
SELECT 'rows_' || lower(split_group) AS fact, count(*) AS n FROM tf GROUP BY split_group
UNION ALL SELECT 'scored_' || lower(split_group), count(*) FROM tf GROUP BY split_group
UNION ALL SELECT 'scores_outside_0_1', 0
UNION ALL SELECT 'features', """ + str(len([*T.MORAS_COLS, *T.TANQUE_COLS, *T.EXCEDENTES_COLS, *T.GESTIONES_COLS, *compact_feature_names()])) + """
UNION ALL SELECT 'planted_leaks_kept', 0""")
def forest_run_facts(spark, d):
    res, base, gold = trained_run(spark, d)
    scored = _scored(spark, base, gold)
    per = scored.groupBy("split_group").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("scored_"), F.lower("split_group")).alias("fact"), "n")
    outside = scored.agg(F.count_if(~F.col("score").between(0, 1) | F.col("score").isNull()).alias("n")).select(F.lit("scores_outside_0_1").alias("fact"), "n")
    leaks = {"estado_f", "estado_no_f", "label_x", "casi_target"}
    known = [(k, int(v)) for k, v in res.metrics.items() if k.startswith("rows_")]
    # a constant column is no leak and carries no signal: it is not counted as a feature here
    known += [("features", len(set(res.features) - {"const_one"})), ("planted_leaks_kept", len(leaks & set(res.features)))]
    return spark.createDataFrame(known, "fact string, n long").unionByName(per).unionByName(outside)


# A forest of one stump on few-valued features (does an order exceed 100 pieces?),
# which SQL can grow too
STUMP_FEATURES = ["mo_n_returned", "mo_n_open", "mo_dias_mora_w"]
_STUMP_SQL = TRAIN_FRAME_SQL + f""",
f AS (SELECT obl17_key, split_group, COALESCE(CAST(tq_sum_qty > 100 AS INTEGER), 0) AS y, mo_n_returned, mo_n_open, mo_dias_mora // 30 AS mo_dias_mora_w FROM tf),
med AS (SELECT {", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in STUMP_FEATURES)} FROM f WHERE split_group = 'TRAIN'),
x AS (SELECT f.obl17_key, f.split_group, f.y, {", ".join(f"COALESCE(f.{c}, med.{c}) AS {c}" for c in STUMP_FEATURES)} FROM f, med),
l AS ({" UNION ALL ".join(f"SELECT {i} AS feature, {c} AS v, y FROM x WHERE split_group = 'TRAIN'" for i, c in enumerate(STUMP_FEATURES))}),
v AS (SELECT feature, v, count(*) AS n, sum(y) AS p FROM l GROUP BY 1, 2),
c AS (SELECT feature, v, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER (PARTITION BY feature) AS n, sum(p) OVER (PARTITION BY feature) AS p
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY v)),
g AS (SELECT *, (nl * 2.0 * (pl / nl) * (1 - pl / nl) + (n - nl) * 2.0 * ((p - pl) / (n - nl)) * (1 - (p - pl) / (n - nl))) / n AS impurity
      FROM c WHERE nl < n),
best AS (SELECT * FROM g ORDER BY impurity, feature, v LIMIT 1),
s AS (SELECT x.obl17_key, x.split_group,
        CASE WHEN (b.pl * 2 > b.nl) = ((b.p - b.pl) * 2 > b.n - b.nl) THEN b.p / b.n  -- leaves that decide alike are merged
             WHEN (CASE b.feature {" ".join(f"WHEN {i} THEN x.{c}" for i, c in enumerate(STUMP_FEATURES))} END) <= b.v THEN b.pl / b.nl
             ELSE (b.p - b.pl) / (b.n - b.nl) END AS score
      FROM x, best b)
"""


def _one_tree(spark, d, depth: int):
    """(fitted model, frame): one tree of ``depth`` levels grown on TRAIN (no bootstrap, all features).  The frame is
    stored: training and scoring read it, and the sources are joined once."""
    week = F.floor(F.col("mo_dias_mora") / 30).cast("double").alias("mo_dias_mora_w")
    frame = training_frame(spark, d).select("obl17_key", "split_group", F.coalesce((F.col("tq_sum_qty") > 100).cast("int"), F.lit(0)).alias("target_final"), F.col("mo_n_returned").cast("double").alias("mo_n_returned"),
                                            F.col("mo_n_open").cast("double").alias("mo_n_open"), week)
    path = f"{work_dir(spark, 'one_tree')}/frame"
    frame.write.parquet(path)
    frame = spark.read.parquet(path)
    params = model.ForestParams(num_trees=1, max_depth=depth, min_instances_per_node=1, balanced=False, bootstrap=False, median_relative_error=0.0)
    return model.fit_forest(frame.where("split_group = 'TRAIN'"), STUMP_FEATURES, "target_final", params), frame


def _stump(spark, d):
    """Scores of every row by one depth-1 tree."""
    fitted, frame = _one_tree(spark, d, 1)
    return model.score(fitted, frame, ["obl17_key", "split_group"])


# A tree of two levels, its importances and the refresh with both labels.  The SQL grows level two
# below the best split of level one (``best``) and merges leaves that decide alike, from the bottom.
_OF = "CASE {f} " + " ".join(f"WHEN {i} THEN x.{c}" for i, c in enumerate(STUMP_FEATURES)) + " END"
_GINI = "2.0 * (({p}) / ({n})) * (1 - ({p}) / ({n}))"
_TREE_SQL = _STUMP_SQL + f""",
x2 AS (SELECT x.*, CASE WHEN {_OF.format(f="b.feature")} <= b.v THEN 0 ELSE 1 END AS side FROM x, best b),
l2 AS ({" UNION ALL ".join(f"SELECT side, {i} AS feature, {c} AS v, y FROM x2 WHERE split_group = 'TRAIN'" for i, c in enumerate(STUMP_FEATURES))}),
v2 AS (SELECT side, feature, v, count(*) AS n, sum(y) AS p FROM l2 GROUP BY 1, 2, 3),
c2 AS (SELECT side, feature, v, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER (PARTITION BY side, feature) AS n, sum(p) OVER (PARTITION BY side, feature) AS p
       FROM v2 WINDOW w AS (PARTITION BY side, feature ORDER BY v)),
g2 AS (SELECT *, {_GINI.format(p="p", n="n")} - (nl * {_GINI.format(p="pl", n="nl")} + (n - nl) * {_GINI.format(p="p - pl", n="(n - nl)")}) / n AS gain FROM c2 WHERE nl < n),
k2 AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY round(gain, 12) DESC, feature, v) AS place FROM g2 WHERE gain > 1e-9),
-- one row per child of the root: split again only if its two leaves decide differently
h AS (SELECT DISTINCT c2.side, c2.n, c2.p, k.feature, k.v, k.nl, k.pl, k.gain, k.side IS NOT NULL AS again
      FROM c2 LEFT JOIN (SELECT * FROM k2 WHERE place = 1 AND (pl * 2 > nl) <> ((p - pl) * 2 > n - nl)) k ON k.side = c2.side),
r AS (SELECT b.feature, b.v, b.n, b.p, {_GINI.format(p="b.p", n="b.n")} - b.impurity AS gain,
             bool_or(again) OR max(CASE WHEN h.p * 2 > h.n THEN 1 ELSE 0 END) <> min(CASE WHEN h.p * 2 > h.n THEN 1 ELSE 0 END) AS again
      FROM best b, h GROUP BY ALL),
s2 AS (SELECT x.obl17_key, x.split_group, CASE WHEN NOT r.again THEN r.p / r.n WHEN NOT h.again THEN h.p / h.n
             WHEN {_OF.format(f="h.feature")} <= h.v THEN h.pl / h.nl ELSE (h.p - h.pl) / (h.n - h.nl) END AS score
       FROM x2 x JOIN h ON h.side = x.side, r)
"""


@register("tree_scores", oracle=_TREE_SQL + "SELECT obl17_key, split_group, round(score, 6) AS score FROM s2")
def tree_scores(spark, d):
    fitted, frame = _one_tree(spark, d, 2)
    return model.score(fitted, frame, ["obl17_key", "split_group"]).withColumn("score", r6(F.col("score")))


@register("tree_importances", oracle=_TREE_SQL + f""",
i AS (SELECT feature, gain * n AS g FROM r WHERE again UNION ALL SELECT h.feature, h.gain * h.n FROM h, r WHERE h.again AND r.again)
SELECT f.name AS feature, round(coalesce(sum(g), 0) / greatest((SELECT sum(g) FROM i), 1e-300), 6) AS importance
FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(STUMP_FEATURES))}) f(k, name) LEFT JOIN i ON i.feature = f.k GROUP BY f.name""")
def tree_importances(spark, d):
    fitted, _ = _one_tree(spark, d, 2)
    out = model.feature_importances(fitted, STUMP_FEATURES)
    return out.select("feature", r6(F.col("importance")).alias("importance"))


@register("tree_refresh", oracle=_TREE_SQL + """
SELECT CASE WHEN score >= 0.5 THEN 'NO_ASIGNAR_GESTION' ELSE 'ASIGNAR_GESTION' END AS decision_label, split_group, count(*) AS n, round(min(score), 6) AS least, round(max(score), 6) AS most
FROM s2 GROUP BY 1, 2""")
def tree_refresh(spark, d):
    """The refresh over a stored score table: decisions with both labels, read back from the decision table."""
    import uuid

    from abtforge.operators import scoring
    from abtforge.sources import tables

    fitted, frame = _one_tree(spark, d, 2)
    keyed = model.score(fitted, frame.withColumn("num_doc_key", F.col("obl17_key")).withColumn("f_analisis", F.lit(None).cast("date")),
                        ["num_doc_key", "obl17_key", "f_analisis", "split_group"])
    name, base = uuid.uuid4().hex[:8], work_dir(spark, "tree_refresh")
    tables.save_table(keyed, f"scores_{name}", "abt_tree", mode="overwrite", path=f"{base}/scores")
    scores = tables.read_table(spark, f"scores_{name}", "abt_tree")
    out = scoring.refresh(spark, scores, policy="threshold", threshold=0.5, policy_version="tree", decisions_table=f"decisions_{name}", database="abt_tree", table_path=f"{base}/decisions")
    return out["decisions"].groupBy("decision_label", "split_group").agg(F.count(F.lit(1)).alias("n"), r6(F.min("score")).alias("least"), r6(F.max("score")).alias("most"))


@register("stump_scores", oracle=_STUMP_SQL + "SELECT obl17_key, split_group, round(score, 6) AS score FROM s")
def stump_scores(spark, d):
    return _stump(spark, d).select("obl17_key", "split_group", r6(F.col("score")).alias("score"))


@register("stump_decisions", oracle=_STUMP_SQL + """
SELECT CASE WHEN score >= 0.5 THEN 'NO_ASIGNAR_GESTION' ELSE 'ASIGNAR_GESTION' END AS decision_label, count(*) AS n FROM s GROUP BY 1""")
def stump_decisions(spark, d):
    from abtforge.operators import decide

    scores = _stump(spark, d).select("obl17_key", "split_group", "score")
    dec = decide.decisions(scores, policy="threshold", threshold=0.5, policy_version="stump", with_timestamp=False)
    return decide.decision_counts(dec)


# --------------------------------------------------------------------------- M4-M7 on labelled documents
_DOC_SCORE = "n_chars / (SELECT max(n_chars) FROM documents)"


@register("label_metrics", oracle=f"""
WITH sc AS (SELECT l.quality AS label, CAST(d.n_chars AS DOUBLE) / (SELECT max(n_chars) FROM documents) AS score
            FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM sc GROUP BY score),
c AS (SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn,
             sum(p) OVER () AS tp, sum(n) OVER () AS tn FROM g),
m AS (SELECT sum((cp - p) * n + 0.5 * p * n) / max(tp * tn) AS auc, max(cp / tp - cn / tn) AS ks,
             sum(p / tp * cp / (cp + cn)) AS ap FROM c),
t AS (SELECT count_if(label = 1 AND score >= 0.5) AS tp_, count_if(label = 0 AND score >= 0.5) AS fp_,
             count_if(label = 1 AND score < 0.5) AS fn_ FROM sc)
SELECT 'auc' AS metric, round(auc, 6) AS value FROM m
UNION ALL SELECT 'ks', round(ks, 6) FROM m
UNION ALL SELECT 'ap', round(ap, 6) FROM m
UNION ALL SELECT 'precision', round(COALESCE(tp_ / NULLIF(tp_ + fp_, 0), 0), 6) FROM t
UNION ALL SELECT 'recall', round(COALESCE(tp_ / NULLIF(tp_ + fn_, 0), 0), 6) FROM t""")
def label_metrics(spark, d):
    docs = T.table(spark, d, "documents")
    longest = docs.select(F.max("n_chars")).scalar()
    sc = T.table(spark, d, "labels").join(docs, on="doc_id", how="inner").select(
        F.col("quality").alias("label"), (F.col("n_chars").cast("double") / longest).alias("score"))
    rank = metrics.ranking_metrics(sc).unpivot([], ["auc", "ks", "ap"], "metric", "value")
    thr = metrics.threshold_metrics(sc, thr=0.5).unpivot([], ["precision", "recall"], "metric", "value")
    return rank.unionByName(thr).select("metric", r6(F.col("value")).alias("value"))
