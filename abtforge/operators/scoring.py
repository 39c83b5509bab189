"""Training run, batch scoring and decision refresh as Spark jobs.

``train_and_log``   fit on TRAIN, evaluate TEST/OOT, save the model, append a run row
``score_best``      best run -> its model, features and TRAIN clip bounds -> score every row
                    -> score table + ``top_scores`` view
``refresh``         scores -> decision table, decision counts and run metadata

Only run metadata (tens of values) and the fitted model cross the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtforge.functions import names
from abtforge.operators import decide, leakage, metrics, model, prep, runs, split
from abtforge.session import compiled_methods
from abtforge.sources import tables

KEEP = ("num_doc", "obl17", "num_doc_key", "obl17_key", "f_analisis", "split_group", "target_final")


@dataclass
class TrainResult:
    run_id: str
    features: list
    dropped: list
    bounds: dict
    metrics: dict
    model_path: str


def materialize_gold(gold: DataFrame, table: str, database: str = "gold", path: str | None = None,
                     date_col: str = "f_analisis", grain: str = "month") -> DataFrame:
    """Write the analytic base table partitioned by analysis period (``<date_col>_<grain>``,
    the period's first day) and read it back: temporal splits, latest-month OOT and date
    lookups then prune partitions.  ``month`` suits monthly snapshots; ``year`` suits daily
    dates over many years (fewer, larger partitions)."""
    part = f"{date_col}_{grain}"
    out = gold.withColumn(part, F.trunc(F.col(date_col).cast("date"), grain))
    tables.save_table(out, table, database, mode="overwrite", path=path, partition_by=[part])
    return gold.sparkSession.table(f"`{database}`.`{table}`")


# types that have a meaning as a number (text as far as it parses)
_AS_NUMBER = (T.NumericType, T.BooleanType, T.StringType)


def _feature_columns(gold: DataFrame, cols: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """(columns that become features, {column: type} of those whose type has no number form)."""
    kinds = {f.name: f.dataType for f in gold.schema.fields}
    usable = [c for c in cols if isinstance(kinds[c], _AS_NUMBER)]
    return usable, {c: kinds[c].simpleString() for c in cols if c not in set(usable)}


def train_and_log(gold: DataFrame, runs_path: str, model_path: str, experiment: str = "debito_recurrente",
                  params: model.ForestParams = model.ForestParams(), threshold: float = 0.5,
                  exclude: Sequence[str] = prep.DEFAULT_EXCLUDE, run_id: str | None = None,
                  tags: Mapping[str, str] | None = None, gold_table: str | None = None) -> TrainResult:
    """Leakage removal found on TRAIN, sanitise, fit, evaluate, log.

    Raises when a needed column or a split is missing.  The run row also records the rows per
    split, infinite values per column of TRAIN (their sum), the gold table's name and the columns
    left out because of their type.
    """
    # every pass over the wide table runs in methods that the JVM compiles
    with compiled_methods(gold.sparkSession):
        return _train_and_log(gold, runs_path, model_path, experiment, params, threshold, exclude, run_id, tags, gold_table)


def _train_and_log(gold: DataFrame, runs_path: str, model_path: str, experiment: str, params: model.ForestParams, threshold: float,
                   exclude: Sequence[str], run_id: str | None, tags: Mapping[str, str] | None, gold_table: str | None) -> TrainResult:
    spark = gold.sparkSession
    keep = [k for k in KEEP if k in gold.columns]
    names.require_columns(gold.columns, ["split_group", "target_final"], "the gold table")
    rows_per_split = split.require_splits(gold)
    cands, by_type = _feature_columns(gold, [c for c in prep.feature_candidates(gold.columns, exclude) if c not in keep])
    train = gold.filter(F.col("split_group") == "TRAIN")
    dropped = leakage.columns_to_drop(leakage.leakage_report(train, cands, "target_final"))
    feats = [c for c in cands if c not in set(dropped)]
    clean_train, kept, bounds = prep.sanitize_fit(train, feats, keep=keep)
    mdl = model.fit_forest(clean_train, kept, "target_final", params)
    mdl.write().overwrite().save(model_path)

    held = prep.sanitize_apply(gold.filter(F.col("split_group").isin("TEST", "OOT")), kept, bounds, keep=keep)
    # two evaluations read the held-out scores: score once (lost blocks are recomputed)
    scored = model.score(mdl, held, ["split_group", "target_final"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rank = {r["split_group"]: r for r in
                metrics.ranking_metrics(scored, "target_final", "score", by=["split_group"]).collect()}
        thr = {r["split_group"]: r for r in
               metrics.threshold_metrics(scored, "target_final", "score", threshold, by=["split_group"]).collect()}
    finally:
        scored.unpersist()
    m: dict = {"n_features_final": float(len(kept))}
    for s, tag in (("TEST", "test"), ("OOT", "oot")):
        if s in rank:
            m[f"auc_{tag}"], m[f"ks_{tag}"], m[f"ap_{tag}"] = rank[s]["auc"], rank[s]["ks"], rank[s]["ap"]
        if s in thr:
            for k in ("precision", "recall", "f1"):
                m[f"{k}_{tag}_thr_{threshold}"] = thr[s][k]
            for k in ("tn", "fp", "fn", "tp"):  # the confusion matrix at the threshold
                m[f"{k}_{tag}_thr_{threshold}"] = float(thr[s][k])
    infinite = prep.infinite_counts(train, kept).agg(F.coalesce(F.sum("n_inf"), F.lit(0)).alias("n")).first()["n"]
    m |= {"n_inf_train": float(infinite)} | {f"rows_{s.lower()}": float(n) for s, n in rows_per_split.items()}
    p = {"num_trees": params.num_trees, "max_depth": params.max_depth,
         "min_instances_per_node": params.min_instances_per_node, "seed": params.seed,
         "balanced": params.balanced, "threshold_metrics": threshold,
         "gold_table": gold_table or "", "splits": ",".join(sorted(rows_per_split))}
    p |= {f"dropped_type_{c}": t for c, t in by_type.items()}
    rec = runs.run_record(spark, experiment, p, dict(tags or runs.REQUIRED_TAGS), m, kept, dropped, bounds,
                          model_path, run_id=run_id)
    runs.log_run(rec, runs_path)
    return TrainResult(rec.first()["run_id"], kept, dropped, bounds, m, model_path)


def score_best(gold: DataFrame, runs_path: str, scores_table: str, database: str = "model_results",
               metric: str = "auc_oot", table_path: str | None = None, top_n: int = 200) -> DataFrame:
    """Best run -> model, features, bounds -> scores of every row -> table + view."""
    spark = gold.sparkSession
    best = runs.require_best(runs.best_run(spark.read.parquet(runs_path), metric), metric)
    names.require_columns(gold.columns, ["split_group"], "the gold table")
    # a run row without features falls back to the candidates by exclusion
    features = list(best["features"] or _feature_columns(gold, prep.feature_candidates(gold.columns))[0])
    bounds = {k: (v[0], v[1]) for k, v in (best["bounds"] or {}).items()}
    mdl = PipelineModel.load(best["model_path"])
    keep = [k for k in KEEP if k in gold.columns]
    ready = prep.sanitize_apply(gold, features, bounds, keep=keep)
    scored = model.score(mdl, ready, keep)
    out = decide.score_projection(scored, best["run_id"], metric, best["metrics"][metric],
                                  keys=[k for k in keep if k not in ("split_group", "target_final")])
    with compiled_methods(spark):
        tables.save_table(out, scores_table, database, mode="overwrite", path=table_path, expected_rows=gold.count())
    saved = spark.table(f"`{database}`.`{scores_table}`")
    tables.create_view(decide.top_scores(saved, top_n), f"top_scores_{scores_table}")
    return saved


def refresh(spark: SparkSession, scores: DataFrame, policy: str = "eq_1", threshold: float = 1.0,
            policy_version: str = decide.DEFAULT_POLICY, arrears_col: str | None = None,
            decisions_table: str | None = None, database: str = "model_results",
            table_path: str | None = None, buckets: int | None = None) -> dict:
    """Decisions (saved when a table name is given), counts, and the run metadata row.

    The saved decision table is bucketed and sorted by client key, so the lookups by client
    read one bucket instead of the whole table; ``<decisions_table>_by_obligation`` (``index``), bucketed by
    obligation, does the same for the lookups by obligation.
    """
    index = None
    dec = decide.decisions(scores, policy=policy, threshold=threshold, policy_version=policy_version,
                           arrears_col=arrears_col)
    if decisions_table:
        tables.save_table(dec, decisions_table, database, mode="overwrite", path=table_path,
                          bucket_by=["num_doc_key"], buckets=buckets, sort_by=["num_doc_key", "obl17_key"], expected_rows=scores.count())
        dec = spark.table(f"`{database}`.`{decisions_table}`")
        by_obligation = f"{decisions_table}_by_obligation"
        tables.save_table(decide.obligation_index(dec), by_obligation, database, mode="overwrite", path=f"{table_path}_by_obligation" if table_path else None,
                          bucket_by=["obl17_key"], buckets=buckets, sort_by=["obl17_key", "num_doc_key"])
        index = spark.table(f"`{database}`.`{by_obligation}`")
    meta_cols = [c for c in ("run_id", "auc_oot") if c in dec.columns]
    return {"decisions": dec, "index": index, "counts": decide.decision_counts(dec),
            "meta": dec.select(*meta_cols).limit(1) if meta_cols else None}
