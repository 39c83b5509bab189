"""Run records (M11-M13): one row per training run in a ``model_runs`` table.

The table replaces an experiment-tracking service: params, tags and metrics are maps,
the feature list and dropped columns are arrays, clip bounds a map of arrays.  Picking the
best run is a filter and an ordering, evaluated by Spark.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = (
    "run_id string, experiment string, created_at timestamp, params map<string,string>, "
    "tags map<string,string>, metrics map<string,double>, features array<string>, "
    "dropped array<string>, bounds map<string,array<double>>, model_path string"
)

# Tags a run must carry to be preferred, and the AUC above which a run is
# treated as leaking.
REQUIRED_TAGS = {"objective": "debito_recurrente_only", "model_family": "RandomForest"}
MAX_REASONABLE_METRIC = 0.999


def run_record(spark: SparkSession, experiment: str, params: Mapping[str, object], tags: Mapping[str, str],
               metrics: Mapping[str, float | None], features: Sequence[str], dropped: Sequence[str] = (),
               bounds: Mapping[str, tuple[float, float]] | None = None, model_path: str | None = None,
               run_id: str | None = None, created_at: dt.datetime | None = None) -> DataFrame:
    row = (run_id or uuid.uuid4().hex, experiment, created_at or dt.datetime.now(),
           {k: str(v) for k, v in params.items()}, dict(tags),
           {k: (None if v is None else float(v)) for k, v in metrics.items()},
           list(features), list(dropped), {k: [float(a), float(b)] for k, (a, b) in (bounds or {}).items()},
           model_path)
    return spark.createDataFrame([row], RUNS_SCHEMA)


def log_run(record: DataFrame, path: str) -> None:
    """Append a run row to the runs table at ``path`` (Parquet)."""
    record.write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str = "auc_oot", experiment: str | None = None,
             required_tags: Mapping[str, str] = REQUIRED_TAGS,
             max_metric: float = MAX_REASONABLE_METRIC) -> DataFrame:
    """The best run: metric present and below ``max_metric``; runs with all required tags
    first, then by metric descending (latest first on ties).  Empty when none qualifies."""
    m = F.col("metrics")[metric]
    tags_ok = F.lit(True)
    for k, v in required_tags.items():
        tags_ok = tags_ok & F.coalesce(F.col("tags")[k] == F.lit(v), F.lit(False))
    df = runs if experiment is None else runs.filter(F.col("experiment") == experiment)
    return (df.filter(m.isNotNull() & ~F.isnan(m) & (m < F.lit(max_metric)))
            .withColumn("tags_ok", tags_ok).withColumn("metric_value", m)
            .orderBy(F.desc("tags_ok"), F.desc("metric_value"), F.desc("created_at"), F.asc("run_id"))
            .limit(1))


def require_best(best: DataFrame, metric: str = "auc_oot"):
    row = best.first()
    if row is None:
        raise RuntimeError(f"no valid run with {metric}")
    return row
