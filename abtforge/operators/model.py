"""Model (M1-M3, M8): median imputation + random forest with MLlib, scored in place.

Training, class weights, imputation and scoring are all distributed: the only things that
reach the driver are two class counts and the fitted model (trees and medians).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from abtforge.operators.quantiles import exact_medians
from abtforge.session import ensure_checkpoint_dir
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 100
    max_depth: int = 6
    min_instances_per_node: int = 20
    seed: int = 42
    balanced: bool = True
    bootstrap: bool = True
    median_relative_error: float = 0.001
    # Execution settings (the trees do not change): a larger per-executor budget for split
    # statistics means fewer passes over the data per tree level.  Cached node ids (with
    # checkpoints every few iterations) pay off for deep trees only.
    max_memory_mb: int = 1024
    cache_node_ids: bool = False
    checkpoint_interval: int = 10


def class_weight_column(df: DataFrame, label: str, out: str = "_w") -> DataFrame:
    """Balanced weights n / (classes * n_class) for the two classes 0 and 1.

    The counts are conditional sums (one row, whatever the label column holds); any other label
    value, NULL included, is an error.
    """
    y = F.col(label)
    n = df.agg(F.count(F.lit(1)).alias("all"), F.count_if(y == 0).alias("zero"), F.count_if(y == 1).alias("one")).first()
    if n["zero"] + n["one"] != n["all"]:
        raise ValueError(f"{label} holds {n['all'] - n['zero'] - n['one']} rows that are neither 0 nor 1")
    classes = (n["zero"] > 0) + (n["one"] > 0)
    weight = lambda count: F.lit(n["all"] / (classes * count) if count else 1.0)
    return df.withColumn(out, F.when(y == 1, weight(n["one"])).otherwise(weight(n["zero"])))


def _exact_median_row(data: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row with the median of every feature.

    The imputer's own summaries are merged in one task, and without an allowed error they keep every value.  The row
    stands for the data instead, since the median of one value is that value; an exact median is within any
    allowed error.
    """
    medians = exact_medians(data, features)
    return data.sparkSession.createDataFrame([tuple(medians.get(f) for f in features)], ", ".join(f"`{f}` double" for f in features))


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "target_final",
               params: ForestParams = ForestParams()) -> PipelineModel:
    features = list(features)
    ensure_checkpoint_dir(train.sparkSession)
    imputed = [f"_imp_{i}" for i in range(len(features))]
    imputer = Imputer(strategy="median", inputCols=features, outputCols=imputed, relativeError=params.median_relative_error)
    stages = [
        VectorAssembler(inputCols=imputed, outputCol="_features", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=params.num_trees,
                               maxDepth=params.max_depth, minInstancesPerNode=params.min_instances_per_node,
                               seed=params.seed, bootstrap=params.bootstrap, **({"weightCol": "_w"} if params.balanced else {}),
                               probabilityCol="_probability", rawPredictionCol="_raw",
                               predictionCol="_prediction", maxMemoryInMB=params.max_memory_mb,
                               cacheNodeIds=params.cache_node_ids,
                               checkpointInterval=params.checkpoint_interval),
    ]
    data = train.withColumn("_label", F.col(label).cast("double"))
    # The training rows are read from their (stored) table by each of the few passes and not cached: as numbers they are
    # several times as large as the table, and MLlib keeps its own binned copy for the tree levels.
    medians = _exact_median_row(data, features)
    data = class_weight_column(data, "_label") if params.balanced else data
    return Pipeline(stages=[imputer.fit(medians), *stages]).fit(data)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], out: str = "score") -> DataFrame:
    """``keep`` columns plus P(class 1) as ``out``."""
    pred = model.transform(df)
    return pred.select(*keep, vector_to_array(F.col("_probability"))[1].alias(out))


def feature_importances(model: PipelineModel, features: Sequence[str], top: int | None = 30) -> DataFrame:
    """(feature, importance) in descending order (ties by name)."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top) if top else df
