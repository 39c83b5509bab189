"""Classifier metrics (M4-M7) as distributed aggregates.

ROC AUC, KS and average precision need cumulative positive/negative counts in descending
score order.  A window without ``PARTITION BY`` would put every distinct score in one task,
so the prefix sums are built in two levels instead:

1. rows -> one row per (group, distinct score) with positives ``p`` and negatives ``n``
   (partial aggregation, so hot scores cost nothing extra);
2. range-partition those rows by (group, score desc) into ``P`` slices of similar size,
   tag each row with its slice id and cut lineage (``checkpoint``) so the tag is fixed;
3. running sums inside each slice (a window partitioned by slice) plus, per slice, the
   totals of all earlier slices of the same group (a window over at most groups x P rows);
4. global running sum = slice offset + local running sum; the metrics are plain sums and
   maxima of per-row terms.

Tied scores are one row, so ties get the usual half credit in AUC and one step in AP.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtforge.session import ensure_checkpoint_dir

SLICE_ROWS = 1 << 20


def _score_groups(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("long")
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("_s"))
            .agg(F.sum(y).alias("_p"), (F.count(F.lit(1)) - F.sum(y)).alias("_n")))


def cumulative_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
                      slices: int | None = None) -> DataFrame:
    """Per (group, distinct score): p, n and the cumulative cp, cn (score descending) plus
    group totals tp, tn."""
    by = list(by)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    g = _score_groups(df, label, score, by)
    order = [*[F.col(b) for b in by], F.col("_s").desc()]
    if not slices:  # follow the number of distinct scores, so that a slice stays small at any size
        g = g.checkpoint(eager=True)
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-g.count() // SLICE_ROWS))
    ranged = (g.repartitionByRange(slices, *order)
              .withColumn("_slice", F.spark_partition_id())
              .checkpoint(eager=True))
    local_w = Window.partitionBy(*by, "_slice").orderBy(F.col("_s").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(*by, "_slice", "_s", "_p", "_n",
                          F.sum("_p").over(local_w).alias("_lcp"), F.sum("_n").over(local_w).alias("_lcn"))
    tot = ranged.groupBy(*by, "_slice").agg(F.sum("_p").alias("_sp"), F.sum("_n").alias("_sn"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    off = tot.select(*by, "_slice",
                     F.coalesce(F.sum("_sp").over(before), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_sn").over(before), F.lit(0)).alias("_on"),
                     F.sum("_sp").over(whole).alias("tp"),
                     F.sum("_sn").over(whole).alias("tn"))
    j = local.join(off, on=[*by, "_slice"], how="inner")
    return j.select(*by, F.col("_s").alias("score"), F.col("_p").alias("p"), F.col("_n").alias("n"),
                    (F.col("_op") + F.col("_lcp")).alias("cp"), (F.col("_on") + F.col("_lcn")).alias("cn"),
                    "tp", "tn")


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
                    slices: int | None = None) -> DataFrame:
    """ROC AUC, KS = max(TPR - FPR), average precision (step sum), per group of ``by``.

    NULL when a group has only one class.
    """
    by = list(by)
    c = cumulative_counts(df, label, score, by, slices)
    p, n, cp, cn = (F.col(x).cast("double") for x in ("p", "n", "cp", "cn"))
    tp, tn = F.col("tp").cast("double"), F.col("tn").cast("double")
    agg = c.groupBy(*by).agg(
        F.sum((cp - p) * n + F.lit(0.5) * p * n).alias("_auc_num"),
        F.max(F.try_divide(cp, tp) - F.try_divide(cn, tn)).alias("_ks"),
        F.sum(F.try_divide(p, tp) * F.try_divide(cp, cp + cn)).alias("_ap"),
        F.max(tp).alias("_tp"), F.max(tn).alias("_tn"),
    )
    ok = (F.col("_tp") > 0) & (F.col("_tn") > 0)
    return agg.select(
        *by,
        F.when(ok, F.try_divide(F.col("_auc_num"), F.col("_tp") * F.col("_tn"))).alias("auc"),
        F.when(ok, F.col("_ks")).alias("ks"),
        F.when(ok, F.col("_ap")).alias("ap"),
    )


def threshold_metrics(df: DataFrame, label: str = "label", score: str = "score", thr: float = 0.5,
                      by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 (0 when undefined) and tn/fp/fn/tp with prediction ``score >= thr``."""
    y = F.col(label).cast("int") == 1
    yhat = F.col(score) >= F.lit(thr)
    agg = df.groupBy(*by).agg(
        F.count_if(~y & ~yhat).alias("tn"), F.count_if(~y & yhat).alias("fp"),
        F.count_if(y & ~yhat).alias("fn"), F.count_if(y & yhat).alias("tp"))
    tp, fp, fn = (F.col(x).cast("double") for x in ("tp", "fp", "fn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return agg.select(*by, prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), "tn", "fp", "fn", "tp")
