import random

import pytest
from pyspark.sql import functions as F

from abtforge.operators import leakage, metrics


def brute(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    thr = sorted(set(scores), reverse=True)
    ks, ap, prev_recall = 0.0, 0.0, 0.0
    for t in thr:
        tp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 0)
        ks = max(ks, tp / len(pos) - fp / len(neg))
        recall = tp / len(pos)
        ap += (recall - prev_recall) * tp / (tp + fp)
        prev_recall = recall
    return auc, ks, ap


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranking_metrics_match_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.ranking_metrics(df, slices=5).first()
    auc, ks, ap = brute([r[0] for r in rows], [r[1] for r in rows])
    assert got["auc"] == pytest.approx(auc) and got["ks"] == pytest.approx(ks) and got["ap"] == pytest.approx(ap)


def test_ranking_metrics_by_group_and_single_class(spark):
    rows = [("A", 1, 0.9), ("A", 0, 0.1), ("A", 1, 0.4), ("A", 0, 0.6), ("B", 1, 0.5), ("B", 1, 0.7)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r for r in metrics.ranking_metrics(df, by=["g"], slices=3).collect()}
    assert got["A"]["auc"] == pytest.approx(0.75)
    assert got["B"]["auc"] is None  # one class only


def test_threshold_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    r = metrics.threshold_metrics(df, thr=0.5).first()
    assert (r["precision"], r["recall"], r["f1"], r["tn"], r["fp"], r["fn"], r["tp"]) == (0.0, 0.0, 0.0, 2, 0, 0, 0)


def _leak_frame(spark):
    rows = []
    for i in range(200):
        y = i % 2
        rows.append((y, float(y), float(1 - y), float(y), 1.0, y * 1000.0 + (i % 7) / 100.0, float(i), None if i == 0 else float(y)))
    return spark.createDataFrame(rows, "y int, copy double, comp double, target_x double, const double, near double, noise double, copy_null double")


def test_target_correlation_guards_constants(spark):
    df = _leak_frame(spark)
    got = {r["column_name"]: r for r in leakage.target_correlation(df, ["copy", "const", "near", "noise"], "y").collect()}
    assert got["copy"]["flagged"] and got["near"]["flagged"]
    assert got["const"]["corr"] is None and not got["const"]["flagged"]
    assert not got["noise"]["flagged"]


def test_leakage_report_reasons(spark):
    df = _leak_frame(spark)
    rep = {(r["column_name"], r["reason"]) for r in
           leakage.leakage_report(df, ["copy", "comp", "target_x", "const", "noise", "copy_null"], "y").collect()}
    assert ("target_x", "name") in rep
    assert ("copy", "perfect") in rep and ("comp", "perfect") in rep
    # a NULL where the target is not NULL is not a perfect copy (NULL-safe equality)
    assert ("copy_null", "perfect") not in rep
    assert not any(c == "const" for c, _ in rep) and not any(c == "noise" for c, _ in rep)
    assert leakage.columns_to_drop(leakage.leakage_report(df, ["copy", "noise"], "y")) == ["copy"]
