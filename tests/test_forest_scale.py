"""The forest job: statistics a column of a batch at a time, no cache of the wide rows, compiled methods."""

import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.operators import model, prep, scoring
from abtforge.operators import quantiles as Q

QS = [0.0, 0.001, 0.3, 0.5, 0.999, 1.0]


def _odd_values(spark, n=6000):
    rnd = random.Random(3)
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0]
    rows = [(rnd.gauss(0, 1), float(i), rnd.choice(odd) if i % 3 else rnd.gauss(5, 2), float(rnd.randrange(3)), None, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, odd double, few double, none double, y int").repartition(5)


def _no_rows_per_value(*args, **more):
    raise AssertionError("one row per value")


def _exact(df, cols):
    return {(c, q): v for c in cols for q, v in zip(QS, df.agg(F.percentile(c, F.array(*map(F.lit, QS)))).first()[0] or [])}


def _same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, nan_ok=True), k


@pytest.mark.parametrize("most,batch", [(1 << 21, 10_000), (1, 64)])
def test_quantiles_of_columns_make_no_row_per_value(spark, monkeypatch, most, batch):
    monkeypatch.setattr(Q, "long_values", _no_rows_per_value)
    monkeypatch.setattr(Q, "THINNED_AT", most)  # thinned and handed on again and again
    monkeypatch.setattr(Q, "CELLS_AT", most)
    df = _odd_values(spark)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(batch))
    try:
        cols = ["a", "b", "few", "none"]
        got = {(r["column_name"], r["q"]): r["value"] for r in Q.exact_quantiles(df, cols, QS).collect()}
        odd = {r["q"]: r["value"] for r in Q.exact_quantiles(df, ["odd"], QS).collect()}
    finally:
        spark.conf.set(conf, before)
    _same(got, _exact(df, cols))
    assert odd[0.0] == float("-inf") and odd[1.0] != odd[1.0]  # NaN is the largest, NULL none
    known = [r["odd"] for r in df.where("odd IS NOT NULL").select("odd").collect()]
    order = sorted(x if x == x else float("inf") for x in known)
    place = 0.3 * (len(order) - 1)
    low = int(place)
    assert odd[0.3] == pytest.approx((low + 1 - place) * order[low] + (place - low) * order[low + 1], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("lo,hi", [(-9e9, -8e9), (8e9, 9e9), (1.0, 1.0), (float("nan"), float("nan"))])
def test_columns_whose_brackets_miss_still_give_the_exact_quantile(spark, monkeypatch, lo, hi):
    def wrong(qs, slack):
        def run(table):
            import pyarrow as pa

            n = len(qs)
            return pa.table({"_position": pa.array([table.column("_position")[0].as_py()] * n, pa.int32()), "q": pa.array(qs), "lo": pa.array([lo] * n), "hi": pa.array([hi] * n)})

        return run

    monkeypatch.setattr(Q, "long_values", _no_rows_per_value)
    monkeypatch.setattr(Q, "_around", wrong)
    df = _odd_values(spark, 1500)
    got = {(r["column_name"], r["q"]): r["value"] for r in Q.exact_quantiles(df, ["a", "b", "few"], QS).collect()}
    _same(got, _exact(df, ["a", "b", "few"]))


def test_brackets_of_columns_are_narrow(spark):
    """Of a column only its brackets' values are handed on."""
    df = spark.range(0, 400_000, 1, 4).select(F.array(((F.col("id") * 7919) % 400_009).cast("double")).alias("_values"))
    thin = df.mapInArrow(Q._thinning(1, Q._cuts([0.001, 0.999], Q.ACCURACY), Q.THINNED_AT), "_position int, value double, _w long")
    assert thin.agg(F.sum("_w")).first()[0] == 400_000
    at = [(r["q"], r["lo"], r["hi"]) for r in thin.groupBy("_position").applyInArrow(Q._around([0.001, 0.999], 2.0 / Q.ACCURACY), "_position int, q double, lo double, hi double").collect()]
    cells = df.mapInArrow(Q._cells(1, {0: at}, Q.CELLS_AT), "_position int, q double, cell int, value double, _c long")
    assert cells.agg(F.sum("_c")).first()[0] == 2 * 400_000
    assert cells.where("cell = 1").count() < 2 * 400_000 * 8 / Q.ACCURACY


def test_training_rows_are_not_cached_and_medians_are_exact(spark, monkeypatch):
    monkeypatch.setattr(Q, "long_values", _no_rows_per_value)
    df = _odd_values(spark, 3000).select("a", F.when(F.col("b") % 7 != 0, F.col("b")).alias("b"), "y").checkpoint()
    kept = []
    persist = DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: (kept.append(self.columns), persist(self, *level))[1])
    fitted = model.fit_forest(df, ["a", "b"], "y", model.ForestParams(num_trees=2, max_depth=2))
    assert kept == []
    values = sorted(r["b"] for r in df.where("b IS NOT NULL").select("b").collect())
    assert fitted.stages[0].surrogateDF.first()["b"] == values[(len(values) - 1) // 2]


def test_infinite_counts_of_numbers_and_text(spark, monkeypatch):
    from abtforge.operators import columnwise

    monkeypatch.setattr(columnwise, "column_stats", _no_rows_per_value)
    inf = float("inf")
    df = spark.createDataFrame([(inf, "Infinity", 1), (-inf, "x", None), (None, None, 3), (float("nan"), "-inf", 4)], "a double, t string, n int")
    assert {r["column_name"]: r["n_inf"] for r in prep.infinite_counts(df, ["a", "t", "n"]).collect()} == {"a": 2, "t": 2, "n": 0}
    assert {r["column_name"]: r["n_inf"] for r in prep.infinite_counts(df.limit(0), ["a", "n"]).collect()} == {"a": 0, "n": 0}
    assert prep.infinite_counts(df, []).collect() == []


def test_the_whole_training_run_uses_compiled_methods(spark, monkeypatch, tmp_path):
    rows = [(i % 2, ("TRAIN", "TRAIN", "TEST", "OOT")[i % 4 if i % 8 < 4 else (i + 1) % 4], str(i), float(i % 13), float(i * 7 % 11)) for i in range(400)]
    gold = spark.createDataFrame(rows, "target_final int, split_group string, num_doc_key string, u double, v double")
    limits, name = [], "spark.sql.codegen.hugeMethodLimit"

    def seen(of, attribute):
        inner = getattr(of, attribute)
        monkeypatch.setattr(of, attribute, lambda *a, **k: (limits.append((attribute, spark.conf.get(name))), inner(*a, **k))[1])

    for of, attribute in ((scoring.leakage, "leakage_report"), (scoring.prep, "sanitize_fit"), (scoring.model, "fit_forest"), (scoring.metrics, "ranking_metrics"), (scoring.prep, "infinite_counts")):
        seen(of, attribute)
    before = spark.conf.get(name)
    out = scoring.train_and_log(gold, f"{tmp_path}/runs", f"{tmp_path}/model", params=model.ForestParams(num_trees=2, max_depth=2))
    assert {a for a, _ in limits} == {"leakage_report", "sanitize_fit", "fit_forest", "ranking_metrics", "infinite_counts"}
    assert {limit for _, limit in limits} == {"8000"} and spark.conf.get(name) == before
    assert out.features == ["u", "v"] and out.metrics["n_inf_train"] == 0.0
