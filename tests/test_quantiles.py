import random

import pytest
from pyspark.sql import functions as F

from abtforge.operators.quantiles import exact_quantiles, pivot_quantiles

QS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("seed,slices", [(1, 1), (2, 4), (3, 13)])
def test_exact_quantiles_equal_spark_percentile(spark, seed, slices):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b"])
        v = 7.0 if g == "hot" and i % 2 == 0 else round(rnd.gauss(0, 10), 2)  # a value with many copies
        rows.append((g, v, None if i % 17 == 0 else float(i % 50)))
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = pivot_quantiles(exact_quantiles(df, ["x", "y"], QS, by=["g"], slices=slices), ["g", "column_name"], QS,
                          [f"q{i}" for i in range(len(QS))])
    ref = df.unpivot(["g"], ["x", "y"], "column_name", "value").groupBy("g", "column_name").agg(
        F.percentile("value", F.array(*[F.lit(q) for q in QS])).alias("p"))
    r = {(x["g"], x["column_name"]): x["p"] for x in ref.collect()}
    for row in got.collect():
        exp = r[(row["g"], row["column_name"])]
        for i in range(len(QS)):
            assert row[f"q{i}"] == pytest.approx(exp[i], rel=1e-12, abs=1e-12)
    assert got.count() == len(r)


def test_single_value_and_empty_group(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "g string, x double")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {"a": 5.0}


@pytest.mark.parametrize("accuracy", [10, 100])
def test_coarse_sketch_still_gives_exact_quantiles(spark, accuracy):
    """Brackets from a sketch far coarser than the data: outer values are only counted."""
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_011).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id")).alias("y"))
    got = {(r["column_name"], r["q"]): r["value"] for r in exact_quantiles(df, ["x", "y"], QS, accuracy=accuracy).collect()}
    for c in ("x", "y"):
        ref = df.agg(F.percentile(c, F.array(*[F.lit(q) for q in QS]))).first()[0]
        assert [got[(c, q)] for q in QS] == pytest.approx(ref, rel=1e-12)


def test_quantiles_shuffle_only_brackets(spark):
    """The source is read twice, and no more than the values inside the brackets is kept."""
    from abtforge.operators import quantiles as Q

    df = spark.range(200_000).select(F.col("id").cast("double").alias("x"))
    long = Q.long_values(df, ["x"])
    dist = Q.bracketed_distribution(long, Q.brackets(long, [], [0.5, 0.9]), [])
    assert dist.count() < 2 * 200_000 * 8 / Q.ACCURACY + 4
    assert [r["_c"] for r in dist.agg(F.sum("_c").alias("_c")).collect()] == [400_000]


@pytest.mark.parametrize("lo,hi", [(-5.0, -1.0), (300.0, 400.0), (10.0, 10.0), (90.0, 95.0), (None, 3.0), (60.0, None), (49.4, 49.6)])
def test_brackets_that_miss_their_rank_still_give_the_exact_value(spark, lo, hi):
    """Whatever a bracket says, the counts prove or refute it."""
    from abtforge.operators import quantiles as Q

    df = spark.range(1000).select((F.col("id") % 2).cast("string").alias("g"), (F.col("id") * 7 % 100 + 0.0).alias("x"), F.lit(2.5).alias("y"))
    qs = [0.0, 0.1, 0.5, 0.505, 0.97, 1.0]
    long = Q.long_values(df, ["x", "y"], ["g"])
    wrong = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")) for q in qs])
    bounds = long.groupBy("g", "_position").count().select("g", "_position", wrong.alias("_brackets"))
    got = {(r["g"], r["_position"], r["q"]): r["value"] for r in Q.proven_quantiles(long, bounds, ["g"], 3).collect()}
    for r in df.groupBy("g").agg(*[F.percentile(c, F.array(*[F.lit(q) for q in qs])).alias(c) for c in ("x", "y")]).collect():
        for k, c in enumerate(("x", "y")):
            assert [got[r["g"], k, q] for q in qs] == pytest.approx(r[c], rel=1e-12)
    assert len(got) == 4 * len(qs)


def test_default_slices_follow_the_data(spark):
    # no explicit slice count: results must equal Spark's percentile and brute-force AUC
    import random

    from abtforge.operators.metrics import ranking_metrics

    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), rnd.random()) for _ in range(5000)]
    df = spark.createDataFrame(rows, "label int, score double")
    with_q = exact_quantiles(df, ["score"], [0.1, 0.5, 0.9])
    ref = df.agg(F.percentile("score", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()[0]
    got = {r["q"]: r["value"] for r in with_q.collect()}
    assert [got[0.1], got[0.5], got[0.9]] == pytest.approx(ref, rel=1e-12)
    pos = sorted(s for y, s in rows if y == 1)
    neg = sorted(s for y, s in rows if y == 0)
    import bisect

    auc = sum(bisect.bisect_left(neg, p) for p in pos) / (len(pos) * len(neg))
    assert ranking_metrics(df).first()["auc"] == pytest.approx(auc, rel=1e-9)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                       min_size=1, max_size=80),
       qs=st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4, unique=True),
       slices=st.integers(1, 6))
def test_exact_quantiles_property(spark, values, qs, slices):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, ["x"], qs, slices=slices).collect()}
    present = [v for v in values if v is not None]
    if not present:
        assert got == {}
        return
    ref = df.agg(F.percentile("x", F.array(*[F.lit(q) for q in qs]))).first()[0]
    for q, r in zip(qs, ref):
        assert got[q] == pytest.approx(r, rel=1e-9, abs=1e-9)


def test_exact_medians_are_lower_medians_and_reach_the_imputer_as_one_row(spark, monkeypatch):
    from pyspark.ml.feature import Imputer

    from abtforge.operators import model
    from abtforge.operators.quantiles import exact_medians

    rng = random.Random(11)
    rows = [(rng.choice([None, float("nan"), float(rng.randrange(9))]), rng.gauss(0, 1e6), None, i % 2) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(5)
    known = {c: sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i]) for i, c in enumerate("ab")}
    want = {c: v[(len(v) - 1) // 2] for c, v in known.items()}
    assert exact_medians(df, ["a", "b", "c"]) == want
    seen, fit = [], Imputer.fit
    monkeypatch.setattr(Imputer, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    params = model.ForestParams(num_trees=1, max_depth=1, balanced=False, bootstrap=False, median_relative_error=0.0)
    fitted = model.fit_forest(df, ["a", "b"], "y", params)
    assert seen == [1] and tuple(fitted.stages[0].surrogateDF.first()) == (want["a"], want["b"])


def test_a_value_enters_the_bracket_scan_once_for_all_quantiles(spark):
    from abtforge.operators import quantiles as Q
    from abtforge.session import compiled_methods

    df = spark.createDataFrame([(float(i % 97),) for i in range(400)], "x double")
    long = Q.long_values(df, ["x"])
    bounds = Q.brackets(long, [], [0.1, 0.5, 0.9], accuracy=100)
    with compiled_methods(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        dist = Q.bracketed_distribution(long, bounds, []).collect()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") != "8000"
    for q in (0.1, 0.5, 0.9):
        mine = [r for r in dist if r.q == q]
        assert sum(r._c for r in mine) == 400 and sum(r.cell != 1 for r in mine) <= 2
