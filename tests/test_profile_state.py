import math
import statistics

import pytest
from pyspark.sql import functions as F

from abtforge.operators import profile_state as P
from abtforge.session import work_dir

COLS = ["a", "b", "t"]


def month(spark, m, n=400):
    base = spark.range(n).select(F.lit(f"2024-{m:02d}").alias("month"), F.col("id"))
    x = (F.xxhash64("id", F.lit(m)) % 1000) / F.lit(7.0)
    return base.select("month", F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, F.lit(0.0)).otherwise(x).alias("a"),
                       F.when(F.col("id") % 17 == 0, F.lit(float("nan"))).when(F.col("id") % 19 == 0, F.lit(float("-inf"))).otherwise(F.lit(1e9) + x).alias("b"),
                       F.when(F.col("id") % 5 == 0, "no number").otherwise((F.col("id") - 200).cast("string")).alias("t"))


def values(df, c):
    out = [r[c] for r in df.select(c).collect()]
    number = lambda v: None if v is None or v == "no number" else float(v)
    return [v if v is not None and math.isfinite(v) else None for v in map(number, out)]


def test_a_new_month_is_profiled_without_the_old_ones(spark):
    """State by state, with the old months' data gone, equals one run over everything."""
    path, seen = work_dir(spark, "t_states"), None
    for m in (1, 2, 3):
        data = work_dir(spark, f"t_month{m}")
        month(spark, m).write.parquet(data)
        frame = spark.read.parquet(data)
        before = spark.read.parquet(path).select(F.input_file_name()).distinct().collect() if m > 1 else []
        P.append_parts(frame, COLS, "month", path)
        assert all(f in spark.read.parquet(path).select(F.input_file_name()).distinct().collect() for f in before)  # old parts untouched
        frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(data)  # the month's rows are gone
        seen = month(spark, m) if seen is None else seen.unionByName(month(spark, m))
    P.append_parts(month(spark, 3), COLS, "month", path)  # profiled again: replaced
    step, whole = ({r.column_name: r for r in P.summary(s).collect()} for s in (P.stored_state(spark, path), P.profile_state(seen, COLS, "month")))
    assert set(step) == set(COLS)
    for c in COLS:
        v = [x for x in values(seen, c) if x is not None]
        r = step[c]
        for name, value in whole[c].asDict().items():  # sums in another order: the last digits of avg and std may differ
            assert r[name] == (pytest.approx(value, rel=1e-8) if name in ("avg", "std") else value)
        assert (r.n_rows, r.n_unknown, r.n_zero, r.min, r.max) == (1200, 1200 - len(v), v.count(0.0), min(v), max(v))
        assert r.avg == pytest.approx(statistics.fmean(v), rel=1e-12) and r.std == pytest.approx(statistics.stdev(v), rel=1e-9)
        v.sort()
        for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            exact = v[math.floor(q * (len(v) - 1))]
            assert abs(r[name] - exact) <= P.ACCURACY * abs(exact) + 1e-9
    one = {r.column_name: r for r in P.summary(P.profile_state(seen.withColumn("all", F.lit("x")), COLS, "all")).collect()}
    for c in COLS:  # one part or three: the same profile up to rounding
        for name in one[c].asDict():
            assert one[c][name] == step[c][name] or one[c][name] == pytest.approx(step[c][name], rel=1e-9)


def test_buckets_hold_their_values_in_order(spark):
    v = [0.0, -0.0, 1.0, -1.0, 1e-300, 5e-324, -1e308, 1.7e308, 3.3, 3.4, -3.3, 1e15, 0.99]
    rows = spark.createDataFrame([(x,) for x in v], "x double").select("x", P.bucket_of(F.col("x")).alias("b")).withColumn("y", P.bucket_value(F.col("b"))).collect()
    assert [r.x for r in sorted(rows, key=lambda r: (r.b, r.x))] == sorted(v)
    assert all(abs(r.y - r.x) <= P.ACCURACY * abs(r.x) * 1.0001 for r in rows if abs(r.x) > 1e-307)


def test_state_of_nothing(spark):
    empty = month(spark, 1).where("month = 'x'")
    assert P.summary(P.profile_state(empty, COLS, "month")).collect() == []
    unknown = P.summary(P.profile_state(spark.createDataFrame([("p", None)], "p string, x double"), ["x"], "p")).first()
    assert (unknown.n_rows, unknown.n_unknown, unknown.min, unknown.avg, unknown.std, unknown.p50) == (1, 1, None, None, None, None)
