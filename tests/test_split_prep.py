import datetime as dt

import pytest
from pyspark.sql import functions as F

from abtforge.functions.split import hash_bucket, temporal_split
from abtforge.operators import prep, split


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = {r["k"]: r["b"] for r in df.select("k", hash_bucket("k").alias("b")).collect()}
    b = {r["k"]: r["b"] for r in df.repartition(7).orderBy(F.rand(3)).select("k", hash_bucket("k").alias("b")).collect()}
    assert a == b
    counts = {}
    for v in a.values():
        counts[v] = counts.get(v, 0) + 1
    assert set(counts) == set(range(10))


def test_hash_split_null_id_hashes_as_na(spark):
    df = spark.createDataFrame([(None,), ("NA",)], "k string")
    got = [r[0] for r in df.select(hash_bucket("k")).collect()]
    assert got[0] == got[1]


def test_temporal_split_edges(spark):
    rows = [(dt.date(2023, 12, 31),), (dt.date(2024, 1, 15),), (dt.date(2024, 2, 10),), (dt.date(2024, 3, 5),), (None,)]
    df = spark.createDataFrame(rows, "f date")
    got = [r[0] for r in df.select(temporal_split("f", "2024-01-01", "2024-02-01", "2024-03-01")).collect()]
    # the gap between train_before and test_start falls to OOT; a NULL date has no split
    assert got == ["TRAIN", "OOT", "TEST", "OOT", None]
    with pytest.raises(ValueError):
        temporal_split("f", "2024-01-01", None, "2024-03-01")


def test_label_and_require_splits(spark):
    df = spark.createDataFrame([("1", "1"), ("2", "0")], "num_doc_key string, var_rta string")
    out = split.with_hash_split(df, "num_doc_key")
    assert out.columns[:2] == ["target_final", "split_group"] and "var_rta" not in out.columns
    with pytest.raises(ValueError):
        split.require_splits(out)


def test_coerce_inf_nan_text(spark):
    df = spark.createDataFrame([("1.5", float("inf"), "x"), ("abc", float("-inf"), "2"), (None, float("nan"), " 3 ")],
                               "a string, b double, c string")
    out = prep.coerce_numeric(df, ["a", "b", "c"]).collect()
    assert [tuple(r) for r in out] == [(1.5, None, None), (None, None, 2.0), (None, None, 3.0)]
    inf = {r["column_name"]: r["n_inf"] for r in prep.infinite_counts(df, ["a", "b"]).collect()}
    assert inf == {"a": 0, "b": 2}


def test_quantile_bounds_and_clip(spark):
    vals = [(float(i),) for i in range(1001)] + [(None,)]
    df = spark.createDataFrame(vals, "x double").withColumn("const", F.lit(1.0)).withColumn("empty", F.lit(None).cast("double"))
    b = prep.bounds_dict(prep.quantile_bounds(df, ["x", "const", "empty"]))
    assert set(b) == {"x"}  # constant (hi == lo) and empty columns get no bounds
    assert b["x"] == pytest.approx((1.0, 999.0))
    clipped = prep.apply_clip(df.select("x"), b).collect()
    xs = [r[0] for r in clipped]
    assert min(x for x in xs if x is not None) == 1.0 and max(x for x in xs if x is not None) == 999.0
    assert xs.count(None) == 1  # NULL stays NULL


def test_sanitize_fit_apply(spark):
    train = spark.createDataFrame([(float(i), None, str(i)) for i in range(100)], "a double, e double, t string")
    clean, kept, bounds = prep.sanitize_fit(train, ["a", "e", "t"])
    assert kept == ["a", "t"] and set(bounds) == {"a", "t"}
    test = spark.createDataFrame([(1000.0, "zz")], "a double, other string")
    row = prep.sanitize_apply(test, kept, bounds).first()
    assert row["a"] == pytest.approx(bounds["a"][1]) and row["t"] is None
    assert prep.sanitize_apply(test, kept, bounds).columns == ["a", "t"]


def test_label_not_duplicated(spark):
    df = spark.createDataFrame([("1", 1, 0)], "num_doc_key string, var_rta int, target_final int")
    out = split.add_label(df)
    assert out.columns == ["target_final", "num_doc_key"]
    assert out.first()["target_final"] == 1
