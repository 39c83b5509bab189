import pytest
from pyspark.sql import functions as F

from abtforge.operators.joins import assert_unique, build_base_table, match_rate, orphan_count

K = ["num_doc_key", "obl17_key", "f_analisis"]


def _driver(spark):
    return spark.createDataFrame([("1", "10", "2024-01-01", 1), ("2", "20", "2024-01-01", 0), ("3", None, "2024-01-01", 1)],
                                 "num_doc_key string, obl17_key string, f_analisis string, var_rta int")


def test_left_join_keeps_driver_rows_and_fills(spark):
    right = spark.createDataFrame([("1", "10", "2024-01-01", 5.0, 7)], "num_doc_key string, obl17_key string, f_analisis string, x double, n int")
    out = build_base_table(_driver(spark), [right], keys=K, presence_flags=True)
    rows = {r["num_doc_key"]: r for r in out.collect()}
    assert set(rows) == {"1", "2"}  # NULL obligation key dropped from the driver
    assert rows["2"]["x"] == 0.0 and rows["2"]["n"] == 0 and rows["2"]["has_side0"] == 0
    assert rows["1"]["has_side0"] == 1


def test_shared_non_key_column_raises(spark):
    right = spark.createDataFrame([("1", "10", "2024-01-01", 1)], "num_doc_key string, obl17_key string, f_analisis string, var_rta int")
    with pytest.raises(ValueError):
        build_base_table(_driver(spark), [right], keys=K)


def test_duplicate_right_side_detected(spark):
    right = spark.createDataFrame([("1", "10", "2024-01-01", 1.0), ("1", "10", "2024-01-01", 2.0)],
                                  "num_doc_key string, obl17_key string, f_analisis string, x double")
    with pytest.raises(ValueError):
        assert_unique(right, K)
    with pytest.raises(ValueError):
        build_base_table(_driver(spark), [right], keys=K, require_unique=True)
    # without the check the fan-out is visible as an extra row
    assert build_base_table(_driver(spark), [right], keys=K).count() == 3


def test_coarser_side(spark):
    right = spark.createDataFrame([("1", 3.0)], "num_doc_key string, y double")
    out = build_base_table(_driver(spark), [(right, ["num_doc_key"])], keys=K)
    assert sorted(r["y"] for r in out.collect()) == [0.0, 3.0]


def test_decimal_and_smallint_not_filled(spark):
    right = spark.createDataFrame([("9", "90", "2024-01-01", None, None)],
                                  "num_doc_key string, obl17_key string, f_analisis string, m decimal(10,2), s smallint")
    out = build_base_table(_driver(spark), [right], keys=K)
    assert all(r["m"] is None and r["s"] is None for r in out.collect())


def test_match_rate_and_orphans(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",)], "k string")
    r = match_rate(left, right, ["k"], "t").first()
    assert (r["left_keys"], r["matched_keys"]) == (3, 1)
    assert r["match_rate"] == pytest.approx(1 / 3)
    empty = match_rate(left.filter(F.lit(False)), right, ["k"], "t").first()
    assert empty["match_rate"] == 0.0
    # NULL keys count as orphans
    assert orphan_count(left, right, ["k"]).first()["n_orphans"] == 2
