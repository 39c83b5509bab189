import datetime as dt
import types

import pytest
from pyspark.sql import functions as F

from abtforge import session
from abtforge.operators import profile
from abtforge.session import work_dir
from abtforge.sources import tables


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def _fake_spark(master, conf_values):
    ctx = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                                getConf=lambda: _Conf({}), setCheckpointDir=lambda d: None)
    return types.SimpleNamespace(sparkContext=ctx, conf=_Conf(conf_values))


def test_checkpoint_dir_required_on_clusters():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_fake_spark("yarn", {}))
    assert session.ensure_checkpoint_dir(_fake_spark("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"
    # local sessions: in the warehouse, never in a machine-wide temporary folder
    assert session.ensure_checkpoint_dir(_fake_spark("local[4]", {"spark.sql.warehouse.dir": "file:/w/"})) == "file:/w/_work"
    assert session.ensure_checkpoint_dir(_fake_spark("local[4]", {})) == "spark-warehouse/_work"


def test_export_csv_name_and_content(spark):
    folder = work_dir(spark, "t_export")
    path = tables.export_csv(spark.range(3).toDF("x"), folder, "scores", when=dt.datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("/scores_20240506_070809")
    back = spark.read.option("header", True).schema("x bigint").csv(path)
    assert sorted(r["x"] for r in back.collect()) == [0, 1, 2]


def test_list_tables_and_columns(spark):
    base = work_dir(spark, "t_list")
    tables.save_table(spark.range(2).select("id", F.lit("a").alias("s")), "tl", "t_listing", mode="overwrite", path=f"{base}/tl")
    names = [r["table_name"] for r in tables.list_tables(spark, "t_listing").collect()]
    assert "tl" in names
    cols = [(r["ordinal_position"], r["column_name"], r["data_type"]) for r in tables.list_columns(spark, "t_listing", "tl").collect()]
    assert cols == [(1, "id", "bigint"), (2, "s", "string")]


def test_profile_composition(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, None, "x"), (2, 3.0, "y")], "num_doc bigint, v double, t string")
    out = profile.profile_table(df, "t", sample_n=2)
    m = {(r["metric"], r["column_name"]): r["value"] for r in out["metrics"].collect()}
    assert m[("rows", None)] == 3 and m[("columns", None)] == 3
    assert m[("nulls", "v")] == 1 and m[("nulls", "t")] == 1
    assert m[("distinct_keys", "num_doc")] == 2 and m[("dup_rows", "num_doc")] == 1
    assert out["sample"].count() == 2
    assert {r["column_name"] for r in out["numeric"].collect()} == {"num_doc", "v"}


def test_listing_by_pattern_and_type(spark):
    base = work_dir(spark, "t_list2")
    for name in ("Alpha_one", "beta_two"):
        tables.save_table(spark.range(2).select("id", F.lit("a").alias("s"), F.lit("b").alias("r")), name, "t_listing2", mode="overwrite", path=f"{base}/{name}")
    assert [r[0] for r in tables.list_tables(spark, "t_listing2", "ALPHA%").collect()] == ["alpha_one"]
    assert "t_listing2" in [r[0] for r in tables.list_schemas(spark).collect()]
    assert [tuple(r) for r in tables.columns_by_type(spark, "t_listing2").where("table_name = 'beta_two'").collect()] == [
        ("beta_two", "bigint", 1), ("beta_two", "string", 2)]
