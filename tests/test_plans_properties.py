"""Plan shape at scale (broadcast off) and property tests."""

import contextlib
import re

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chained_left_joins_shuffle_driver_once(spark):
    from abtforge.operators import joins
    from abtforge.plans import q_core
    from abtforge.plans import standins as T

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        cl = q_core.keyed_clientes(spark, SF_SMALL)
        a = T.with_keys(T.order_lines(spark, SF_SMALL)).select("num_doc", "obl17", *q_core.KEYS3, *T.MORAS_COLS)
        b = T.with_keys(T.order_lines(spark, SF_SMALL)).select("num_doc", "obl17", *q_core.KEYS3, *T.TANQUE_COLS)
        plan = _plan(joins.build_base_table(cl, [a, b], keys=q_core.KEYS3))
    key_exchanges = [l for l in plan.split("\n") if "Exchange hashpartitioning(num_doc_key" in l]
    assert len([l for l in plan.split("\n") if "SortMergeJoin" in l and "LeftOuter" in l]) == 2
    assert len(key_exchanges) == 3  # driver once + one per side


def test_wide_compaction_is_one_codegen_stage_with_pruned_scan(spark):
    from abtforge.operators.wide import build_compact
    from abtforge.plans import standins as T

    df = build_compact(T.canales_wide(spark, SF_SMALL), T.WIDE_CONFIG)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan has the codegen stages
    df.collect()
    plan = _plan(df)
    assert "isFinalPlan=true" in plan
    # the row-wise projections and the pivot aggregate run inside generated code
    assert re.search(r"\*\(\d+\) (Project|HashAggregate)", plan)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_filters_reach_the_scan(spark):
    from abtforge.plans import standins as T

    df = T.table(spark, SF_SMALL, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_metric_running_sums_are_partitioned_by_slice(spark):
    from abtforge.operators.metrics import cumulative_counts
    from abtforge.plans import standins as T

    plan = _plan(cumulative_counts(T.scores(spark, SF_SMALL), "target_final", "score"))
    windows = [l for l in plan.split("\n") if "Window [" in l]
    assert windows
    # the row-level running sums are partitioned by the slice id; only the per-slice
    # offsets (slices rows) are computed without a data-sized partition
    assert any("_slice" in l and "_lcp" in l for l in windows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=60, unique=True),
       parts=st.integers(min_value=1, max_value=6))
def test_split_depends_on_id_only(spark, ids, parts):
    from abtforge.functions.split import hash_split

    df = spark.createDataFrame([(str(i),) for i in ids], "k string")
    a = {r["k"]: r["s"] for r in df.select("k", hash_split("k").alias("s")).collect()}
    b = {r["k"]: r["s"] for r in df.repartition(parts).orderBy(F.desc("k")).select("k", hash_split("k").alias("s")).collect()}
    assert a == b and set(a.values()) <= {"TRAIN", "TEST", "OOT"}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n_driver=st.integers(min_value=1, max_value=40), keep=st.floats(min_value=0.0, max_value=1.0))
def test_left_joins_preserve_driver_rows_with_unique_sides(spark, n_driver, keep):
    from abtforge.operators.joins import build_base_table

    K = ["num_doc_key", "obl17_key", "f_analisis"]
    drv = spark.createDataFrame([(str(i % 5), str(i), "2024-01-01") for i in range(n_driver)], ", ".join(f"{k} string" for k in K))
    side = drv.filter(F.rand(7) < keep).select(*K, F.lit(1.0).alias("x"))
    side2 = drv.select("num_doc_key").distinct().select("num_doc_key", F.lit(2.0).alias("y"))
    out = build_base_table(drv, [side, (side2, ["num_doc_key"])], keys=K)
    assert out.count() == n_driver


def test_hot_client_key_is_split_by_aqe(spark):
    """A client with a third of all rows: the left join on the client key is planned as a
    skew join (the hot partition is split, the matching side rows replicated)."""
    from abtforge.operators.joins import build_base_table

    K = ["num_doc_key", "obl17_key", "f_analisis"]
    n = 30000
    drv = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("num_doc_key"),
        F.col("id").cast("string").alias("obl17_key"), F.lit("2024-01-01").alias("f_analisis"),
        F.rand(1).alias("x"))
    # one row per client, read like a table (no aggregate feeding the join)
    side = spark.range(n).select(
        F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("num_doc_key"),
        F.lit(1.0).alias("client_feature"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "true",
                        "spark.sql.adaptive.skewJoin.enabled": "true",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.shuffle.partitions": "8"}):
        out = build_base_table(drv, [(side, ["num_doc_key"])], keys=K, hot_share=None)
        assert len(out.collect()) == n  # runs this DataFrame's own adaptive plan
        plan = _plan(out)
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan


@pytest.mark.parametrize("grouped", [False, True])
def test_hot_client_key_is_joined_in_pieces(spark, grouped):
    """Without AQE and broadcasts, a side aggregated on the join key, a grouping after the join: no task
    holds more than a few hundredths of the rows, and the result is that of the plain join."""
    from abtforge.operators.joins import build_base_table, heavy_keys

    K = ["num_doc_key", "obl17_key", "f_analisis"]
    n = 30000
    drv = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 9000).cast("string")).alias("num_doc_key"),
        F.col("id").cast("string").alias("obl17_key"), F.lit("2024-01-01").alias("f_analisis"), (F.col("id") % 13).alias("x"))
    side = drv.groupBy("num_doc_key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("x").alias("top"))
    other = drv.where("x < 5").groupBy("num_doc_key").agg(F.min("obl17_key").alias("first"))
    assert len(heavy_keys(drv, ["num_doc_key"])) == 2  # the hot client and the missing one
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}):
        sides = [(side, ["num_doc_key"]), (other, ["num_doc_key"])]
        out, plain = (build_base_table(drv, sides, keys=K, hot_share=h) for h in (0.02, None))
        assert out.columns == plain.columns
        sizes = lambda df: [r["n"] for r in df.select("n_rows", "first", F.spark_partition_id().alias("p")).groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.max("n_rows"), F.max("first")).collect()]
        assert max(sizes(out)) < 0.1 * n < 0.3 * n < max(sizes(plain))
        if grouped:
            out, plain = (d.groupBy("num_doc_key").agg(F.sum("n_rows").alias("s"), F.count("first").alias("c")) for d in (out, plain))
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_column_checks_scan_once_at_any_width(spark):
    """Checks of 4,000 columns: one scan in the executed plan, and no interpreted aggregate."""
    from abtforge.operators import leakage
    from abtforge.session import work_dir

    path = work_dir(spark, "t_columns")
    spark.range(40).select((F.col("id") % 2).alias("y"), *[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(4000)]).write.parquet(path)
    rep = leakage.leakage_report(spark.read.parquet(path), [f"c{i}" for i in range(4000)], "y")
    got = rep.collect()
    plan = _plan(rep).split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    aggs = [x for x in plan.split("\n") if "HashAggregate(keys=[_position" in x]
    assert aggs and all(re.search(r"\*\(\d+\) HashAggregate", x) for x in aggs)
    assert isinstance(got, list)


def test_column_stats_of_an_empty_table(spark):
    from abtforge.operators import profile

    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [("a", 0, 0.0), ("b", 0, 0.0)]
