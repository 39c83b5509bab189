import pytest
from pyspark.sql import functions as F

from abtforge.session import work_dir
from abtforge.sources import tables
from abtforge.streaming import ingest_new_files


def test_stream_ingest_exactly_once(spark):
    land, sink, cp = work_dir(spark, "t_land"), work_dir(spark, "t_sink"), work_dir(spark, "t_cp")
    schema = "id bigint, v double"
    spark.range(100).select("id", (F.col("id") * 0.5).alias("v")).write.option("header", True).csv(land)
    ingest_new_files(spark, land, schema, sink, cp)
    ingest_new_files(spark, land, schema, sink, cp)  # nothing new: nothing added
    assert spark.read.parquet(sink).count() == 100
    spark.range(100, 130).select("id", (F.col("id") * 0.5).alias("v")).write.mode("append").option("header", True).csv(land)
    ingest_new_files(spark, land, schema, sink, cp)
    out = spark.read.parquet(sink)
    assert out.count() == 130 and out.select("id").distinct().count() == 130


def test_ingest_csv_missing_folder_and_file(spark):
    with pytest.raises(FileNotFoundError):
        tables.ingest_csv_files(spark, work_dir(spark, "nope"))
    land = work_dir(spark, "t_csv")
    spark.range(5).select(F.col("id").alias("num_doc")).write.option("header", True).csv(f"{land}/clientes.csv")
    counts = tables.ingest_csv_files(spark, land, database="t_raw", schemas={"clientes": "num_doc bigint"},
                                     location=work_dir(spark, "t_raw"))
    assert counts == {"clientes": 5}


def test_save_modes_and_read_or_build(spark):
    base = work_dir(spark, "t_tables")
    a = spark.range(3).toDF("x")
    assert tables.save_table(a, "t1", "t_silver", mode="overwrite", path=f"{base}/t1")
    assert not tables.save_table(spark.range(10).toDF("x"), "t1", "t_silver", mode="skip", path=f"{base}/t1")
    assert tables.read_table(spark, "t1", "t_silver").count() == 3
    assert tables.read_table(spark, "t1", "t_silver", limit=2, refresh=True).count() == 2
    with pytest.raises(ValueError):
        tables.save_table(None, "t2", "t_silver")
    with pytest.raises(LookupError):
        tables.read_table(spark, "absent", "t_silver")
    built = tables.ensure_table(spark, "t1", lambda df: df.withColumn("y", F.lit(1)), source_database="t_silver",
                                target_database="t_gold", path=f"{base}/t1_gold")
    assert built.columns == ["x", "y"] and built.count() == 3


def test_parquet_folder_glob(spark):
    folder = work_dir(spark, "t_parquet")
    spark.range(7).write.parquet(folder)
    assert tables.read_parquet_folder(spark, folder).count() == 7
    with pytest.raises(FileNotFoundError):
        tables.read_parquet_folder(spark, folder, pattern="nothing-*.parquet")


def test_parameterised_query(spark):
    tables.create_view(spark.range(10).toDF("x"), "t_view")
    assert tables.query(spark, "SELECT count(*) AS n FROM t_view WHERE x >= :lo", {"lo": 7}).first()["n"] == 3
    assert tables.query_one(spark, "SELECT x FROM t_view WHERE x = :v", {"v": 4}) == {"x": 4}
    assert tables.query_one(spark, "SELECT x FROM t_view WHERE x = :v", {"v": 40}) is None


def test_bucketed_decisions_prune_lookups(spark):
    import datetime as dt

    from abtforge.operators import decide, scoring

    rows = [(str(i % 50), str(i), dt.date(2024, 1, 1), "OOT", (i % 10) / 10.0) for i in range(500)]
    scores = spark.createDataFrame(rows, "num_doc_key string, obl17_key string, f_analisis date, split_group string, score double")
    out = scoring.refresh(spark, scores, decisions_table="t_dec", database="t_results",
                          table_path=work_dir(spark, "t_dec"), buckets=8)
    look = decide.lookup_by_client(out["decisions"], "7")
    assert [r["num_doc_key"] for r in look.collect()] == ["7"] * 10
    # the equality filter on the bucket column reads only that bucket's files
    node = look._jdf.queryExecution().executedPlan()
    while node.children().size() > 0:
        node = node.children().apply(0)
    rows_read = node.metrics().apply("numOutputRows").value()
    assert 10 <= rows_read < 500 / 2  # about one bucket of the 500 rows, not the table


def test_exec_sql_statements(spark):
    tables.exec_sql(spark, "CREATE DATABASE IF NOT EXISTS t_exec; CREATE OR REPLACE TEMP VIEW t_exec_v AS SELECT 1 AS x")
    assert spark.table("t_exec_v").first()["x"] == 1


def test_gold_partitioned_by_month_prunes(spark):
    import datetime as dt

    from abtforge.operators import scoring

    rows = [(str(i), dt.date(2024, 1 + i % 3, 1 + i % 27), float(i)) for i in range(300)]
    gold = spark.createDataFrame(rows, "num_doc_key string, f_analisis date, x double")
    back = scoring.materialize_gold(gold, "t_gold", "t_gold_db", path=work_dir(spark, "t_gold"))
    q = back.filter(F.col("f_analisis_month") == F.lit(dt.date(2024, 2, 1)))
    plan = spark._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(f_analisis_month" in plan
    assert q.count() == 100


def test_csv_bad_rows_are_reported_and_types_inferred(spark):
    import pytest

    from abtforge.session import work_dir
    from abtforge.sources import tables

    land = work_dir(spark, "t_bad_csv")
    spark.createDataFrame([("num_doc,obl17,x,y",), ("007,12345678901234567,1,a",), ("8,2,zz,b",)], "value string").coalesce(1).write.text(f"{land}/bad.csv")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed|FAILED_READ_FILE|FAILFAST|WRITE"):
        tables.ingest_csv_files(spark, land, {"bad.csv": "t_bad"}, database="t_bad_db", location=land, schemas={"t_bad": "num_doc string, obl17 string, x int, y string"})
    got = tables.ingest_csv_files(spark, land, {"bad.csv": "t_bad"}, database="t_bad_db", location=land, allow_bad_rows=True,
                                  schemas={"t_bad": "num_doc string, obl17 string, x int, y string"})
    back = spark.table("t_bad_db.t_bad")
    assert got == {"t_bad": 2} and back.columns == ["num_doc", "obl17", "x", "y", tables.CORRUPT]
    assert [(r.num_doc, r.x) for r in back.where(f"{tables.CORRUPT} IS NOT NULL").collect()] == [("8", None)]
    assert tables.ingest_csv_files(spark, land, {"bad.csv": "t_inferred"}, database="t_bad_db", location=land) == {"t_inferred": 2}
    assert dict(spark.table("t_bad_db.t_inferred").dtypes) == {"num_doc": "string", "obl17": "string", "x": "string", "y": "string"}


def test_bucketed_write_has_one_file_per_bucket(spark):
    import os

    from abtforge.session import work_dir
    from abtforge.sources import tables

    path = work_dir(spark, "t_files")
    df = spark.range(0, 4000, 1, 16).selectExpr("cast(id % 97 as string) as k", "id")
    tables.save_table(df, "t_files", "t_results", mode="overwrite", path=path, bucket_by=["k"], buckets=4, sort_by=["k"])
    folder = tables.table_versions(spark, path)[-1]
    files = [f for f in os.listdir(folder.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 4


def _scanned(df):
    """Rows that the scan of a frame reads."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size() > 0:
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def _file_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.input_file_name()).count().collect())


def test_lookup_by_obligation_reads_one_bucket_of_each_table(spark):
    import datetime as dt

    from abtforge.operators import decide, scoring

    rows = [(str(i % 400), str(i), dt.date(2024, 1, 1), "OOT", (i % 10) / 10.0) for i in range(4000)]
    rows += [("shared1", "both", dt.date(2024, 1, 1), "OOT", 0.5), ("shared2", "both", dt.date(2024, 2, 1), "OOT", 0.6), (None, "both", dt.date(2024, 3, 1), "OOT", 0.7),
             ("c", None, dt.date(2024, 3, 1), "OOT", 0.7)]
    scores = spark.createDataFrame(rows, "num_doc_key string, obl17_key string, f_analisis date, split_group string, score double")
    out = scoring.refresh(spark, scores, decisions_table="t_idx", database="t_results", table_path=work_dir(spark, "t_idx"), buckets=16)
    plain = decide.lookup_by_obligation(out["decisions"], "77")
    found = decide.lookup_by_obligation(out["decisions"], "77", index=out["index"])
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in plain.collect()] and found.count() == 1
    one_bucket = (decide.lookup_by_obligation(out["decisions"], "77", index=out["index"]), out["index"].where("obl17_key = '77'"))
    for frame, stored in zip(one_bucket, (out["decisions"], out["index"])):
        sizes = _file_sizes(stored)
        assert len(sizes) == 16 and _scanned(frame) in sizes  # the rows of one file of sixteen
    assert _scanned(decide.lookup_by_obligation(out["decisions"], "77")) == 4004
    assert decide.clients_of(out["index"], "both") == ["shared1", "shared2", None]
    assert [r["num_doc_key"] for r in decide.lookup_by_obligation(out["decisions"], "both", index=out["index"]).collect()] == [None, "shared2", "shared1"]
    assert decide.lookup_by_obligation(out["decisions"], "absent", index=out["index"]).collect() == []
    with pytest.raises(ValueError, match="more than 2 clients"):
        decide.clients_of(out["index"], "both", limit=2)


def test_a_failing_replacement_leaves_the_old_table(spark):
    base = work_dir(spark, "t_crash")
    save = lambda df: tables.save_table(df, "t_crash", "t_results", mode="overwrite", path=base)
    save(spark.range(10).toDF("x"))
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("dies midway"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="dies midway"):
        save(bad)
    assert spark.table("t_results.t_crash").count() == 10 and len(tables.table_versions(spark, base)) == 1
    assert [t.name for t in spark.catalog.listTables("t_results") if t.name.startswith("t_crash")] == ["t_crash"]


def test_replacement_that_dies_between_its_steps_is_finished(spark, monkeypatch):
    base = work_dir(spark, "t_steps")
    save = lambda df: tables.save_table(df, "t_steps", "t_results", mode="overwrite", path=base)
    save(spark.range(3).toDF("x"))
    monkeypatch.setattr(tables, "recover_table", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        save(spark.range(7).toDF("x"))
    monkeypatch.undo()
    assert not spark.catalog.tableExists("t_results.t_steps")  # the name is free, the new version is complete
    assert tables.read_table(spark, "t_steps", "t_results").count() == 7
    save(spark.range(8).toDF("x"))
    assert tables.read_table(spark, "t_steps", "t_results").count() == 8 and len(tables.table_versions(spark, base)) == 2


def test_replacement_is_counted_and_may_read_itself(spark, monkeypatch):
    base = work_dir(spark, "t_self")
    save = lambda df, **more: tables.save_table(df, "t_self", "t_results", mode="overwrite", path=base, **more)
    save(spark.range(5).toDF("x"))
    reader = spark.table("t_results.t_self")
    for n in range(4):
        save(tables.read_table(spark, "t_self", "t_results").selectExpr("x + 1 AS x"))
    assert sorted(r.x for r in tables.read_table(spark, "t_self", "t_results").collect()) == [4, 5, 6, 7, 8]
    assert len(tables.table_versions(spark, base)) == 2
    save(spark.range(9).selectExpr("id AS y", "id % 2 AS p"), partition_by=["p"], keep_versions=0)  # other columns, partitioned
    assert tables.read_table(spark, "t_self", "t_results").columns == ["y", "p"] and len(tables.table_versions(spark, base)) == 1
    assert reader is not None
    with pytest.raises(RuntimeError, match="10 rows expected, 9 rows stored"):
        save(spark.range(9).toDF("x"), expected_rows=10)
    monkeypatch.setattr(tables, "path_exists", lambda *a: False)
    with pytest.raises(RuntimeError, match="not committed"):
        save(spark.range(9).toDF("x"))
    monkeypatch.undo()
    assert len(tables.table_versions(spark, base)) == 1
    assert tables.read_table(spark, "t_self", "t_results").count() == 9
