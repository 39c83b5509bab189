import pytest
from pyspark.sql import functions as F

from abtforge.functions.rowwise import row_max, row_sum
from abtforge.operators.wide import ALL, Compaction, build_compact, compact_columns, grouped_columns

CFG = Compaction(keys=("num_doc",), families={"digital": ["app_per", "svp"], "fisico": ["gr"],
                                                  "efectivo": ["cajero"], "tarjeta": ["pos"]})


def _wide(spark):
    cols = ["num_doc", "sum_trx_mnt_app_per_pag_ult6", "sum_trx_mnt_svp_ult6", "avg_trx_mnt_svp_ult6",
            "sum_trx_mnt_gr_ult6", "sum_trx_mnt_app_per_smmlv_ult6", "sum_trx_cnt_gr_ult6",
            "sum_trx_mnt_cajero_ult12", "sum_trx_mnt_gr_ult12"]
    rows = [(1, 10.0, 5.0, 1.0, 2.0, 999.0, 3.0, 7.0, 4.0),
            (2, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'bigint' if c == 'num_doc' else 'double'}" for c in cols))


def test_row_max_single_column_and_nulls(spark):
    df = spark.createDataFrame([(None, -3.0), (5.0, None)], "a double, b double")
    assert [r[0] for r in df.select(row_max(["a"])).collect()] == [0.0, 5.0]
    assert [r[0] for r in df.select(row_max(["a", "b"])).collect()] == [0.0, 5.0]
    assert [r[0] for r in df.select(row_sum(["a", "b"])).collect()] == [-3.0, 5.0]


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)"])
def test_row_sum_keeps_type_and_value_at_every_width(spark, kind):
    big = 9007199254740993 if kind == "bigint" else 3
    types = set()
    for n in (1, 2, 64, 65, 1000):
        df = spark.range(1).select(*[F.lit(big if i == 0 else 1).cast(kind).alias(f"c{i}") for i in range(n)])
        out = df.select(row_sum([f"c{i}" for i in range(n)]).alias("s"))
        assert out.first()[0] == big + n - 1
        types.add(out.dtypes[0][1].split("(")[0])
    assert types == {kind.split("(")[0]}


def test_family_membership(spark):
    fam = grouped_columns(_wide(spark).columns, CFG)
    assert fam[("digital", "ult6", "mnt")] == ["sum_trx_mnt_app_per_pag_ult6", "sum_trx_mnt_svp_ult6", "avg_trx_mnt_svp_ult6"]
    assert fam[("fisico", "ult6", "cnt")] == ["sum_trx_cnt_gr_ult6"]  # one column: max must still work
    assert ("tarjeta", "ult6", "mnt") not in fam  # no matching column -> no feature
    # no *_total_* column: the global total falls back to the sum of family totals
    assert (ALL, "ult6", "mnt") not in fam


def test_ready_total_prefers_the_first_statistic():
    names = ["avg_trx_mnt_total_ult6", "sum_trx_mnt_total_ult6", "avg_trx_cnt_total_ult6", "sum_trx_mnt_total_smmlv_ult6"]
    got = grouped_columns(names, CFG)
    assert got == {(ALL, "ult6", "mnt"): ["sum_trx_mnt_total_ult6"], (ALL, "ult6", "cnt"): ["avg_trx_cnt_total_ult6"]}


def test_real_codes_on_4000_columns_give_63_features(spark):
    from abtforge.operators.catalog import CHANNEL_CATALOG

    ops = ["", "_cmpr", "_rec", "_ret", "_trf", "_avn", "_cons"]
    cols = [f"{s}_trx_{m}_{c}{o}{u}_{w}" for s in ("sum", "avg", "max") for m in ("mnt", "cnt") for c, _ in CHANNEL_CATALOG for o in ops
            for u in ("", "_smmlv") for w in ("ult6", "ult12")] + ["sum_trx_mnt_total_ult6"]
    assert len(cols) > 4000
    spec = Compaction()
    names = [*spec.keys, *cols]
    assert len(compact_columns(names, spec)) == 63
    df = spark.range(2).select(*[F.lit("k").alias(k) for k in spec.keys], *[F.lit(1.0).alias(c) for c in cols])
    out = build_compact(df, spec)
    assert out.columns == [*spec.keys, *compact_columns(names, spec)] and len(out.columns) == 66
    row = out.first()
    # cajero: one code x 7 operations x 2 statistics
    assert row["total_mnt_efectivo_ult6"] == 14.0 and row["max_cnt_otros_ult12"] == 1.0


def test_compaction_values(spark):
    out = build_compact(_wide(spark), CFG)
    r = {row["num_doc"]: row for row in out.collect()}
    a = r["1"]
    assert a["total_mnt_digital_ult6"] == 16.0  # smmlv column excluded
    assert a["max_mnt_digital_ult6"] == 10.0
    assert a["max_cnt_fisico_ult6"] == 3.0
    assert a["total_mnt_all_ult6"] == 18.0
    assert a["share_mnt_digital_ult6"] == pytest.approx(16.0 / 19.0)
    assert a["index_digitalizacion_ult6"] == pytest.approx(16.0 / (16.0 + 2.0 + 1.0))
    assert a["trend_mnt_fisico_ult6_vs_ult12"] == pytest.approx(2.0 / 5.0)
    assert a["preferencia_efectivo_ult12"] == pytest.approx(7.0 / (11.0 + 1.0))
    # an all-NULL row gives zeros, not NULLs
    b = r["2"]
    assert all(b[c] == 0 for c in out.columns if c != "num_doc")
    assert dict(out.dtypes)["num_doc"] == "string"


def test_substring_mode_matches_inside_tokens(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "num_doc bigint, sum_trx_mnt_grx_ult6 double, sum_trx_mnt_gr_ult6 double")
    token = grouped_columns(df.columns, CFG)[("fisico", "ult6", "mnt")]
    sub = grouped_columns(df.columns, Compaction(keys=("num_doc",), families=CFG.families, anywhere=True))[("fisico", "ult6", "mnt")]
    assert token == ["sum_trx_mnt_gr_ult6"]
    assert sub == ["sum_trx_mnt_grx_ult6", "sum_trx_mnt_gr_ult6"]


def test_missing_key_raises(spark):
    with pytest.raises(ValueError):
        build_compact(spark.createDataFrame([(1.0,)], "sum_trx_mnt_gr_ult6 double"), CFG)


def test_share_can_exceed_one_by_definition(spark):
    # the global total uses the first stat prefix's *_total_* column only, family totals add
    # every prefix: with avg columns present a share above 1 is possible (documented)
    df = spark.createDataFrame([(1, 10.0, 50.0, 10.0)],
                               "num_doc bigint, sum_trx_mnt_gr_ult6 double, avg_trx_mnt_gr_ult6 double, sum_trx_mnt_total_ult6 double")
    row = build_compact(df, CFG).first()
    assert row["total_mnt_all_ult6"] == 10.0 and row["total_mnt_fisico_ult6"] == 60.0
    assert row["share_mnt_fisico_ult6"] > 1


def test_compaction_reads_only_needed_columns(spark):
    """On a Parquet table with many unrelated columns, the scan's ReadSchema holds only the
    key and the columns some family uses."""
    from abtforge.session import work_dir

    unused = [f"sum_trx_mnt_zz{i}_ult6" for i in range(150)] + [f"trx_cnt_can_x{i}" for i in range(50)]
    used = ["sum_trx_mnt_svp_ult6", "sum_trx_mnt_gr_ult12", "avg_trx_cnt_cajero_ult6"]
    cols = ["num_doc"] + used + unused
    df = spark.range(10).select(*[(F.col("id") * 1.0).alias(c) if c != "num_doc" else F.col("id").alias(c) for c in cols])
    path = work_dir(spark, "t_wide")
    df.write.parquet(path)
    out = build_compact(spark.read.parquet(path), CFG)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    schema = [l for l in plan.split("\n") if l.startswith("ReadSchema")][0]
    for c in used + ["num_doc"]:
        assert c in schema
    assert not any(c in schema for c in unused)
