import datetime as dt

import pytest
from pyspark.sql import functions as F

from abtforge.operators import catalog, decide, runs


def _scores(spark):
    rows = [("1", "10", dt.date(2024, 1, 1), "TRAIN", 1.0), ("1", "11", dt.date(2024, 1, 1), "OOT", 0.5),
            ("2", "20", dt.date(2024, 2, 1), "OOT", None), ("2", "20", dt.date(2024, 3, 1), "OOT", 1.0)]
    return spark.createDataFrame(rows, "num_doc_key string, obl17_key string, f_analisis date, split_group string, score double")


def test_decisions_eq_1_and_null(spark):
    d = {(r["obl17_key"], r["f_analisis"]): r for r in decide.decisions(_scores(spark)).collect()}
    assert d[("10", dt.date(2024, 1, 1))]["decision_label"] == "NO_ASIGNAR_GESTION"
    assert d[("20", dt.date(2024, 2, 1))]["gestion_cobro"] == 1  # NULL score -> collection
    assert "created_at" in decide.decisions(_scores(spark)).columns


def test_threshold_policy_with_arrears(spark):
    df = _scores(spark).withColumn("dias", F.lit(10))
    got = decide.decisions(df, policy="threshold", threshold=0.5, arrears_col="dias", with_timestamp=False)
    assert sorted(r["gestion_cobro"] for r in got.collect()) == [0, 0, 0, 1]


def test_lookups(spark):
    dec = decide.decisions(_scores(spark))
    detail = decide.lookup_detail(dec, "2", "20").collect()
    assert len(detail) == 1 and detail[0]["f_analisis"] == dt.date(2024, 3, 1)  # latest date
    assert [r["obl17_key"] for r in decide.lookup_by_client(dec, "1").collect()] == ["10", "11"]
    with pytest.raises(ValueError):
        decide.lookup_by_obligation(dec, "20", limit=0)
    with pytest.raises(ValueError):
        decide.lookup_by_client(dec, "1", limit=20001)


def test_best_run_rules(spark):
    recs = [
        runs.run_record(spark, "e", {}, {}, {"auc_oot": None}, [], run_id="null_auc"),
        runs.run_record(spark, "e", {}, dict(runs.REQUIRED_TAGS), {"auc_oot": 0.9995}, [], run_id="leaky"),
        runs.run_record(spark, "e", {}, {}, {"auc_oot": 0.91}, [], run_id="untagged"),
        runs.run_record(spark, "e", {}, dict(runs.REQUIRED_TAGS), {"auc_oot": 0.80}, ["a"], run_id="tagged"),
    ]
    df = recs[0]
    for r in recs[1:]:
        df = df.unionByName(r)
    assert runs.best_run(df).first()["run_id"] == "tagged"
    assert runs.best_run(df.filter("run_id != 'tagged'")).first()["run_id"] == "untagged"
    with pytest.raises(RuntimeError):
        runs.require_best(runs.best_run(df.filter("run_id in ('null_auc', 'leaky')")))


def test_longest_code_against_patterns(spark):
    """Random names and 400 codes, against one pattern per code."""
    import random
    import re

    rng = random.Random(4)
    parts = ["app", "per", "pag", "suc", "tel", "ut", "c", "x1", "sv", "pyme", ""]
    codes = list(dict.fromkeys("_".join(rng.choice(parts[:-1]) for _ in range(rng.randrange(1, 5))) for _ in range(400)))
    names = ["_".join([rng.choice(["trx", "sum_trx", "avg", "other", "max_trx"]), rng.choice(["mnt", "cnt"]), *(rng.choice(parts) for _ in range(rng.randrange(0, 7)))])
             + rng.choice(["", "_ult3", "_ult12", "_smmlv_ult6"]) for _ in range(500)] + ["", "_", "trx", "sum_trx", "trx_mnt", "ult3"]
    some = rng.sample(codes, 40)
    for chans in (codes, some, ["app"], []):
        got = catalog.parse_column_names(spark.createDataFrame([(n, i) for i, n in enumerate(names)], "col string, span int"), chans).collect()
        assert len(got) == len(names) and {r["col"]: r["span"] for r in got}
        for r in got:
            toks = [t for t in re.sub(r"(^|_)ult(3|6|9|12)$", "", r["col"]).split("_") if t != "smmlv"] if r["window"] != "none" else \
                [t for t in r["col"].split("_") if t != "smmlv"]
            if r["stat"] is None:
                assert r["canal"] is r["operacion"] is None
                continue
            at = 2 if r["stat"] == "trx" or toks[1:2] != ["trx"] else 3
            rest = "_".join(toks[at:])
            canal = next((c for c in sorted(chans, key=len, reverse=True) if re.search(rf"(^|_){c}(_|$)", rest)), None)
            left = re.sub(rf"(^|_){canal}(_|$)", "_", rest, count=1).strip("_") if canal else rest
            assert (r["canal"], r["operacion"]) == (canal, left or "none"), r


def test_parse_column_names(spark):
    names = spark.createDataFrame([(n,) for n in [
        "sum_trx_mnt_app_per_pag_pag_ult6", "trx_cnt_total", "avg_trx_cnt_suc_tel_ut_c_smmlv_ult12",
        "max_trx_mnt_pos_cmpr_ult3", "foo_bar", "sum_trx_mnt_total_ult6"]], "col string")
    chans = [c for c, _ in catalog.CHANNEL_CATALOG]
    got = {r["col"]: r for r in catalog.parse_column_names(names, chans).collect()}
    r = got["sum_trx_mnt_app_per_pag_pag_ult6"]
    assert (r["stat"], r["tipo"], r["canal"], r["operacion"], r["window"], r["is_smmlv"]) == ("sum", "mnt", "app_per_pag", "pag", "ult6", False)
    r = got["trx_cnt_total"]
    assert (r["stat"], r["tipo"], r["canal"], r["operacion"], r["window"]) == ("trx", "cnt", None, "total", "none")
    r = got["avg_trx_cnt_suc_tel_ut_c_smmlv_ult12"]
    assert (r["canal"], r["operacion"], r["is_smmlv"]) == ("suc_tel_ut_c", "none", True)
    assert got["max_trx_mnt_pos_cmpr_ult3"]["operacion"] == "cmpr"
    assert got["foo_bar"]["stat"] is None and got["foo_bar"]["canal"] is None
    cand = {r["col"]: r["c"] for r in names.select("col", catalog.is_candidate().alias("c")).collect()}
    assert cand["trx_cnt_total"] and cand["sum_trx_mnt_total_ult6"] and not cand["max_trx_mnt_pos_cmpr_ult3"]
    assert not cand["avg_trx_cnt_suc_tel_ut_c_smmlv_ult12"]


def test_smmlv_pairs(spark):
    names = spark.createDataFrame([("sum_trx_mnt_gr_ult6",), ("sum_trx_mnt_gr_smmlv_ult6",), ("sum_trx_mnt_pos_smmlv_ult6",)], "col string")
    assert [tuple(r) for r in catalog.smmlv_pairs(names).collect()] == [("sum_trx_mnt_gr_ult6", "sum_trx_mnt_gr_smmlv_ult6")]


def test_lookups_reject_a_missing_key(spark):
    import pytest

    dec = spark.createDataFrame([("1", "2", "2024-01-01", 0.5)], "num_doc_key string, obl17_key string, f_analisis string, score double")
    for call in (lambda: decide.lookup_detail(dec, None, "2"), lambda: decide.lookup_by_client(dec, None), lambda: decide.lookup_by_obligation(dec, None)):
        with pytest.raises(ValueError):
            call()


def test_trailing_stddev_of_a_small_spread_around_a_large_value(spark):
    from abtforge.operators import features

    rows = [(1, f"2024-01-0{1 + i // 2} 10:00:00", 1e9 + i, "view") for i in range(4)] + [(1, "2024-01-02 11:00:00", None, "view")]
    ev = spark.createDataFrame(rows, "user_id long, ts string, value double, event_type string")
    got = {str(r.day): r for r in features.trailing_features(ev, windows=(6,)).collect()}
    assert abs(got["2024-01-02"].std_value_6d - 1.2909944) < 1e-6 and got["2024-01-02"].avg_value_6d == 1e9 + 1.5


def test_latest_month_gives_bad_dates_no_split(spark):
    from abtforge.operators import split

    df = spark.createDataFrame([("2024-03-01", 1), ("2024-02-01", 0), ("2024-13-40", 0), (None, 1)], "f_analisis string, var_rta int")
    got = sorted((str(r.f_analisis), r.split_group) for r in split.with_latest_month_oot(df).collect())
    assert got == [("2024-02-01", "TRAIN"), ("2024-03-01", "OOT"), ("2024-13-40", None), ("None", None)]
