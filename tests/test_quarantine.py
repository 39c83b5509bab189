import collections

from pyspark.sql import functions as F

from abtforge.operators import quarantine
from abtforge.session import work_dir

SCHEMA = "num_doc string, obl17 string, f_analisis string, x int, _corrupt_record string, _file string"


def rows():
    out = [(str(i), str(1000 + i), "2024-01-31", i, None, f"f{i % 3}") for i in range(200)]
    out += [("hot", "77", "2024-02-01", i, None, "f0") for i in range(150)]  # one grain on many rows
    out += [(None, "1", "2024-01-01", 1, None, "f1"), (" ", None, "", None, None, "f1"), ("a", "x", "31/31/2024", 1, None, "f2"),
            ("b", "2", "2024-01-01", None, "b,2,2024-01-01,zz", "f2"), ("c", "3.0", "2024-01-01", 1, None, "f2"), ("c", "3", "2024-01-01", 2, None, "f1"),
            ("c", "3", "2024-01-02", 2, None, "f1"), ("hot", "77", "2024-02-01", None, "bad", "f0")]
    return out


def test_every_row_is_good_or_set_aside_and_counted(spark, monkeypatch):
    for limit in (100_000, 0):
        monkeypatch.setattr(quarantine, "BROADCAST_GROUPS", limit)
        found = quarantine.split_rows(spark.createDataFrame(rows(), SCHEMA).repartition(5), work_dir(spark, "t_quarantine"))
        good, aside = found.good.collect(), found.set_aside.collect()
        assert found.good.columns == ["num_doc", "obl17", "f_analisis", "x", "_file"]
        reasons = collections.Counter(tuple(r.reasons) for r in aside)
        assert reasons == {("duplicate_grain",): 152, ("no_client",): 1, ("no_client", "no_obligation", "no_date"): 1, ("bad_date",): 1, ("malformed_row",): 2}
        assert len(good) + len(aside) == len(rows()) and {r.num_doc for r in good} == {str(i) for i in range(200)} | {"c"}
        ledger = {r.file: r for r in found.ledger.collect()}
        per_file = collections.Counter(r[-1] for r in rows())
        for f, r in ledger.items():
            assert r.n_rows == per_file[f] == r.n_good + r.n_set_aside
            assert r.n_set_aside == sum(x["_file"] == f for x in aside)
            for reason in quarantine.REASONS:
                assert r[reason] == sum(reason in x.reasons for x in aside if x["_file"] == f)


def test_number_keys_and_no_duplicate_check(spark):
    df = spark.createDataFrame([(1, 5.0, "2024-01-01", "f"), (2, float("nan"), "2024-01-01", "f"), (1, 5.0, "2024-01-01", "f")],
                               "num_doc long, obl17 double, f_analisis string, _file string")
    found = quarantine.split_rows(df, work_dir(spark, "t_quarantine_numbers"), unique=False)
    assert found.good.count() == 2 and [r.reasons for r in found.set_aside.collect()] == [["no_obligation"]]
    empty = quarantine.split_rows(df.where("num_doc = 9"), work_dir(spark, "t_quarantine_empty"))
    assert empty.ledger.collect() == [] and empty.good.collect() == [] and empty.set_aside.where(F.size("reasons") > 0).collect() == []
