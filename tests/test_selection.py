import collections

import numpy as np
import pytest

from abtforge.operators import selection


def brute_pairs(values):
    out = {}
    for i in range(values.shape[1]):
        for j in range(i + 1, values.shape[1]):
            both = np.isfinite(values[:, i]) & np.isfinite(values[:, j])
            x, y = values[both, i], values[both, j]
            flat = len(x) < 2 or np.ptp(x) == 0 or np.ptp(y) == 0
            out[i, j] = (int(both.sum()), None if flat else float(np.corrcoef(x, y)[0, 1]))
    return out


def brute_choice(values, names, alike, least, most, target=None):
    order = []
    last = len(names)
    pairs = brute_pairs(values)
    for k in range(last):
        known = values[np.isfinite(values[:, k]), k]
        rate = float((known != 0).mean()) if len(known) else 0.0
        if rate >= 0.01 and len(known) > 1 and np.ptp(known) > 0:
            order.append((-round(abs(pairs[k, last][1] or 0.0) if target else rate, 9), names[k], k))
    order = [k for *_, k in sorted(order)]
    near = lambda a, b: (lambda p: p[0] >= 30 and p[1] is not None and abs(p[1]) >= alike)(pairs[min(a, b), max(a, b)])
    chosen, seen = [], []
    for k in order:
        if len(chosen) == most:
            break
        seen.append(k)
        if not any(near(k, c) for c in chosen):
            chosen.append(k)
    for k in seen:
        if len(chosen) < min(least, most) and k not in chosen:
            chosen.append(k)
    return [names[k] for k in order if k in chosen]


@pytest.fixture(scope="module")
def table(spark):
    """(names, values, frame): 90 columns, 700 rows; groups of near copies, NULLs, constants, large offsets."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(700, 18))
    values = np.concatenate([base + rng.normal(size=(700, 18)) * s for s in (0, 0.05, 0.2, 0.6)], axis=1)
    values = np.concatenate([values, np.full((700, 2), 3.7), np.zeros((700, 2)), 1e8 + base[:, :8], (rng.random((700, 6)) < 0.005).astype(float)], axis=1)
    values[rng.random(values.shape) < 0.15] = np.nan
    values[:, 5] = np.nan
    values[:, 7][31:] = np.nan
    values[40:, 72][values[40:, 72] != 3.7] = 3.7
    names = [f"c{i:03d}" for i in rng.permutation(values.shape[1])]
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in values]
    return names, values, spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(6)


@pytest.mark.parametrize("block", [7, 64, 200])
def test_pairs_match_numpy(table, block):
    names, values, frame = table
    got = {(r.column_a, r.column_b): r for r in selection.correlation_pairs(frame, names, block).collect()}
    want = brute_pairs(values)
    assert len(got) == len(want)
    for (i, j), (n, corr) in want.items():
        r = got[names[i], names[j]]
        assert r.n == n and (r.corr is None) == (corr is None), (i, j, r, corr)
        assert corr is None or abs(r.corr - corr) < 1e-6


@pytest.mark.parametrize("least,most,target", [(0, 150, None), (0, 10, None), (40, 60, None), (20, 150, "c_target"), (300, 300, None)])
def test_choice_matches_brute_force(spark, table, least, most, target):
    names, values, frame = table
    if target:
        y = np.nan_to_num(values[:, :4]).sum(axis=1) + np.random.default_rng(9).normal(size=len(values))
        wide = np.concatenate([values, y[:, None]], axis=1)
        rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in wide]
        frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, target]))
        want = brute_choice(wide, names, 0.9, least, most, target)
    else:
        want = brute_choice(values, names, 0.9, least, most)
    got = selection.choose_columns(frame, names, target, 0.9, least, most, block=32).collect()
    assert [r.column_name for r in sorted((r for r in got if r.verdict == "chosen"), key=lambda r: r.place)] == want
    kinds = collections.Counter(r.verdict for r in got)
    assert sum(kinds.values()) == len(names) and kinds["screened"] >= 4
    chosen = set(want)
    assert all(r.like in chosen for r in got if r.verdict == "redundant")


def test_four_thousand_columns_take_one_scan(spark):
    width = 4000
    rows = spark.range(40).selectExpr("id", f"transform(sequence(0, {width - 1}), k -> cast(pmod(xxhash64(id, k % 1300), 1000) AS double)) AS v")
    frame = rows.coalesce(1).select(*[rows["v"][k].alias(f"c{k:04d}") for k in range(width)])
    names = frame.columns
    plan = selection.pair_statistics(frame, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    got = selection.choose_columns(frame, names, alike=0.999, least=120, most=150, block=500).collect()
    verdicts = collections.Counter(r.verdict for r in got)
    assert verdicts["chosen"] == 150 and [r.place for r in got if r.place] and len(got) == width
    assert len({int(r.column_name[1:]) % 1300 for r in got if r.verdict == "chosen"}) == 150  # columns 1,300 apart are equal


def test_choice_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert selection.choose_columns(empty, ["a", "b"]).collect() == []
    assert selection.choose_columns(empty, []).collect() == []
    one = spark.createDataFrame([(1.0, "x")], "a double, b string")
    assert {r.verdict for r in selection.choose_columns(one, ["a", "b"]).collect()} == {"screened"}
