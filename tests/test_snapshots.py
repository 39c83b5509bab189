import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from abtforge.operators import features, snapshots

DAY = dt.date(2021, 1, 1)


def make_events(seed, n=400, keys=6, kinds=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(keys)  # one key holds most events
        at = dt.datetime(2021, 1, 1) + dt.timedelta(days=rng.randrange(420), seconds=rng.randrange(86400))
        rows.append((key, at, None if rng.random() < 0.05 else 1e6 + rng.randrange(-50, 300) / 7, None if rng.random() < 0.05 else f"k{rng.randrange(kinds)}"))
    return rows + [(None, dt.datetime(2021, 3, 1), 1.0, "k"), (1, None, 1.0, "k")]


def back(day, months):
    """``months`` before a day, clamped to the month's end."""
    y, m = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = (dt.date(y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m + 1, min(day.day, last))


def plain_window(events, key, day, months):
    rows = [e for e in events if e[0] == key and key is not None and e[1] is not None and back(day, months) < e[1].date() <= day]
    values = [e[2] for e in rows if e[2] is not None]
    points = [((e[1].date() - day).days, e[2]) for e in rows if e[2] is not None]
    slope = None
    if len({x for x, _ in points}) > 1:
        mx, my = statistics.fmean(x for x, _ in points), statistics.fmean(y for _, y in points)
        slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    return {"n_events": len(rows), "active_days": len({e[1].date() for e in rows}), "sum_value": sum(values) if values else None,
            "avg_value": statistics.fmean(values) if values else None, "std_value": statistics.stdev(values) if len(values) > 1 else None,
            "max_value": max(values, default=None), "n_above": sum(v > 1e6 for v in values), "trend": slope,
            "n_kinds": len({e[3] for e in rows if e[3] is not None}), "sum_half": sum(v / 2 for v in values) if values else None}


def close(a, b, scale=1e-9):
    return a is None and b is None or a is not None and b is not None and abs(a - b) <= scale * max(1, abs(a), abs(b))


def test_panel_matches_plain_python(spark):
    events = make_events(3)
    days = [DAY + dt.timedelta(days=d) for d in (0, 57, 58, 88, 89, 150, 180, 240, 241, 363, 424, 600)]  # month ends among them
    asked = [(k, day) for k in range(7) for day in days] + [(0, days[3]), (None, days[0]), (2, None)]
    frame = spark.createDataFrame(events, "k long, at timestamp_ntz, v double, kind string").repartition(7)
    snaps = spark.createDataFrame(asked, "k long, f_analisis date")
    got = snapshots.snapshot_panel(frame, snaps, "k", "at", "v", months=(1, 3, 6), kind="kind", amounts={"half": F.col("v") / 2}, above=1e6).collect()
    assert sorted(((r.k, r.f_analisis) for r in got), key=str) == sorted(set(asked), key=str)
    for r in got:
        if r.k is None or r.f_analisis is None:
            assert r.n_events_3m == r.n_kinds_6m == 0 and r.last_value is None
            continue
        for m in (1, 3, 6):
            for name, want in plain_window(events, r.k, r.f_analisis, m).items():
                assert close(r[f"{name}_{m}m"], want, 1e-6 if name in ("std_value", "trend") else 1e-9), (r.k, r.f_analisis, m, name)
        before = sorted((e[1], e[2] is not None, e[2]) for e in events if e[0] == r.k and e[1] is not None and e[1].date() <= r.f_analisis)
        assert (r.last_value, r.days_since) == ((before[-1][2], (r.f_analisis - before[-1][0].date()).days) if before else (None, None))


def test_a_window_ends_at_month_ends(spark):
    """Every day of two years as event and as snapshot: the sweep and the month cut agree with the dates."""
    days = [dt.date(2019, 12, 1) + dt.timedelta(days=i) for i in range(500)]
    frame = spark.createDataFrame([(1, dt.datetime(d.year, d.month, d.day), 1.0, f"kind{i}") for i, d in enumerate(days)], "k long, at timestamp_ntz, v double, kind string")
    got = snapshots.snapshot_panel(frame, spark.createDataFrame([(1, d) for d in days], "k long, f_analisis date"), "k", "at", "v", months=(1, 6), kind="kind").collect()
    for r in got:
        for m in (1, 6):
            want = sum(back(r.f_analisis, m) < d <= r.f_analisis for d in days)
            assert r[f"n_events_{m}m"] == r[f"active_days_{m}m"] == r[f"n_kinds_{m}m"] == want


def test_arrears(spark):
    rows = [(1, dt.datetime(2021, 1, d), float(x), "a") for d, x in ((5, 0), (10, 4), (20, 10), (25, 0))]
    frame = spark.createDataFrame(rows, "k long, at timestamp_ntz, late double, kind string")
    snaps = spark.createDataFrame([(1, dt.date(2021, 1, 22)), (1, dt.date(2021, 6, 1)), (1, dt.date(2021, 8, 1)), (9, dt.date(2021, 1, 22))], "k long, f_analisis date")
    got = {(r.k, str(r.f_analisis)): r for r in snapshots.arrears_features(frame, snaps, "k", "at", "late").collect()}
    r = got[1, "2021-01-22"]
    assert (r.dias_mora_actual, r.max_dias_mora_3m, r.numero_eventos_mora_6m) == (10.0, 10.0, 2) and close(r.dias_mora_promedio_3m, 14 / 3) and r.tendencia_mora_3m > 0
    r = got[1, "2021-06-01"]
    assert (r.dias_mora_actual, r.dias_mora_promedio_3m, r.numero_eventos_mora_3m, r.numero_eventos_mora_6m) == (0.0, None, 0, 2)
    assert got[9, "2021-01-22"].dias_mora_actual is None and got[1, "2021-08-01"].numero_eventos_mora_6m == 0


def test_panel_of_nothing(spark):
    frame = spark.createDataFrame([], "k long, at timestamp_ntz, v double, kind string")
    snaps = spark.createDataFrame([(1, DAY)], "k long, f_analisis date")
    rows = snapshots.snapshot_panel(frame, snaps, "k", "at", "v", kind="kind").collect()
    assert [(r.n_events_3m, r.n_kinds_6m, r.last_value) for r in rows] == [(0, 0, None)]
    assert snapshots.snapshot_panel(frame, snaps.where("k = 2"), "k", "at", "v").collect() == []


def test_trailing_diversity_with_many_kinds(spark):
    events = [e for e in make_events(8, n=600, kinds=500) if e[0] is not None and e[1] is not None]
    frame = spark.createDataFrame(events, "user_id long, ts timestamp_ntz, value double, event_type string")
    out = features.trailing_features(frame, windows=(7, 30))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    for r in out.collect():
        for d in (7, 30):
            rows = [e for e in events if e[0] == r.user_id and 0 <= (r.day - e[1].date()).days < d]
            values = [e[2] for e in rows if e[2] is not None]
            assert r[f"n_kinds_{d}d"] == len({e[3] for e in rows if e[3] is not None})
            assert r[f"n_events_{d}d"] == len(rows) and r[f"active_days_{d}d"] == len({e[1].date() for e in rows})
            assert close(r[f"sum_value_{d}d"], sum(values) if values else None)
            assert close(r[f"std_value_{d}d"], statistics.stdev(values) if len(values) > 1 else None, 1e-6)


def test_a_hot_key_is_spread_over_its_months(spark):
    """No task of the windows reads more than a month of the hot key's days."""
    days = spark.range(4000).selectExpr("0 AS k", "date_add(DATE'2010-01-01', cast(id AS int)) AS day", "1L AS delta")
    marks = days.select("k", "day")
    got = snapshots.running_totals(days, marks, "k").orderBy("day").collect()
    assert [r.total for r in got] == list(range(1, 4001))
    plan = snapshots.running_totals(days, marks, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "_month" in plan and plan.count("Window") == 2


def test_panel_sends_states_and_snapshots_once(spark):
    """One exchange each for day states, snapshots, sightings (by day, by kind), changes and the two windows; no join of windows with days."""
    day = dt.date(2024, 1, 31)
    frame = spark.createDataFrame([(1, dt.datetime(2023, 10, 31, 5), 2.0, "a"), (1, dt.datetime(2023, 11, 1, 5), 3.0, "a"), (1, dt.datetime(2024, 1, 31, 5), 7.0, "b")], "k long, at timestamp, v double, kind string")
    snaps = spark.createDataFrame([(1, day), (1, day), (2, day)], "k long, f_analisis date")
    panel = snapshots.snapshot_panel(frame, snaps, "k", "at", "v", kind="kind")
    plan = panel._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    assert panel._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 8
    got = {r.k: r for r in panel.collect()}
    assert (got[1].n_events_3m, got[1].n_kinds_3m, got[1].sum_value_3m, got[1].n_events_6m, got[1].n_kinds_6m) == (2, 2, 10.0, 3, 2)
    assert (got[2].n_events_3m, got[2].n_kinds_6m, got[2].avg_value_6m, got[2].last_value) == (0, 0, None, None)


def test_equal_values_in_a_window_have_slope_zero(spark):
    rows = [(1, dt.datetime(1992, 3, 4), 439.0), (1, dt.datetime(1994, 7, 9), 100.0), (1, dt.datetime(1999, 1, 17), 0.0), (1, dt.datetime(1999, 1, 18), 0.0), (1, dt.datetime(1999, 2, 17), 0.0)]
    frame = spark.createDataFrame(rows, "k long, at timestamp, late double")
    snaps = spark.createDataFrame([(1, dt.date(1999, 2, 18)), (1, dt.date(1999, 1, 18))], "k long, f_analisis date")
    got = snapshots.arrears_features(frame, snaps, "k", "at", "late").collect()
    assert [(r.tendencia_mora_3m, r.tendencia_mora_6m, r.dias_mora_promedio_3m) for r in got] == [(0.0, 0.0, 0.0)] * 2
