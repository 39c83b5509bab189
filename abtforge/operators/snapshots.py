"""Features as of snapshot dates: month windows, the current value and the diversity of kinds.

Every (key, snapshot date) row asks about the events of its key in the windows (S - m months, S].
There is no range join:

* events become one state per (key, day).  A state holds counts and sums that can be added: values are taken
  around the key's own mean, so that small spreads around large values keep their digits, and days from the
  key's first;
* the snapshots join these states as further rows, and one window by key, ordered by day, answers everything:
  a range frame per number of months and an open one for the latest value.  States and snapshots cross
  the network once each;
* the number of distinct kinds comes from an interval sweep: a sighting of a kind counts from its
  day until its next sighting or until it leaves the window, +1 at the start and -1 at the end, and the
  running total at a snapshot is the number of kinds in its window.  All windows share one sweep; no sets
  are kept.

So a key with a third of all events is partially aggregated before every shuffle, and no task holds more
of it than the days of its history.

Defined results: events without key or time take no part; a snapshot without events has counts 0 and
NULL values; a snapshot row without key or date is kept like that too; repeated snapshot rows give one row.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def leaves_window(day: Column, months: int) -> Column:
    """The first snapshot date whose window of ``months`` months no longer holds ``day``.

    Month arithmetic clamps to the month's end, so ``add_months`` can fall one day short.
    """
    end = F.add_months(day, months)
    return F.when(F.add_months(end, -months) >= day, end).otherwise(F.date_add(end, 1))


def running_totals(changes: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """``marks`` (key, day, ...) with ``total``: the sum of all ``changes`` (key, day, delta) up to that day.

    Two levels: inside a (key, month) over its days, and over the months of a key.
    """
    rest = [c for c in marks.columns if c not in (key, "day")]
    daily = changes.groupBy(key, "day").agg(F.sum("delta").alias("_delta"))
    both = daily.select(key, "day", "_delta", F.lit(False).alias("_mark"), *[F.lit(None).cast(marks.schema[c].dataType).alias(c) for c in rest]).unionByName(
        marks.select(key, "day", F.lit(0).cast("long").alias("_delta"), F.lit(True).alias("_mark"), *rest)).withColumn("_month", month_of(F.col("day")))
    inside = Window.partitionBy(key, "_month").orderBy("day", "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    sums = both.groupBy(key, "_month").agg(F.sum("_delta").alias("_sum"))
    carried = sums.select(key, "_month", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))
    placed = both.withColumn("_inside", F.sum("_delta").over(inside)).where("_mark")
    return placed.join(carried, [key, "_month"]).select(*marks.columns, (F.col("_inside") + F.col("_carry")).alias("total"))


def distinct_in_window(sightings: DataFrame, marks: DataFrame, key: str, kind: str, leaves: Column) -> DataFrame:
    """``marks`` (key, day, ...) with ``total``: distinct ``kind`` values seen in the window that ends on the day.

    ``sightings`` has (key, day, kind), one row each; ``leaves`` is the first day whose window no
    longer holds a sighting's ``day``.
    """
    following = F.lead("day").over(Window.partitionBy(key, kind).orderBy("day"))
    spans = sightings.where(F.col(kind).isNotNull()).withColumn("_next", following).select(key, "day", F.least("_next", leaves).alias("_end"))
    change = F.explode(F.array(F.struct(F.col("day"), F.lit(1).cast("long").alias("delta")), F.struct(F.col("_end").alias("day"), F.lit(-1).cast("long").alias("delta"))))
    return running_totals(spans.select(key, change.alias("_c")).select(key, "_c.day", "_c.delta"), marks, key)


def distinct_in_windows(sightings: DataFrame, marks: DataFrame, key: str, kind: str, leaves: Mapping[str, Column]) -> DataFrame:
    """``marks`` (key, day) with one column per window: distinct ``kind`` values seen in the window that ends on the day.

    As ``distinct_in_window``, for several windows in one sweep: ``leaves`` maps an output name to the first day
    whose window no longer holds a sighting's ``day``.  Changes are added up per day before the running totals.
    """
    names = list(leaves)
    following = F.lead("day").over(Window.partitionBy(key, kind).orderBy("day"))
    spans = sightings.where(F.col(kind).isNotNull()).withColumn("_next", following).select(
        key, "day", *[F.least("_next", end).alias(f"_end_{n}") for n, end in leaves.items()])
    change = lambda day, deltas: F.struct(day.alias("day"), *[F.lit(deltas.get(n, 0)).cast("long").alias(n) for n in names])
    changes = F.explode(F.array(change(F.col("day"), dict.fromkeys(names, 1)), *[change(F.col(f"_end_{n}"), {n: -1}) for n in names]))
    daily = spans.select(key, changes.alias("_c")).groupBy(key, "_c.day").agg(*[F.sum(f"_c.{n}").alias(n) for n in names])
    both = daily.withColumn("_mark", F.lit(False)).unionByName(marks.select(key, "day", F.lit(True).alias("_mark")), allowMissingColumns=True)
    until = Window.partitionBy(key).orderBy("day", "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.select(key, "day", "_mark", *[F.coalesce(F.sum(n).over(until), F.lit(0)).alias(n) for n in names])
    return placed.where("_mark").drop("_mark")


def day_states(events: DataFrame, key: str, ts: str, value: str, amounts: Mapping[str, Column], above: float) -> DataFrame:
    """What can be added of the events, per (key, day)."""
    v = F.col(value).cast("double")
    known = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return known.groupBy(F.col(key).alias(key), F.to_date(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("nv"), F.sum(v).alias("_sum"), (F.var_pop(v) * F.count(v)).alias("_m2"),
        F.max(v).alias("mx"), F.count_if(v > above).alias("above"), F.max(F.struct(F.col(ts).alias("at"), v.alias("value"))).alias("last"),
        *[F.sum(c.cast("double")).alias(f"amount_{name}") for name, c in amounts.items()])

def centred(states: DataFrame, key: str) -> DataFrame:
    """States with ``centre`` (near the key's mean) and ``origin`` (its first day), and the sums around them."""
    whole = Window.partitionBy(key)
    mean = F.try_divide(F.sum("_sum").over(whole), F.sum("nv").over(whole))
    # few binary digits: differences and products of whole numbers stay exact, so that equal values have slope 0
    near = F.when(F.abs(mean) < 1e38, mean.cast("float").cast("double")).otherwise(mean)
    out = states.withColumn("centre", near).withColumn("origin", F.min(F.when(F.col("n") > 0, F.col("day"))).over(whole))
    x, nv, seen = F.datediff("day", "origin"), F.col("nv"), F.col("n") > 0
    out = out.withColumn("sy", F.col("_sum") - nv * F.col("centre"))
    return out.withColumns({"days": F.when(seen, 1).cast("long"), "syy": F.col("_m2") + F.try_divide(F.col("sy") * F.col("sy"), nv),
                            "sx": (nv * x).cast("double"), "sxx": (nv * x * x).cast("double"), "sxy": F.col("sy") * x}).drop("_sum", "_m2")


def snapshot_panel(events: DataFrame, snapshots: DataFrame, key: str, ts: str, value: str, snapshot: str = "f_analisis",
                   months: Sequence[int] = (3, 6), kind: str | None = None, amounts: Mapping[str, Column] | None = None, above: float = 0.0) -> DataFrame:
    """(key, snapshot, features): one row per distinct row of ``snapshots`` (key, snapshot date).

    Per window of ``m`` months up to and including the snapshot date: ``n_events_<m>m``,
    ``active_days_<m>m``, ``sum_``, ``avg_``, ``std_``, ``max_value_<m>m``, ``n_above_<m>m`` (values over
    ``above``), ``trend_<m>m`` (least-squares slope of the value per day), ``sum_<name>_<m>m`` of each
    column in ``amounts`` and, with ``kind``, ``n_kinds_<m>m``.  As of the snapshot: ``last_value`` of the latest
    event (the largest, if several share its time) and ``days_since``.
    """
    amounts = dict(amounts or {})
    sums = ["n", "nv", "days", "above", "sy", "syy", "sx", "sxx", "sxy", *[f"amount_{a}" for a in amounts]]
    asked = snapshots.select(F.col(key).alias(key), F.to_date(F.col(snapshot)).alias("day")).distinct()
    marks = asked.where(F.col(key).isNotNull() & F.col("day").isNotNull())
    kinds = [f"n_kinds_{m}m" for m in months] if kind else []
    if kind:
        seen = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, F.to_date(F.col(ts)).alias("day"), F.col(kind).alias("_kind")).distinct()
        marks = distinct_in_windows(seen, marks, key, "_kind", {n: leaves_window(F.col("day"), m) for n, m in zip(kinds, months)})

    days = day_states(events, key, ts, value, amounts, above)
    both = centred(days.withColumn("_mark", F.lit(False)).unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True), key)
    # a month interval can only be taken from a time; the window of m months begins on the day after the m-th month back
    both = both.withColumn("_at", F.col("day").cast("timestamp_ntz"))
    frame = f"OVER (PARTITION BY `{key}` ORDER BY _at RANGE BETWEEN {{}} PRECEDING AND CURRENT ROW)"
    found = [F.expr(f"last(last, true) {frame.format('UNBOUNDED')}").alias("last")]
    for m in months:
        window = frame.format(f"CAST('{int(m)} months -1 days' AS INTERVAL)")
        found += [F.expr(f"sum(`{c}`) {window}").alias(f"{c}_{m}") for c in sums] + [F.expr(f"max(mx) {window}").alias(f"mx_{m}")]
    found = both.select(key, F.col("day").alias("_snapshot"), "_mark", "centre", "origin", *kinds, *found).where("_mark")
    # days are counted from the snapshot: shift the sums from the key's first day
    shift = F.datediff("origin", "_snapshot").cast("double")
    for m in months:
        nv, sx, sy = (F.col(f"{c}_{m}") for c in ("nv", "sx", "sy"))
        found = found.withColumns({f"sx_{m}": sx + nv * shift, f"sxx_{m}": F.col(f"sxx_{m}") + 2 * shift * sx + nv * shift * shift, f"sxy_{m}": F.col(f"sxy_{m}") + shift * sy})

    out = [F.col(key), F.col("_snapshot").alias(snapshot), F.col("last.value").alias("last_value"), F.datediff("_snapshot", F.to_date("last.at")).alias("days_since")]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    for m in months:
        c = {name: F.col(f"{name}_{m}") for name in sums}
        n, spread = c["nv"], c["syy"] - F.try_divide(c["sy"] * c["sy"], c["nv"])
        variance = F.try_divide(F.greatest(spread, F.lit(0.0)), F.when(n > 1, n - 1).cast("double"))
        slope = F.try_divide(n * c["sxy"] - c["sx"] * c["sy"], F.nullif(n * c["sxx"] - c["sx"] * c["sx"], F.lit(0.0)))
        has = F.when(n > 0, 1)
        out += [zero(f"n_{m}").alias(f"n_events_{m}m"), zero(f"days_{m}").alias(f"active_days_{m}m"), (has * (c["sy"] + n * F.col("centre"))).alias(f"sum_value_{m}m"),
                (has * (F.col("centre") + F.try_divide(c["sy"], n))).alias(f"avg_value_{m}m"), F.sqrt(variance).alias(f"std_value_{m}m"), F.col(f"mx_{m}").alias(f"max_value_{m}m"),
                zero(f"above_{m}").alias(f"n_above_{m}m"), slope.alias(f"trend_{m}m"), *[F.col(f"amount_{a}_{m}").alias(f"sum_{a}_{m}m") for a in amounts],
                *([F.col(f"n_kinds_{m}m")] if kind else [])]
    panel = found.select(*out)
    lost = asked.where(F.col(key).isNull() | F.col("day").isNull()).withColumnRenamed("day", snapshot)
    counts = [f"{c}_{m}m" for m in months for c in ("n_events", "active_days", "n_above")] + kinds
    return panel.unionByName(lost, allowMissingColumns=True).fillna(0, counts)


def arrears_features(arrears: DataFrame, snapshots: DataFrame, key: str, ts: str, days_late: str, snapshot: str = "f_analisis",
                     months: Sequence[int] = (3, 6)) -> DataFrame:
    """Arrears as of every snapshot: ``dias_mora_actual`` and, per window, mean, maximum, number of events in
    arrears and trend (``dias_mora_promedio_<m>m``, ``max_dias_mora_<m>m``, ``numero_eventos_mora_<m>m``, ``tendencia_mora_<m>m``)."""
    panel = snapshot_panel(arrears, snapshots, key, ts, days_late, snapshot, months)
    names = {"avg_value": "dias_mora_promedio", "max_value": "max_dias_mora", "n_above": "numero_eventos_mora", "trend": "tendencia_mora"}
    return panel.select(key, snapshot, F.col("last_value").alias("dias_mora_actual"),
                        *[F.col(f"{old}_{m}m").alias(f"{new}_{m}m") for m in months for old, new in names.items()])
