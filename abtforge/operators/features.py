"""Derived features (P21, P22) and the documented feature families.

Trailing-window features are computed per (key, day): events are first pre-aggregated to
one row per key and day (partial aggregation, so a key with a third of all events still
becomes at most one row per day), then range windows over the day number give the trailing
sums.  The days of a key are cut into blocks as long as the longest window; a block's task sees
its own days and those of the block before, so no task holds a key's whole history.  Month windows,
as-of values and arrears are in ``snapshots``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtforge.operators.snapshots import distinct_in_window


def create_features(df: DataFrame, amount: str | None = "monto_app", total: str | None = "monto_total",
                    arrears: str | None = "dias_mora", arrears_threshold: int = 30) -> DataFrame:
    """``ratio_digital`` = amount / total (NULL when total is 0 or a column is missing) and
    ``flag_mora_alta`` = arrears > threshold as INT; each only when its inputs exist."""
    cols = ["*"]
    if amount in df.columns and total in df.columns:
        cols.append(F.try_divide(F.col(amount).cast("double"), F.col(total).cast("double")).alias("ratio_digital"))
    if arrears in df.columns:
        cols.append((F.col(arrears) > F.lit(arrears_threshold)).cast("int").alias("flag_mora_alta"))
    return df.select(*cols)


def daily_activity(events: DataFrame, key: str, ts: str, value: str, digital: Column | None = None) -> DataFrame:
    """One row per (key, day): count, sum, mean and centred second moment, max and, with ``digital`` (a
    condition), the digital amount (all from one aggregate)."""
    v = F.col(value).cast("double")
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.count(v).alias("_n"), F.sum(v).alias("_sum"), F.avg(v).alias("_mean"),
            (F.var_pop(v) * F.count(v)).alias("_m2"), F.max(v).alias("_max")]
    if digital is not None:
        aggs.append(F.sum(F.when(digital, v)).alias("_dig"))
    return events.groupBy(F.col(key).alias(key), F.to_date(F.col(ts)).alias("day")).agg(*aggs)


def trailing_features(events: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "value",
                      kind: str = "event_type", windows: Sequence[int] = (6, 12),
                      digital_kinds: Sequence[str] = ()) -> DataFrame:
    """Per (key, day with activity): for each trailing window of ``d`` days ending that day,
    frequency (active days), event count, amount sum, mean, sample stddev, max, distinct
    kinds (diversity), trend (slope of the daily amount per day) and, when
    ``digital_kinds`` is given, the share of digital amount.

    The distinct kinds come from an interval sweep over sightings (``snapshots.distinct_in_window``), at
    any number of kinds.  Events without key or time take no part.
    """
    known = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    daily = daily_activity(known, key, ts, value, F.col(kind).isin(*digital_kinds) if digital_kinds else None).withColumn("_d", F.unix_date("day"))
    seen = known.select(key, F.to_date(F.col(ts)).alias("day"), F.col(kind).alias("_kind")).distinct()
    for d in windows:
        daily = distinct_in_window(seen, daily, key, "_kind", F.date_add("day", int(d))).withColumnRenamed("total", f"n_kinds_{d}d")
    length = max(windows)
    own = F.floor(F.col("_d") / length)
    daily = daily.withColumn("_own", own).withColumn("_block", F.explode(F.array(own, own + 1)))
    # squares are taken around the block's own mean: sums of raw squares lose all digits of a small
    # spread around a large value
    whole = Window.partitionBy(key, "_block")
    daily = daily.withColumn("_off", F.col("_mean") - F.try_divide(F.sum("_sum").over(whole), F.sum("_n").over(whole)))
    out = [F.col(key), F.col("day")]
    for d in windows:
        w = Window.partitionBy(key, "_block").orderBy("_d").rangeBetween(-(d - 1), 0)
        n = F.sum("_cnt").over(w)
        s = F.sum("_sum").over(w)
        nv = F.sum("_n").over(w)
        off = F.sum(F.col("_n") * F.col("_off")).over(w)
        squares = F.sum(F.col("_m2") + F.col("_n") * F.col("_off") * F.col("_off")).over(w)
        mean = F.try_divide(s, nv.cast("double"))
        var = F.try_divide(squares - F.try_divide(off * off, nv), F.when(nv > 1, nv - 1).cast("double"))
        out += [
            F.count(F.lit(1)).over(w).alias(f"active_days_{d}d"),
            n.alias(f"n_events_{d}d"),
            s.alias(f"sum_value_{d}d"),
            mean.alias(f"avg_value_{d}d"),
            F.sqrt(F.when(var < 0, F.lit(0.0)).otherwise(var)).alias(f"std_value_{d}d"),
            F.max("_max").over(w).alias(f"max_value_{d}d"),
            F.col(f"n_kinds_{d}d"),
            # trend: least-squares slope of the daily amount over the day number
            F.regr_slope("_sum", "_d").over(w).alias(f"trend_value_{d}d"),
        ]
        if digital_kinds:
            out.append(F.coalesce(F.try_divide(F.sum(F.coalesce("_dig", F.lit(0.0))).over(w), s), F.lit(0.0))
                       .alias(f"share_digital_{d}d"))
    placed = daily.select("_own", "_block", *out)
    return placed.where(F.col("_own") == F.col("_block")).drop("_own", "_block")


def payment_features(payments: DataFrame, key: Sequence[str], ts: str, paid: str, due: str,
                     months: int = 3, snapshot=None) -> DataFrame:
    """Payment behaviour over the ``months`` before the snapshot (X3): number of payments,
    full-payment ratio (paid >= due), mean and sample stddev of the paid amount, and the
    surplus share (amount paid above what was due, over all paid).

    ``snapshot`` defaults to the latest payment time of the table, a scalar subquery.
    """
    snap = snapshot if snapshot is not None else payments.select(F.max(ts)).scalar()
    p, d = F.col(paid).cast("double"), F.col(due).cast("double")
    recent = payments.filter((F.col(ts) > snap - F.expr(f"INTERVAL {int(months)} MONTHS")) & (F.col(ts) <= snap))
    return recent.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.avg((p >= d).cast("double")).alias("full_payment_ratio"),
        F.avg(p).alias("mean_paid"),
        F.stddev_samp(p).alias("std_paid"),
        F.try_divide(F.sum(F.greatest(p - d, F.lit(0.0))), F.sum(p)).alias("surplus_share"))


def contact_features(contacts: DataFrame, key: Sequence[str], outcome: str, agreed: Sequence[str],
                     refused: Sequence[str]) -> DataFrame:
    """Collection-contact features per key (X6): number of contacts, agreement rate and
    refusal rate (shares of contacts whose outcome is in ``agreed`` / ``refused``)."""
    n = F.count(F.lit(1))
    return contacts.groupBy(*key).agg(
        n.alias("n_contacts"),
        (F.count_if(F.col(outcome).isin(*agreed)) / n).alias("agreement_rate"),
        (F.count_if(F.col(outcome).isin(*refused)) / n).alias("refusal_rate"))


def payment_label(lines: DataFrame, key: Sequence[str], channel: str, debit_value: str, recurrent: str,
                  min_recurrence: float = 0.4) -> DataFrame:
    """Label rule (X2): 1 when every payment of the key went through the debit channel and
    the recurrent share is at least ``min_recurrence``; also returns both inputs."""
    agg = lines.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.count_if(F.col(channel) == F.lit(debit_value)).alias("n_debit"),
        F.avg(F.col(recurrent).cast("int").cast("double")).alias("recurrence"),
    )
    debit_only = F.col("n_debit") == F.col("n_payments")
    return agg.withColumn("var_rta", (debit_only & (F.col("recurrence") >= F.lit(min_recurrence))).cast("int"))


def feature_screen(df: DataFrame, cols: Sequence[str], min_nonzero_rate: float = 0.01,
                   min_variance: float = 0.0) -> DataFrame:
    """(column_name, nonzero_rate, variance, keep), from one scan."""
    from abtforge.operators.columnwise import column_stats

    out = column_stats(df, cols, {
        "nonzero_rate": lambda x: F.avg(F.when(x.isNotNull(), (x != 0).cast("double"))),
        "variance": F.var_samp,
    })
    keep = (F.coalesce(F.col("nonzero_rate"), F.lit(0.0)) >= min_nonzero_rate) & \
           (F.coalesce(F.col("variance"), F.lit(0.0)) > min_variance)
    return out.withColumn("keep", keep)


def absence_and_log(df: DataFrame, cols: Sequence[str], clip_at: float | None = None) -> DataFrame:
    """For each column: ``<c>_absent`` (value is 0 or NULL) and ``<c>_log1p`` of the value
    clipped at 0 from below (and at ``clip_at`` from above when given) (X11)."""
    out = ["*"]
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        out.append((F.coalesce(x, F.lit(0.0)) == 0).cast("int").alias(f"{c}_absent"))
        y = F.greatest(x, F.lit(0.0))
        if clip_at is not None:
            y = F.least(y, F.lit(float(clip_at)))
        out.append(F.when(x.isNotNull(), F.log1p(y)).alias(f"{c}_log1p"))
    return df.select(*out)


def threshold_grid(scored: DataFrame, thresholds: Sequence[float], score: str = "score", label: str | None = None,
                   arrears: str | None = None, arrears_range: tuple[int, int] = (1, 30)) -> DataFrame:
    """Share of rows spared from collection for each threshold (X1, X12), and, with a label,
    the share of spared rows that did *not* pay by themselves (the operational risk).

    One aggregate with one conditional count per threshold, then unpivoted.
    """
    eligible = F.lit(True)
    if arrears:
        eligible = F.col(arrears).between(*arrears_range)
    exprs = [F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        spare = eligible & (F.col(score) >= F.lit(float(t)))
        exprs.append(F.count_if(spare).alias(f"s{i}"))
        if label:
            exprs.append(F.count_if(spare & (F.col(label) == 0)).alias(f"r{i}"))
    wide = scored.agg(*exprs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"s{i}").alias("n_spared"),
                              (F.col(f"r{i}") if label else F.lit(None).cast("bigint")).alias("n_spared_unpaid"))
                     for i, t in enumerate(thresholds)])
    out = wide.select("_n", F.explode(rows).alias("r")).select(
        "r.threshold", "r.n_spared",
        F.coalesce(F.try_divide(F.col("r.n_spared").cast("double"), F.col("_n").cast("double")), F.lit(0.0)).alias("share_spared"),
        F.try_divide(F.col("r.n_spared_unpaid").cast("double"), F.col("r.n_spared").cast("double")).alias("risk"))
    return out


def stability(runs: DataFrame, test_metric: str = "auc_test", oot_metric: str = "auc_oot") -> DataFrame:
    """Per run: the gap between TEST and OOT metric."""
    return runs.select("run_id", F.col("metrics")[test_metric].alias(test_metric),
                       F.col("metrics")[oot_metric].alias(oot_metric),
                       (F.col("metrics")[test_metric] - F.col("metrics")[oot_metric]).alias("gap"))
