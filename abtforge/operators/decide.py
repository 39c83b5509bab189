"""Scores to decisions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Decision labels and the source's default policy.
LABEL_SKIP = "NO_ASIGNAR_GESTION"
LABEL_ASSIGN = "ASIGNAR_GESTION"
DEFAULT_POLICY = "v1_score_eq_1"


def decisions(scores: DataFrame, policy: str = "eq_1", threshold: float = 1.0,
              policy_version: str = DEFAULT_POLICY, arrears_col: str | None = None,
              arrears_range: tuple[int, int] = (1, 30), with_timestamp: bool = True) -> DataFrame:
    """Decision per scored row.

    ``eq_1``: no collection effort (0, NO_ASIGNAR_GESTION) only when score = 1.0 exactly;
    ``threshold``: when score >= threshold, and, if ``arrears_col`` is given, arrears within
    ``arrears_range`` (the documented operational rule).  Anything else, NULL scores
    included, gets 1 / ASIGNAR_GESTION.
    """
    s = F.col("score")
    if policy == "eq_1":
        spare = s == F.lit(1.0)
    elif policy == "threshold":
        spare = s >= F.lit(float(threshold))
        if arrears_col:
            lo, hi = arrears_range
            spare = spare & F.col(arrears_col).between(lo, hi)
    else:
        raise ValueError(f"unknown policy {policy!r}")
    spare = F.coalesce(spare, F.lit(False))
    cols = [
        "*",
        F.when(spare, 0).otherwise(1).alias("gestion_cobro"),
        F.when(spare, LABEL_SKIP).otherwise(LABEL_ASSIGN).alias("decision_label"),
        F.lit(policy_version).alias("policy_version"),
        F.lit(float(threshold)).alias("threshold_used"),
    ]
    if with_timestamp:
        cols.append(F.current_timestamp().alias("created_at"))
    return scores.select(*cols)


def decision_counts(dec: DataFrame) -> DataFrame:
    """Rows per decision label, biggest first (A3)."""
    return dec.groupBy("decision_label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "decision_label")


def score_summary(scores: DataFrame) -> DataFrame:
    """n, min, max, avg and counts of score = 1.0 and score = 0.0 (A4, A5)."""
    s = F.col("score")
    return scores.agg(F.count(F.lit(1)).alias("n"), F.min(s).alias("min_score"), F.max(s).alias("max_score"),
                      F.avg(s).alias("avg_score"), F.count_if(s == 1.0).alias("n_score_1"),
                      F.count_if(s == 0.0).alias("n_score_0"))


def score_quantiles(scores: DataFrame, qs: Sequence[float] = (0.5, 0.9, 0.95, 0.99), exact: bool = True,
                    by: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles of the score (A6): exact by distributed rank search, or
    ``percentile_approx`` with ``exact=False``."""
    from abtforge.operators import quantiles as Q

    names = [f"p{int(round(q * 100))}" for q in qs]
    if exact:
        qdf = Q.exact_quantiles(scores, ["score"], qs, by=by)
        return Q.pivot_quantiles(qdf, list(by), qs, names)
    arr = F.array(*[F.lit(q) for q in qs])
    return scores.groupBy(*by).agg(F.percentile_approx("score", arr, 100000).alias("_q")).select(
        *by, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])


def top_scores(scores: DataFrame, n: int = 200, split: str | None = None,
               tie_keys: Sequence[str] = ("num_doc", "obl17_key")) -> DataFrame:
    """Highest scores first, keys as tie-breakers (K1-K3): a TakeOrderedAndProject, each task
    keeps only its own top ``n``."""
    df = scores if split is None else scores.filter(F.col("split_group") == split)
    return df.orderBy(F.desc("score"), *[F.asc(k) for k in tie_keys]).limit(n)


def _check_limit(limit: int, hi: int) -> None:
    if limit < 1 or limit > hi:
        raise ValueError(f"limit must be between 1 and {hi}")


def _wanted(key: str, name: str):
    """The key to look up; None would silently search for the text 'None'."""
    if key is None:
        raise ValueError(f"lookup needs {name}")
    return F.lit(str(key))


def lookup_detail(dec: DataFrame, num_doc: str, obl17_key: str, date_col: str = "f_analisis") -> DataFrame:
    """At most one decision for (client, obligation); the latest analysis date wins."""
    return (dec.filter((F.col("num_doc_key") == _wanted(num_doc, "num_doc")) & (F.col("obl17_key") == _wanted(obl17_key, "obl17_key")))
            .orderBy(F.desc_nulls_last(date_col)).limit(1))


def obligation_index(dec: DataFrame) -> DataFrame:
    """The second access path to decisions that are bucketed by client: the clients of every obligation.

    Two narrow columns, one row per (obligation, client); stored bucketed and sorted by obligation.
    """
    return dec.where("obl17_key IS NOT NULL").select("obl17_key", "num_doc_key").distinct()


def clients_of(index: DataFrame, obl17_key: str, limit: int = 5000) -> list[str | None]:
    """The clients of one obligation in order, from one bucket of the index; more than ``limit`` is an error."""
    found = index.filter(F.col("obl17_key") == _wanted(obl17_key, "obl17_key")).select("num_doc_key").distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"obligation {obl17_key!r} belongs to more than {limit} clients")
    return sorted((r["num_doc_key"] for r in found), key=lambda c: (c is None, c))


def lookup_by_obligation(dec: DataFrame, obl17_key: str, limit: int = 200, index: DataFrame | None = None) -> DataFrame:
    """Decisions of one obligation, at most ``limit`` (1..5000).

    With ``index`` (``obligation_index``, stored) the obligation's clients are looked up first, and of a
    table bucketed by client only their buckets are read; without it the whole table is scanned.
    """
    _check_limit(limit, 5000)
    if index is not None:
        clients = clients_of(index, obl17_key)
        known = [c for c in clients if c is not None]
        hit = F.col("num_doc_key").isin(known) if known else F.lit(False)
        dec = dec.filter(hit | F.col("num_doc_key").isNull() if None in clients else hit)
    return (dec.filter(F.col("obl17_key") == _wanted(obl17_key, "obl17_key"))
            .orderBy(F.desc_nulls_last("f_analisis"), "num_doc_key").limit(limit))


def lookup_by_client(dec: DataFrame, num_doc: str, limit: int = 2000) -> DataFrame:
    """Decisions of one client, highest score first, at most ``limit`` (1..20000)."""
    _check_limit(limit, 20000)
    return (dec.filter(F.col("num_doc_key") == _wanted(num_doc, "num_doc"))
            .orderBy(F.desc("score"), "obl17_key", F.desc_nulls_last("f_analisis")).limit(limit))


def score_projection(scored: DataFrame, run_id: str, metric_name: str, metric_value: float,
                     keys: Sequence[str] = ("num_doc", "obl17", "num_doc_key", "obl17_key", "f_analisis")) -> DataFrame:
    """Keys (full grain, date included), split, score, run id and the run's metric."""
    present = [k for k in keys if k in scored.columns]
    return scored.select(*present, "split_group", "score", F.lit(run_id).alias("run_id"),
                         F.lit(float(metric_value)).alias(metric_name))
