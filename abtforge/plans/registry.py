"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole driver tables.
The oracle is an independent SQL formulation over the same tables; doubles are rounded on
both sides so that summation order cannot change the comparison.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """``count_if(...)`` -> ``CAST(count_if(...) AS BIGINT)``: DuckDB types it HUGEINT, while
    counts are BIGINT in Spark."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _bigint_count_if(sql[j + len(token):k])
        out.append(sql[i:j] + f"CAST(count_if({inner}) AS BIGINT)")
        i = k + 1


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = _bigint_count_if(oracle)
        return fn
    return deco


def _load() -> None:
    from abtforge.plans import q_core, q_decide, q_model, q_profile_state, q_selection, q_snapshots, q_traps, q_wide  # noqa: F401


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
