"""Joins (J1-J3): analytic base table, key match rate, orphan count."""

from __future__ import annotations

from functools import reduce
from typing import Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.operators.clean import KEY_CANONICAL, KEY_SOURCE, zero_fill_numeric

Side = Union[DataFrame, tuple]


def _side(s: Side, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if isinstance(s, tuple):
        return s[0], list(s[1])
    return s, list(keys)


def type_of(df: DataFrame, cols: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [kinds[c] for c in cols]


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once (one aggregate, partial on the map side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "right side") -> None:
    """Raise when ``keys`` do not identify rows (guards a left join against fan-out)."""
    dups = duplicate_key_groups(df, keys).limit(1).count()
    if dups:
        raise ValueError(f"{what} is not unique on {list(keys)}: a left join would duplicate rows")

# Label columns.
LABELS = ("var_rta", "target_final")


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = 0.02, tracked: int = 10_000) -> dict[int, int]:
    """{hash of the key: pieces} for the keys that hold more than ``share`` of the rows.

    One pass with a mergeable frequent-items sketch per task; nothing is shuffled by key.  At most
    1 / ``share`` keys come to the driver.  The sketch never misses a key above rows / ``tracked``.
    """
    top = F.expr(f"approx_top_k(_h, {max(1, min(tracked, int(2 / share)))}, {tracked})")
    found = df.select(F.xxhash64(*keys).alias("_h")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return {t["item"]: min(1024, -(-t["count"] // max(1, int(share * found["n"])))) for t in found["top"] or [] if t["count"] > share * found["n"]}


def _pieces(on: Sequence[str], heavy: dict[int, int]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in heavy.items() for x in kv]), F.xxhash64(*on)), F.lit(1)).cast("long")


def with_piece(df: DataFrame, on: Sequence[str], heavy: dict[int, int], name: str = "_piece") -> DataFrame:
    """``df`` with the piece of its key that a row belongs to, by the hash of the whole row (0 if the key is not heavy)."""
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return df.withColumn(name, F.pmod(F.xxhash64(*hashed), _pieces(on, heavy)))


def in_all_pieces(side: DataFrame, on: Sequence[str], heavy: dict[int, int], name: str = "_piece") -> DataFrame:
    """``side`` with its rows of heavy keys once per piece."""
    return side.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), _pieces(on, heavy) - 1)))


def build_base_table(driver: DataFrame, sides: Sequence[Side], keys: Sequence[str] = KEY_CANONICAL,
                     drop_source_keys: Sequence[str] = KEY_SOURCE, fill_numeric: bool = True,
                     require_unique: bool = False, presence_flags: bool = False,
                     not_filled: Sequence[str] = LABELS, hot_share: float | None = 0.02) -> DataFrame:
    """Left-join every side onto the driver table, in order, on the canonical keys.

    ``sides`` holds DataFrames (joined on ``keys``) or ``(DataFrame, keys)`` pairs for sides
    at a coarser grain (for example client-level features joined on the client key only).
    Rows whose obligation key is NULL are dropped from the driver first.  The source key
    columns are dropped from each side; any other column name shared with the running result
    raises instead of producing an ambiguous column.  Numeric non-key columns are zero
    filled, but not the labels (a missing label is not a negative one); ``presence_flags`` adds ``has_side<i>`` so a missing match stays visible.

    Plan: the driver is shuffled once on ``keys`` and that partitioning is reused by every
    join on the same keys; AQE turns small sides into broadcast joins and splits skewed
    partitions at run time.  A side at a coarser grain can meet a hot key, which AQE cannot split
    where the side is aggregated on that key or a grouping follows: the driver's keys that hold more
    than ``hot_share`` of its rows are counted first and joined in pieces (None: never).
    """
    keys = list(keys)
    df = driver.filter(F.col(keys[1]).isNotNull()) if len(keys) > 1 else driver
    flag_cols = []
    all_keys = set(keys) | set(drop_source_keys)
    heavy: dict[tuple[str, ...], dict[int, int]] = {}
    names = list(df.columns)
    for i, s in enumerate(sides):
        side, on = _side(s, keys)
        side = side.drop(*[c for c in drop_source_keys if c in side.columns and c not in on])
        clash = (set(side.columns) - set(on)) & set(df.columns)
        if clash:
            raise ValueError(f"side {i} repeats non-key columns {sorted(clash)}; rename them first")
        if require_unique:
            assert_unique(side, on, f"side {i}")
        if presence_flags:
            flag = f"has_side{i}"
            side = side.withColumn(flag, F.lit(1))
            flag_cols.append(flag)
        all_keys |= set(on)
        names += [c for c in side.columns if c not in on]
        coarse = hot_share and set(on) < set(keys) and type_of(df, on) == type_of(side, on)
        if coarse and tuple(on) not in heavy:
            heavy[tuple(on)] = heavy_keys(driver, on, hot_share)
            if heavy[tuple(on)]:
                df = with_piece(df, on, heavy[tuple(on)], f"_piece_{'_'.join(on)}")
        if coarse and heavy[tuple(on)]:
            # all sides on these keys share the partitioning of the pieces
            piece = f"_piece_{'_'.join(on)}"
            df = df.join(in_all_pieces(side, on, heavy[tuple(on)], piece), on=[*on, piece], how="left")
        else:
            df = df.join(side, on=on, how="left")
    if any(heavy.values()):
        df = df.select(*[F.col(f"`{c}`") for c in names])
    if flag_cols:
        df = df.select(*[F.col(c) for c in df.columns if c not in flag_cols],
                       *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in flag_cols])
    if fill_numeric:
        df = zero_fill_numeric(df, exclude=all_keys | set(flag_cols) | set(not_filled))
    return df


def match_rates(left: DataFrame, sides: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """(name, left_keys, matched_keys, match_rate) for every (name, right, keys) side.

    Sides on the same keys share one pass: the distinct keys of ``left`` are built once, each side's
    distinct keys (partial aggregation before the shuffle) are tagged and left-joined on that
    partitioning, and all counts come from one aggregate.
    """
    by_keys: dict[tuple[str, ...], list[tuple[str, DataFrame]]] = {}
    for name, right, keys in sides:
        by_keys.setdefault(tuple(keys), []).append((name, right))
    parts = []
    for keys, group in by_keys.items():
        joined = left.select(*keys).distinct()
        for i, (_, right) in enumerate(group):
            joined = joined.join(right.select(*keys).distinct().withColumn(f"_hit{i}", F.lit(1)), list(keys), "left")
        counts = joined.agg(F.count(F.lit(1)).alias("left_keys"), *[F.count(f"_hit{i}").alias(f"_n{i}") for i in range(len(group))])
        rows = F.array(*[F.struct(F.lit(name).alias("name"), F.col("left_keys"), F.col(f"_n{i}").alias("matched_keys")) for i, (name, _) in enumerate(group)])
        parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    rate = F.try_divide(F.col("matched_keys").cast("double"), F.col("left_keys").cast("double"))
    return reduce(DataFrame.unionByName, parts).withColumn("match_rate", F.coalesce(rate, F.lit(0.0)))


def match_rate(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct keys of ``left`` found in ``right``: one row (name, left_keys, matched_keys, match_rate)."""
    return match_rates(left, [(name, right, keys)])


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``child`` with no ``parent`` row (anti join); NULL keys count as orphans."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(k).alias(f"_pk{i}") for i, k in enumerate(parent_keys)])
    cond = [child[c] == p[f"_pk{i}"] for i, c in enumerate(child_keys)]
    return child.join(p, on=cond, how="left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                 parent_keys: Sequence[str] | None = None) -> DataFrame:
    return orphans(child, parent, child_keys, parent_keys).agg(F.count(F.lit(1)).alias("n_orphans"))
