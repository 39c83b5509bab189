"""Wide-table compaction.

Column names of the wide table follow one grammar,
``<stat>_trx_<metric>_<channel>[_<operation>][_smmlv]_<window>``.  Every name is parsed once into
its parts; the parsed names are grouped by (family, window, metric), and all outputs - totals,
maxima, shares, indices, trends - come from one table of specifications over those groups.
Parsing happens at plan time on ``df.columns``; the data work is two projections, so Spark reads
only the columns that some output needs and the whole operator is one map-only stage.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.functions.names import normalized_names
from abtforge.functions.rowwise import row_max, row_sum

# Channel families of the source's channel codes, and the statistics, metrics and
# windows that enter the compact table.
DEFAULT_CHANNEL_GROUPS: dict[str, list[str]] = {
    "digital": ["app_per", "app_pyme", "svp", "sve", "sv_pyme", "pse_per", "pse_emp", "btn_bco", "bill_mvl"],
    "fisico": ["suc_fis", "gr"],
    "efectivo": ["cajero"],
    "tarjeta": ["pos"],
    "otros": ["cr_bcrio", "rec_e_v", "suc_tel"],
}
DEFAULT_STATS = ("sum", "avg")
DEFAULT_METRICS = ("mnt", "cnt")
DEFAULT_WINDOWS = ("ult6", "ult12")

ALL = "all"  # pseudo-family of the global totals


class WideName(NamedTuple):
    """The parts of one column name; ``subject`` is what stands between metric and window."""

    column: str
    stat: str
    metric: str
    subject: tuple[str, ...]
    window: str


@dataclass(frozen=True)
class Compaction:
    """What to compact: ``families`` maps a family to channel codes, ``stats`` are in order of
    preference for a ready-made global total.  ``anywhere`` matches a code at any place of the
    name, even inside a word (as the source does), instead of as whole words."""

    families: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(DEFAULT_CHANNEL_GROUPS))
    keys: Sequence[str] = ("num_doc", "obl17", "f_analisis")
    text_keys: Sequence[str] = ("num_doc", "obl17")
    stats: Sequence[str] = DEFAULT_STATS
    metrics: Sequence[str] = DEFAULT_METRICS
    windows: Sequence[str] = DEFAULT_WINDOWS
    without: Sequence[str] = ("smmlv",)
    anywhere: bool = False


class Ratio(NamedTuple):
    """``name`` = amount of ``top`` / (sum of the amounts of ``bottom`` + 1); parts are
    (family, window)."""

    name: str
    top: tuple[str, str]
    bottom: tuple[tuple[str, str], ...]


def parse_wide_name(column: str, spec: Compaction) -> WideName | None:
    """The parsed name, or None when the grammar or the specification leaves the column out."""
    words = column.split("_")
    if column in spec.keys or len(words) < 5 or set(words) & set(spec.without):
        return None
    stat, marker, metric, *subject, window = words
    fits = marker == "trx" and stat in spec.stats and metric in spec.metrics and window in spec.windows
    return WideName(column, stat, metric, tuple(subject), window) if fits else None


def families_of(name: WideName, spec: Compaction) -> list[str]:
    """Families one of whose codes occurs in the name."""
    subject = f"_{'_'.join(name.subject)}_"
    hit = (lambda code: code in name.column) if spec.anywhere else (lambda code: f"_{code}_" in subject)
    return [family for family, codes in spec.families.items() if any(map(hit, codes))]


def grouped_columns(columns: Sequence[str], spec: Compaction) -> dict[tuple[str, str, str], list[str]]:
    """(family, window, metric) -> source columns, in table order; ``ALL`` holds the one
    ready-made global total, where the table has it."""
    groups: dict[tuple[str, str, str], list[str]] = {}
    totals: dict[tuple[str, str, str], WideName] = {}
    for name in filter(None, (parse_wide_name(c, spec) for c in columns)):
        for family in families_of(name, spec):
            groups.setdefault((family, name.window, name.metric), []).append(name.column)
        if name.subject == ("total",):
            at = (ALL, name.window, name.metric)
            if at not in totals or spec.stats.index(name.stat) < spec.stats.index(totals[at].stat):
                totals[at] = name
    return groups | {at: [name.column] for at, name in totals.items()}


def ratios(spec: Compaction) -> Iterator[Ratio]:
    """Every ratio output, whether or not its inputs exist."""
    for w in spec.windows:
        everything = ((ALL, w),)
        for family in spec.families:
            yield Ratio(f"share_mnt_{family}_{w}", (family, w), everything)
        yield Ratio(f"index_digitalizacion_{w}", ("digital", w), (("digital", w), ("fisico", w)))
        yield Ratio(f"preferencia_efectivo_{w}", ("efectivo", w), everything)
    if {"ult6", "ult12"} <= set(spec.windows):
        for family in spec.families:
            yield Ratio(f"trend_mnt_{family}_ult6_vs_ult12", (family, "ult6"), ((family, "ult12"),))


def _total(metric: str, family: str, window: str) -> str:
    return f"total_{metric}_{family}_{window}"


def compact_columns(columns: Sequence[str], spec: Compaction) -> list[str]:
    """Names of the compact table's features, in output order."""
    groups = grouped_columns(columns, spec)
    out = []
    for (family, window, metric) in _ordered(groups, spec):
        out += [_total(metric, family, window), f"max_{metric}_{family}_{window}"]
    out += [_total(m, ALL, w) for w in spec.windows for m in spec.metrics]
    return out + [r.name for r in ratios(spec) if _computable(r, groups)]


def _ordered(groups, spec: Compaction) -> list[tuple[str, str, str]]:
    every = [(f, w, m) for f in spec.families for w in spec.windows for m in spec.metrics]
    return [g for g in every if g in groups]


def _computable(ratio: Ratio, groups) -> bool:
    return all(f == ALL or (f, w, "mnt") in groups for f, w in (ratio.top, *ratio.bottom))


def build_compact(df_raw: DataFrame, spec: Compaction | None = None) -> DataFrame:
    """Keys and compact features, NULL as 0.

    A global total is the ready-made column where the table has one, else the sum of the family
    totals, else 0.  A ready-made total covers one statistic while family totals add every
    statistic, so a share can exceed 1; this is the source's definition.
    """
    spec = spec or Compaction()
    df = df_raw.toDF(*normalized_names(df_raw.columns))
    missing = [k for k in spec.keys if k not in df.columns]
    if missing:
        raise ValueError(f"wide table is missing keys {missing}")
    groups = grouped_columns(df.columns, spec)
    found = _ordered(groups, spec)

    def global_total(window: str, metric: str) -> Column:
        ready = groups.get((ALL, window, metric))
        return row_sum(ready or [c for f, w, m in found if (w, m) == (window, metric) for c in groups[(f, w, m)]])

    keys = [F.col(k).cast("string").alias(k) if k in spec.text_keys else F.col(k) for k in spec.keys]
    totals = df.select(
        *keys,
        *[row_sum(groups[(f, w, m)]).alias(_total(m, f, w)) for f, w, m in found],
        *[row_max(groups[(f, w, m)]).alias(f"max_{m}_{f}_{w}") for f, w, m in found],
        *[global_total(w, m).alias(_total(m, ALL, w)) for w in spec.windows for m in spec.metrics])

    def amount(part: tuple[str, str]) -> Column:
        return F.col(_total("mnt", *part))

    def value(ratio: Ratio) -> Column:
        return F.try_divide(amount(ratio.top), row_sum([amount(p) for p in ratio.bottom]) + F.lit(1))

    out = totals.select("*", *[value(r).alias(r.name) for r in ratios(spec) if _computable(r, groups)])
    return out.select(*spec.keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in compact_columns(df.columns, spec)])
