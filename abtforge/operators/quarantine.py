"""Key quality as rows: every ingested row is good or set aside with its reasons, and counted per file.

One write of the marked rows, laid out by verdict, serves everything: the good rows and the rows set
aside are its two folders, and the ledger is one aggregate over it, so its totals are those of the rows
that were stored.  Rows that share a grain are found by one grouping with map-side counts over the
keys alone; few such groups (counted) are broadcast, many are joined, where AQE splits a hot one.

Reasons: ``malformed_row`` (the reader kept the row's text), ``no_client``, ``no_obligation`` (missing or blank, or
no finite number), ``no_date`` (missing or blank), ``bad_date`` (no date), and ``duplicate_grain`` for all copies of a
(client, obligation, date) that stands on several rows without another fault.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.functions.keys import client_key, date_key, obligation_key
from abtforge.sources.tables import CORRUPT

REASONS = ("malformed_row", "no_client", "no_obligation", "no_date", "bad_date", "duplicate_grain")
BROADCAST_GROUPS = 100_000


class Split(NamedTuple):
    good: DataFrame
    set_aside: DataFrame
    ledger: DataFrame


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def row_reasons(df: DataFrame, client: str = "num_doc", obligation: str = "obl17", date: str = "f_analisis") -> Column:
    """The reasons that a row's own cells give, in the order of ``REASONS``."""
    key = obligation_key(obligation, df.schema[obligation].dataType)
    tests = {
        "malformed_row": F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False),
        "no_client": _blank(F.col(client)),
        "no_obligation": key.isNull(),
        "no_date": _blank(F.col(date)),
        "bad_date": ~_blank(F.col(date)) & date_key(date).isNull(),
    }
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in tests.items()]))


def marked_rows(df: DataFrame, client: str = "num_doc", obligation: str = "obl17", date: str = "f_analisis") -> DataFrame:
    """``df`` with the canonical keys (``_client``, ``_obligation``, ``_date``) and ``reasons`` without duplicates."""
    return df.select("*", client_key(client).alias("_client"), obligation_key(obligation, df.schema[obligation].dataType).alias("_obligation"),
                     date_key(date).alias("_date"), row_reasons(df, client, obligation, date).alias("reasons"))


def with_duplicates(marked: DataFrame) -> DataFrame:
    """Adds ``duplicate_grain`` to all sound rows whose keys stand on several sound rows."""
    keys = ["_client", "_obligation", "_date"]
    sound = F.size("reasons") == 0
    groups = marked.where(sound).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    groups = groups.select(*[F.col(k).alias(f"{k}_twice") for k in keys]).checkpoint(eager=True)
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    same = sound
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}_twice"))
    out = marked.join(groups, same, "left")
    twice = F.col("_client_twice").isNotNull()
    return out.withColumn("reasons", F.when(twice, F.array(F.lit("duplicate_grain"))).otherwise(F.col("reasons"))).drop(*[f"{k}_twice" for k in keys])


def split_rows(df: DataFrame, path: str, file: str = "_file", client: str = "num_doc", obligation: str = "obl17", date: str = "f_analisis",
               unique: bool = True) -> Split:
    """Good rows, rows set aside (with ``reasons``) and the ledger per ``file``, over one write to ``path``.

    ``ledger``: file, n_rows, n_good, n_set_aside, and one count per reason; a row can have several reasons.
    """
    from abtforge.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    marked = marked_rows(df, client, obligation, date)
    if unique:
        # written first: the keys are grouped and joined from storage, the files are parsed once
        marked.write.mode("overwrite").parquet(f"{path}/marked")
        marked = with_duplicates(spark.read.schema(marked.schema).parquet(f"{path}/marked"))
    marked = marked.withColumn("ok", (F.size("reasons") == 0).cast("int"))
    marked.write.mode("overwrite").partitionBy("ok").parquet(f"{path}/rows")
    stored = spark.read.schema(marked.schema).parquet(f"{path}/rows")
    hidden = ["_client", "_obligation", "_date", "ok"]
    good = stored.where("ok = 1").drop(*hidden, "reasons", CORRUPT)
    aside = stored.where("ok = 0").drop(*hidden)
    counts = [F.count_if(F.array_contains("reasons", r)).alias(r) for r in REASONS]
    ledger = stored.groupBy(F.col(file).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("ok") == 1).alias("n_good"), F.count_if(F.col("ok") == 0).alias("n_set_aside"), *counts)
    return Split(good, aside, ledger)
