"""Cleaning (P1-P8): names, strings, canonical keys, NULL-key filter, zero fill."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtforge.functions.keys import client_key, date_key, obligation_key
from abtforge.functions.names import normalized_names

KEY_SOURCE = ("num_doc", "obl17", "f_analisis")
KEY_CANONICAL = ("num_doc_key", "obl17_key", "f_analisis")
ZERO_FILL_TYPES = (T.DoubleType, T.LongType, T.IntegerType, T.FloatType)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column (strip, lower, space/'.' -> '_') in one projection."""
    return df.toDF(*normalized_names(df.columns))


def clean_dataset(df: DataFrame) -> DataFrame:
    """Normalise names and trim every string column, in a single ``select``.

    Keys and grain are unchanged.  Name collisions after normalising raise.
    """
    names = normalized_names(df.columns)
    exprs = []
    for field, new in zip(df.schema.fields, names):
        c = F.col(f"`{field.name}`")
        exprs.append((F.trim(c) if isinstance(field.dataType, T.StringType) else c).alias(new))
    return df.select(*exprs)


def add_key_columns(df: DataFrame, client: str = "num_doc", obligation: str = "obl17",
                    date: str = "f_analisis") -> DataFrame:
    """Add ``num_doc_key`` (text), ``obl17_key`` (integer text) and cast the date column to DATE."""
    dtype = df.schema[obligation].dataType
    others = [F.col(f"`{c}`") for c in df.columns if c != date]
    return df.select(
        *others,
        date_key(date).alias(date),
        client_key(client).alias(f"{client}_key"),
        obligation_key(obligation, dtype).alias(f"{obligation}_key"),
    )


def drop_null_keys(df: DataFrame, key: str = "obl17_key") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def zero_fill_numeric(df: DataFrame, exclude: Iterable[str] = (), presence_flags: Sequence[str] = ()) -> DataFrame:
    """Fill NULL with 0 in DOUBLE/BIGINT/INT/FLOAT columns not in ``exclude``.

    Decimal and small integer columns are left alone (as the source semantics do).  NaN in
    a double column is *not* touched here; ``na.fill`` would turn it into 0 as well.
    ``presence_flags`` names columns whose NULL-ness should be kept as ``has_<col>`` before
    filling, so that "no row" and "zero" remain distinguishable.
    """
    skip = set(exclude)
    flags = [F.col(c).isNotNull().cast("int").alias(f"has_{c}") for c in presence_flags]
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in skip and isinstance(f.dataType, ZERO_FILL_TYPES):
            exprs.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs, *flags)
