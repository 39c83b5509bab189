"""Numeric coercion and clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Any column as DOUBLE; text that is not a number becomes NULL (never an ANSI error)."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    return F.trim(c.cast("string")).try_cast("double")


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def finite_or_null(c: Column | str) -> Column:
    """+inf, -inf and NaN -> NULL (missing), other values unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(is_infinite(c) | F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def clip(c: Column | str, lo: float | Column, hi: float | Column) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (``greatest`` alone would turn NULL into ``lo``)."""
    c = F.col(c) if isinstance(c, str) else c
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, lo_c), hi_c))


def fround(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary value: ``round(x * 10^d) / 10^d``.

    Spark's ``round`` rounds the double's shortest decimal text, so a value printed as
    ``35.82375`` goes up even when its binary value lies just below the midpoint; this form
    rounds the value as stored, which is what most SQL engines do for DOUBLE.
    """
    m = float(10 ** digits)
    if isinstance(c, str):
        # one expression object instead of a chain of builder calls (cheaper to plan for
        # selects of many columns)
        return F.expr(f"CAST(round(CAST(`{c}` AS DOUBLE) * {m!r}D, 0) / {m!r}D AS DOUBLE)")
    return (F.round(c.cast("double") * F.lit(m), 0) / F.lit(m)).cast("double")
