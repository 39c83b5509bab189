"""Canonical join keys (client, obligation, analysis date).

Obligation ids arrive as DOUBLE, BIGINT or text depending on how a source was read.  The
canonical form is the integer written out in full, as text.  Doubles go through
``decimal(38,0)`` rather than ``%.0f`` formatting, text is only treated as a number when it
*is* one (a code such as ``ABCE1`` stays text), and every cast is a ``try_cast`` so that
ANSI mode never aborts a job on one bad value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_TEXT = r"^[+-]?[0-9]+(\.0*)?$"
_SCI_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$"


def client_key(c: Column | str) -> Column:
    """Client key: text, trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c.cast("string"))


def date_key(c: Column | str) -> Column:
    """Analysis date: DATE, NULL when the value is not a date."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("date")


def _text_obligation(c: Column) -> Column:
    t = F.trim(c)
    return (
        F.when(c.isNull() | (t == ""), F.lit(None).cast("string"))
        .when(t.rlike(_INT_TEXT), F.regexp_replace(F.regexp_replace(t, r"\.0*$", ""), r"^\+", ""))
        .when(t.rlike(_SCI_TEXT), t.try_cast(T.DecimalType(38, 0)).cast("string"))
        .otherwise(t)
    )


def _float_obligation(c: Column) -> Column:
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("string")).otherwise(
        c.try_cast(T.DecimalType(38, 0)).cast("string")
    )


def obligation_key(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Obligation key as full integer text.

    ``dtype`` is the source column's type (``df.schema[name].dataType``); the expression is
    chosen at plan time from it.  Without it the column is treated as text.
    """
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _float_obligation(c)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("string")
    if isinstance(dtype, T.DecimalType):
        return c.try_cast(T.DecimalType(38, 0)).cast("string")
    return _text_obligation(c.cast("string"))
