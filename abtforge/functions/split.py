"""Deterministic TRAIN / TEST / OOT assignment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(c: Column | str, buckets: int = 10, method: str = "md5") -> Column:
    """Bucket in [0, buckets) from the id's text; NULL ids hash as ``'NA'``.

    ``md5``: first 8 hex digits of the MD5 as an integer (portable: the same buckets in any
    SQL engine with md5).  ``xxhash64``: Spark's native 64-bit hash, cheaper.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.coalesce(c.cast("string"), F.lit("NA"))
    if method == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(text), F.lit(buckets))
    raise ValueError(f"unknown hash method {method!r}")


def hash_split(c: Column | str, train_below: int = 7, test_below: int = 9, buckets: int = 10,
               method: str = "md5") -> Column:
    """Bucket < 7 -> TRAIN, < 9 -> TEST, else OOT (70/20/10 with the defaults)."""
    b = hash_bucket(c, buckets, method)
    return F.when(b < train_below, "TRAIN").when(b < test_below, "TEST").otherwise("OOT")


def _date(v: str | dt.date) -> Column:
    return F.lit(v if isinstance(v, dt.date) else dt.date.fromisoformat(v))


def temporal_split(c: Column | str, train_before: str | dt.date, test_start: str | dt.date,
                   test_end: str | dt.date) -> Column:
    """date < train_before -> TRAIN; test_start <= date < test_end -> TEST; other dates -> OOT.

    A NULL date gets a NULL split rather than silently landing in OOT.
    """
    for name, v in (("train_before", train_before), ("test_start", test_start), ("test_end", test_end)):
        if v is None or v == "":
            raise ValueError(f"temporal split needs {name}")
    c = F.col(c) if isinstance(c, str) else c
    d = c.try_cast("date")
    return (
        F.when(d.isNull(), F.lit(None).cast("string"))
        .when(d < _date(train_before), "TRAIN")
        .when((d >= _date(test_start)) & (d < _date(test_end)), "TEST")
        .otherwise("OOT")
    )
