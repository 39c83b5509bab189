"""Aggregate expressions that stay defined where Spark's built-ins raise under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows where both values are present.

    NULL (not an error, not NaN) when either side has zero variance or fewer than two
    pairs.  Computed from centred second moments via ``covar_samp``/``var_samp`` on the
    pairwise-complete rows, each of which merges partial buffers across tasks.
    """
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    xp = F.when(both, x.cast("double"))
    yp = F.when(both, y.cast("double"))
    cov = F.covar_samp(xp, yp)
    vx = F.var_samp(xp)
    vy = F.var_samp(yp)
    den = F.sqrt(vx) * F.sqrt(vy)
    return F.when((vx > 0) & (vy > 0), F.try_divide(cov, den)).cast("double")
