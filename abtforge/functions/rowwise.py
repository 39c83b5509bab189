"""Row-wise reductions over many columns (NULL counts as 0)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _zeroed(c: str | Column) -> Column:
    return F.coalesce(F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c, F.lit(0))


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Sum across columns, NULL as 0.  No columns -> literal 0.

    One rule at every width: a balanced tree of additions, so the result keeps the columns' own
    type and the expression is only log2(n) deep however many columns there are.
    """
    level = [_zeroed(c) for c in cols]
    if not level:
        return F.lit(0)
    while len(level) > 1:
        paired = [a + b for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2:]
    return level[0]


def row_max(cols: Sequence[str | Column]) -> Column:
    """Maximum across columns, NULL as 0.  Works for a single column (``greatest`` needs two)."""
    parts = [_zeroed(c) for c in cols]
    if len(parts) < 2:
        return parts[0] if parts else F.lit(0)
    return F.greatest(*parts)
