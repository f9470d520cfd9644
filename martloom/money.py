"""Exact sums: the result of a money or mean aggregate must not depend on task order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,4)"
RATIO = "decimal(28,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str, kind: str = MONEY) -> Column:
    """Sum in decimal, publish as double."""
    return F.sum(_col(c).cast(kind)).cast("double")


def exact_mean(c: Column | str, kind: str = RATIO) -> Column:
    """Mean of the non-null values; null (not NaN) when there are none."""
    n = F.count(_col(c))
    return F.when(n > 0, exact_sum(c, kind) / n)
