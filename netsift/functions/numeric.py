"""Null- and ANSI-safe arithmetic used by the feature columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den as DOUBLE; division by zero gives NULL instead of an ANSI error."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def log1p0(c) -> Column:
    """log(1 + coalesce(c, 0)); NULL where the argument is ≤ -1."""
    x = F.coalesce(_col(c).cast("double"), F.lit(0.0))
    return F.when(x > -1.0, F.log1p(x))


def as_flag(cond: Column) -> Column:
    """Boolean → 0/1 INT, NULL → 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))
