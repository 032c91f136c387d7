"""Small helpers shared by the column-function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first(arr: Column | str) -> Column:
    """First element of an array; NULL for a NULL or empty array (never raises)."""
    return F.get(as_col(arr), 0)
