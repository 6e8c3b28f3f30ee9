"""Strict row-based rolling aggregates (pandas ``rolling(n)`` with min_periods = n).

The result is null until n rows exist and null when any of the n values is null.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def strict_avg(x: Column, w: WindowSpec, n: int) -> Column:
    f = _frame(w, n)
    return F.when(F.count(x).over(f) == n, F.avg(x).over(f))


def strict_sum(x: Column, w: WindowSpec, n: int) -> Column:
    f = _frame(w, n)
    return F.when(F.count(x).over(f) == n, F.sum(x).over(f))
