"""Numeric helpers shared by operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _grid(digits: int) -> float:
    """Power of two at least 10**digits: scaling by it is exact in binary floating point."""
    return float(2 ** math.ceil(digits * math.log2(10)))


def snap(x: Column, digits: int = 6) -> Column:
    """Deterministic rounding onto a binary grid finer than 10**-digits: floor(x*2^k + 0.5) / 2^k.

    x*2^k is exact, so Spark and DuckDB give bit-identical results for the same x, and unlike
    decimal rounding there are no exact ties on the dyadic values interpolation produces. Used
    at report boundaries and before threshold tests, to remove summation-order noise of doubles
    (window and group sums add in an engine- and partition-dependent order).
    """
    g = _grid(digits)
    return F.floor(x * F.lit(g) + F.lit(0.5)) / F.lit(g)


def nan_to_null(x: Column) -> Column:
    """pandas treats NaN as missing; Spark treats it as a value. Normalise at ingest."""
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def flag(cond: Column) -> Column:
    """0/1 int from a predicate; a null comparison counts as false (as in pandas)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def score_cut(score: Column, edges) -> Column:
    """Right-closed cut: (-inf, e0] -> 0, (e0, e1] -> 1, ..., (e_last, inf) -> len(edges)."""
    expr = None
    for i, e in enumerate(edges):
        cond = score <= F.lit(float(e))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(edges)))
