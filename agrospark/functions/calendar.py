"""Calendar expressions: 4-season and 2-season maps, cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrospark.dims import SEASON4


def season4(month: Column) -> Column:
    """Panel season: 12-2 Dry, 3-5 Transition, 6-9 Rainy, 10-11 Post-Rainy (null month -> null)."""
    expr = None
    for m, s in SEASON4:
        expr = F.when(month == m, F.lit(s)) if expr is None else expr.when(month == m, F.lit(s))
    return expr


def season2(month: Column, wet_months=(6, 7, 8, 9, 10)) -> Column:
    """Two-season map. Variants in use: wet 6-10 (alerts/norms) and wet 5-10 (empirical baseline)."""
    return F.when(month.isNull(), F.lit(None).cast("string")) \
        .when(month.isin(list(wet_months)), F.lit("Wet")).otherwise(F.lit("Dry"))


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period, the same operation order as the platform: (2*pi*x)/period."""
    ang = F.lit(2.0 * math.pi) * x.cast("double") / F.lit(float(period))
    return F.sin(ang), F.cos(ang)
