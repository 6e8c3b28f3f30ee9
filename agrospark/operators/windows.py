"""Time-series window operators (G1-G6), all over ``partitionBy(part).orderBy(order)`` row frames.

Every operator here uses the same partition/order, so a chain of them (a feature frame) is
planned as one Exchange on the series key and one Sort; bounded frames are evaluated with a
sliding buffer. Row-based frames follow pandas ``rolling(n)``: strict, min_periods = n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrospark.functions.rolling import strict_avg, strict_sum
from agrospark.operators import blocked as B


def _w(part, order):
    part = [part] if isinstance(part, str) else list(part)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*part).orderBy(*order)


def lags(df: DataFrame, col: str = "total_precipitation_sum", ks: Sequence[int] = (1, 3, 7),
         prefix: str = "precipitation_lag", part="region", order="date", block_rows: int | None = None) -> DataFrame:
    def exprs(w):
        return {f"{prefix}_{k}": F.lag(col, k).over(w) for k in ks}
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.bounded(df, exprs, part, order, block_rows, back=max(ks))
    return df.withColumns(exprs(_w(part, order)))


def rain_target(df: DataFrame, col: str = "total_precipitation_sum", out: str = "target",
                part="region", order="date", block_rows: int | None = None) -> DataFrame:
    """Next day's value within the series; the last day of a series gets 0."""
    def exprs(w):
        return {out: F.coalesce(F.lead(col, 1).over(w), F.lit(0.0))}
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.bounded(df, exprs, part, order, block_rows, fwd=1)
    return df.withColumns(exprs(_w(part, order)))


def moving_averages(df: DataFrame, spec: dict[str, str], windows: Sequence[int] = (3, 7, 15),
                    part="region", order="date", block_rows: int | None = None) -> DataFrame:
    """Strict moving averages: ``{prefix}_ma_{n}`` for each prefix -> column.
    ``block_rows``: evaluate per row block with a halo (skew-proof, see ``operators.blocked``)."""
    def exprs(w):
        return {f"{p}_ma_{n}": strict_avg(F.col(c), w, n) for n in windows for p, c in spec.items()}
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.bounded(df, exprs, part, order, block_rows, back=max(windows) - 1)
    return df.withColumns(exprs(_w(part, order)))


def ma_deviation(df: DataFrame, spec: dict[str, str], windows: Sequence[int] = (7, 15, 30)) -> DataFrame:
    """``{prefix}_deviation_{n}`` = column - its moving average (projection over moving_averages)."""
    return df.withColumns({f"{p}_deviation_{n}": F.col(c) - F.col(f"{p}_ma_{n}") for n in windows
                           for p, c in spec.items()})


def rolling_sums(df: DataFrame, col: str = "total_precipitation_sum", periods: Sequence[int] = (7, 15, 30, 60),
                 prefix: str = "precip_cumul", part="region", order="date", block_rows: int | None = None) -> DataFrame:
    def exprs(w):
        return {f"{prefix}_{n}": strict_sum(F.col(col), w, n) for n in periods}
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.bounded(df, exprs, part, order, block_rows, back=max(periods) - 1)
    return df.withColumns(exprs(_w(part, order)))


def consecutive_dry_days(df: DataFrame, col: str = "total_precipitation_sum", threshold: float = 0.1,
                         out: str = "consecutive_dry_days", part="region", order="date",
                         block_rows: int | None = None) -> DataFrame:
    """Length of the current dry run (value < threshold; null counts as wet): 1, 2, 3... inside a
    run, 0 on wet days. Single pass: position - position of the last wet day (0 if none yet)."""
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.dry_run(df, col, threshold, out, part, order, block_rows)
    w = _w(part, order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    dry = F.coalesce(F.col(col) < F.lit(threshold), F.lit(False))
    pos = F.row_number().over(w)
    df = df.withColumns({"_pos": pos, "_dry": dry})
    last_wet = F.max(F.when(~F.col("_dry"), F.col("_pos"))).over(run)
    return df.withColumn(out, F.when(F.col("_dry"), F.col("_pos") - F.coalesce(last_wet, F.lit(0)))
                         .otherwise(F.lit(0)).cast("int")).drop("_pos", "_dry")
