"""Gap filling.

Per-series operators use one window spec ``partitionBy(part).orderBy(order)`` for every column,
so Spark plans a single Exchange + Sort for all of them. Table-order fills (a value crossing from
one series into the next, as pandas' frame-wide ffill/bfill does) never run an unpartitioned
window over the facts: a one-row-per-series summary carries the edge values, a window over that
small table finds each series' neighbours, and a join brings the carries back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrospark.operators import blocked as B
from agrospark.session import written


def _cols(part, order):
    part = [part] if isinstance(part, str) else list(part)
    order = [order] if isinstance(order, str) else list(order)
    return part, order


def _w(part, order):
    return Window.partitionBy(*part).orderBy(*order)


def _running(part, order):
    """Running frame (unbounded preceding .. current): incremental, O(n) per partition."""
    return _w(part, order).rowsBetween(Window.unboundedPreceding, 0)


def _running_reversed(part, order):
    """Look-forward as a running frame over the reversed order. Spark evaluates
    ``rowsBetween(0, unboundedFollowing)`` by re-aggregating the tail for every row (quadratic);
    the reversed running frame is linear and shares the partitioning (one more sort, no shuffle)."""
    return Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order]) \
        .rowsBetween(Window.unboundedPreceding, 0)


def interpolate_linear(df: DataFrame, cols: Sequence[str], part="region", order="date",
                       block_rows: int | None = None) -> DataFrame:
    """Linear interpolation by row position within each series (not by elapsed time).

    Inner gaps: slope*(pos - pos0) + v0 with slope = (v1 - v0)/(pos1 - pos0) (numpy's form);
    leading gaps take the first value, trailing gaps the last; an all-null series stays null.
    ``block_rows``: evaluate per row block with carried neighbours (see ``operators.blocked``).
    """
    part, order = _cols(part, order)
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        return B.interpolate(df, cols, part[0], order[0], block_rows)
    w = _w(part, order)
    back = _running(part, order)
    fwd = _running_reversed(part, order)
    rn = "_rn"
    df = df.withColumn(rn, F.row_number().over(w))
    pos = F.col(rn)
    out = {}
    for c in cols:
        x = F.col(c)
        p_rn = F.max(F.when(x.isNotNull(), pos)).over(back)
        p_v = F.last(x, ignorenulls=True).over(back)
        n_rn = F.min(F.when(x.isNotNull(), pos)).over(fwd)
        n_v = F.last(x, ignorenulls=True).over(fwd)
        inner = (n_v - p_v) / (n_rn - p_rn).cast("double") * (pos - p_rn).cast("double") + p_v
        out[c] = F.coalesce(x, F.when(p_rn.isNotNull() & n_rn.isNotNull(), inner), p_v, n_v)
    return df.withColumns(out).drop(rn)


def _legs(df, cols, part, order, block_rows):
    """In-series ffill / bfill legs per column: window expressions, or blocked columns."""
    if block_rows:
        d = B.series_fills(df, cols, part[0], order[0], block_rows)
        return d, {c: F.col(f"_ff_{c}") for c in cols}, {c: F.col(f"_bf_{c}") for c in cols}, \
            [f"_ff_{c}" for c in cols] + [f"_bf_{c}" for c in cols]
    back = _running(part, order)
    fwd = _running_reversed(part, order)
    return df, {c: F.last(c, True).over(back) for c in cols}, {c: F.last(c, True).over(fwd) for c in cols}, []


def ffill_bfill(df: DataFrame, cols: Sequence[str], part="region", order="date",
                block_rows: int | None = None) -> DataFrame:
    """Per-series forward fill, then per-series backward fill."""
    part, order = _cols(part, order)
    block_rows = B.resolve(df, block_rows, part)
    if block_rows:
        d, ff, bf, helpers = _legs(df, cols, part, order, block_rows)
        return d.withColumns({c: F.coalesce(F.col(c), ff[c], bf[c]) for c in cols}).drop(*helpers)
    back = _running(part, order)
    fwd = _running_reversed(part, order)
    return df.withColumns({c: F.coalesce(F.col(c), F.last(c, True).over(back), F.last(c, True).over(fwd))
                           for c in cols})


def _split_points(s: DataFrame, part, count: int) -> list:
    """At most ``count`` series keys, sorted: those with the smallest hashes (a top-k, so a fair sample of any size)."""
    rows = s.select(*part).orderBy(F.xxhash64(*part), *part).limit(count).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) if v is not None else (False,) for v in r))


def _neighbour_carries_distributed(s: DataFrame, cols, part, block_rows: int) -> DataFrame:
    """Neighbour carries over the per-series summary without a single-partition window.

    The summary is cut into slices of consecutive series keys at literal split points, so a row's slice is a function of its
    key alone, however often and wherever it is computed. Windows run inside slices; the carry across slices
    comes from a per-slice summary (a window over at most as many rows as there are slices). Same result as
    the single-partition window.
    """
    s = written(s)                           # one row per series, read by the split points, the slice summary and the windows
    slices = int(min(512, max(16, 2 * s.count() // block_rows)))
    key = F.struct(*[F.col(p).alias(p) for p in part])
    kinds = [s.schema[p].dataType for p in part]
    points = _split_points(s, part, slices)
    splits = F.array(*[F.struct(*[F.lit(v).cast(k).alias(p) for v, k, p in zip(r, kinds, part)]) for r in points])
    d = s.withColumn("_b", F.size(F.filter(splits, lambda x: x <= key)) if points else F.lit(0))
    aggs, wins = {}, {}
    prevb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    nextb = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        aggs[f"_bl_{c}"] = F.max_by(F.col(f"_last_{c}"), F.when(F.col(f"_last_{c}").isNotNull(), key))
        aggs[f"_bf_{c}"] = F.min_by(F.col(f"_first_{c}"), F.when(F.col(f"_first_{c}").isNotNull(), key))
        wins[f"_cp_{c}"] = F.last(f"_bl_{c}", True).over(prevb)
        wins[f"_cn_{c}"] = F.last(f"_bf_{c}", True).over(nextb)
    bs = d.groupBy("_b").agg(*[v.alias(k) for k, v in aggs.items()])
    carry = bs.select("_b", *[v.alias(k) for k, v in wins.items()])         # one row per slice
    j = d.join(F.broadcast(carry), "_b", "left")
    inb = Window.partitionBy("_b").orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    inb_rev = Window.partitionBy("_b").orderBy(*[F.col(p).desc() for p in part]).rowsBetween(Window.unboundedPreceding, -1)
    sel = [F.col(p) for p in part]
    for c in cols:
        sel += [F.coalesce(F.last(f"_last_{c}", True).over(inb), F.col(f"_cp_{c}")).alias(f"_prev_{c}"),
                F.coalesce(F.last(f"_first_{c}", True).over(inb_rev), F.col(f"_cn_{c}")).alias(f"_next_{c}")]
    return j.select(*sel)


def _series_edges(df: DataFrame, cols, part, order, block_rows: int | None = None) -> DataFrame:
    """One row per series: its first and last non-null value of every column, plus the carries
    from neighbouring series (last non-null of any earlier series, first non-null of any later one).

    The neighbour search runs over this summary (one row per series), not over the facts: a window
    over the summary, or with ``block_rows`` (skew-proof mode) a distributed block evaluation.
    """
    # a single order column keeps the aggregation buffers fixed-width (hash aggregation)
    at = f"`{order[0]}`" if len(order) == 1 else f"struct({', '.join(f'`{o}`' for o in order)})"
    known = "case when `{0}` is not null then {1} end"
    s = df.groupBy(*part).agg(*[F.expr(f"{f}_by(`{c}`, {known.format(c, at)})").alias(f"_{n}_{c}") for c in cols for f, n in (("min", "first"), ("max", "last"))])
    return _neighbour_carries_distributed(s, cols, part, block_rows) if block_rows else _neighbour_carries(s, cols, part)


def _neighbour_carries(s: DataFrame, cols, part) -> DataFrame:
    """Carries by windows over the per-series summary (#series rows), never over the facts."""
    keys, back = ", ".join(f"`{p}`" for p in part), ", ".join(f"`{p}` desc" for p in part)
    over = "over (order by {} rows between unbounded preceding and 1 preceding)"
    return s.selectExpr(*[f"`{p}`" for p in part], *[x for c in cols for x in (f"last(`_last_{c}`, true) {over.format(keys)} as `_prev_{c}`", f"last(`_first_{c}`, true) {over.format(back)} as `_next_{c}`")])


def fallback_fill(df: DataFrame, cols: Sequence[str], part="region", order="date",
                  edges_from: DataFrame | None = None, block_rows: int | None = None,
                  series_complete: bool = False) -> DataFrame:
    """Per-series ffill, then a table-wide bfill in (part, order) order: a series with no value
    takes the first value of the next series that has one; an all-null last series stays null.

    ``edges_from``: a frame with the same first/last non-null value per series (e.g. the frame
    before interpolation, which only fills nulls and copies edge values). Summarising it instead
    of ``df`` keeps the window stage of ``df`` from being evaluated a second time.

    ``series_complete``: every series is either fully known or fully null in each column (true
    after ``interpolate_linear``), so the in-series legs are no-ops and only the cross-series
    carry is applied: no window pass at all."""
    part, order = _cols(part, order)
    block_rows = B.resolve(df, block_rows, part)
    edges = _series_edges(edges_from if edges_from is not None else df, cols, part, order, block_rows)
    if series_complete:
        j = B.join_null_safe(df, edges, part)
        return j.withColumns({c: F.coalesce(F.col(c), F.col(f"_next_{c}")) for c in cols}).select(*df.columns)
    d, ff, bf, _ = _legs(df, cols, part, order, block_rows)
    j = B.join_null_safe(d, edges, part)
    out = {c: F.coalesce(F.col(c), ff[c], bf[c], F.col(f"_next_{c}")) for c in cols}
    return j.withColumns(out).select(*df.columns)


#: series from which the neighbour search over their summary is itself distributed, and the summary rows of a slice then
MANY_SERIES, SLICE_SERIES = 200_000, 50_000


def fill_table_order(df: DataFrame, cols: Sequence[str], part="region", order="date",
                     scope: str = "table", block_rows: int | None = None) -> DataFrame:
    """Frame-wide ffill then bfill in (part, order) order (``scope='table'``, the platform's
    behaviour: warm-up rows of a series take the last value of the previous series), or
    per-series only (``scope='region'``).

    ``df`` is written once, so its own windows run once. One pass then tells which columns have nulls at all, a second one summarises
    those per series. A column whose nulls all come before its series' first value needs no window: the row takes the previous
    series' last value, else its own series' first. Only columns with gaps behind a known value get fill windows."""
    part, order = _cols(part, order)
    if scope == "region":
        return ffill_bfill(df, cols, part, order, B.resolve(df, block_rows, part))
    rows = written(df)
    have = rows.selectExpr("count(*) as `_all`", *[f"count(`{c}`) as `{c}`" for c in cols]).first()
    open_ = [c for c in cols if have[c] < have["_all"]]
    if not open_:
        return rows
    # as SQL text: one call a column instead of one a function, for some dozens of columns
    at = f"`{order[0]}`" if len(order) == 1 else f"struct({', '.join(f'`{o}`' for o in order)})"
    aggs = []
    for c in open_:
        known = f"case when `{c}` is not null then {at} end"
        aggs += [f"min_by(`{c}`, {known}) as `_first_{c}`", f"max_by(`{c}`, {known}) as `_last_{c}`",
                 f"max(case when `{c}` is null then {at} end) > min({known}) as `_gap_{c}`"]
    s = written(rows.groupBy(*part).agg(*[F.expr(x) for x in aggs]))
    told = s.selectExpr("count(*) as `_n`", *[f"max(`_gap_{c}`) as `{c}`" for c in open_]).first()
    gaps = [c for c in open_ if told[c]]
    edges = _neighbour_carries_distributed(s, open_, part, SLICE_SERIES) if told["_n"] >= MANY_SERIES else _neighbour_carries(s, open_, part)
    edges = B.join_null_safe(edges, s.select(*part, *[f"_first_{c}" for c in open_]), part)
    plain = [c for c in open_ if c not in gaps]
    j = B.join_null_safe(rows, edges, part)
    j = j.selectExpr(*[f"coalesce(`{c}`, `_prev_{c}`, `_first_{c}`, `_next_{c}`) as `{c}`" if c in plain else f"`{c}`" for c in df.columns],
                     *[f"`_{k}_{c}`" for c in gaps for k in ("prev", "next")])
    if gaps:
        j, ff, bf, _ = _legs(j, gaps, part, order, B.resolve(df, block_rows, part))
        j = j.withColumns({c: F.coalesce(F.col(c), ff[c], F.col(f"_prev_{c}"), bf[c], F.col(f"_next_{c}")) for c in gaps}).select(*df.columns)
    return j


def impute_mean(df: DataFrame, cols: Sequence[str], means: DataFrame | None = None) -> DataFrame:
    """Null -> column mean. ``means`` (one row, from a fitted frame) defaults to this frame's means.
    The mean row is a 1-row aggregate, so broadcasting it is size-safe."""
    if means is None:
        means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    else:
        means = means.select(*[F.col(c).alias(f"_mean_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(means))
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in cols}).select(*df.columns)


def fallback_weather(readings: DataFrame, norms: DataFrame, city_col: str = "city",
                     month_col: str = "month") -> DataFrame:
    """Missing measures -> seasonal-norm midpoints and fixed defaults (pressure 1013, wind 3, ...).
    ``norms`` is the fixed 72-row table (broadcast); unknown cities use the default city's norms."""
    from agrospark.dims import NORM_DEFAULT_CITY
    n = norms.select(F.col("city").alias("_nc"), F.col("month").alias("_nm"), "temp_min", "temp_max",
                     "hum_min", "hum_max")
    known = norms.select(F.col("city").alias("_kc")).distinct()
    r = readings.join(F.broadcast(known), F.col(city_col) == F.col("_kc"), "left")
    r = r.withColumn("_norm_city", F.coalesce(F.col("_kc"), F.lit(NORM_DEFAULT_CITY))).drop("_kc")
    j = r.join(F.broadcast(n), (F.col("_norm_city") == F.col("_nc")) & (F.col(month_col) == F.col("_nm")), "left")
    out = j.withColumns({
        "temperature": F.coalesce(F.col("temperature"), (F.col("temp_min") + F.col("temp_max")) / F.lit(2.0)),
        "humidity": F.coalesce(F.col("humidity"), (F.col("hum_min") + F.col("hum_max")) / F.lit(2.0)),
        "pressure": F.coalesce(F.col("pressure"), F.lit(1013.0)),
        "wind_speed": F.coalesce(F.col("wind_speed"), F.lit(3.0)),
    })
    return out.select(*readings.columns)


def regional_trend(meteo: DataFrame, cities: Sequence[str], end_date, days: int = 7,
                   city_col: str = "city", ts_col: str = "ts", value_cols=("precipitation", "temperature")) -> DataFrame:
    """Last ``days`` days x cities spine, left-joined with daily means of the facts (null where no data).

    The spine is days x cities rows (fixed by the parameters); the facts are pre-aggregated per
    (city, day) before the join, so the join input is bounded by the spine.
    """
    spark = meteo.sparkSession
    end = F.to_date(F.lit(str(end_date)))
    spine = spark.range(1).select(F.explode(F.sequence(F.date_sub(end, days - 1), end)).alias("day")) \
        .crossJoin(spark.createDataFrame([(c,) for c in cities], f"{city_col} string"))
    daily = meteo.filter(F.col(city_col).isin(list(cities))) \
        .withColumn("day", F.to_date(F.col(ts_col))) \
        .filter((F.col("day") >= F.date_sub(end, days - 1)) & (F.col("day") <= end)) \
        .groupBy(city_col, "day").agg(*[F.avg(c).alias(c) for c in value_cols])
    return spine.join(daily, [city_col, "day"], "left")


def fallback_forecast(cities: DataFrame, start, days: int = 7, city_col: str = "city") -> DataFrame:
    """Forecast stand-in per city and day from the seasonal norms (the platform drew noise around
    these; here each draw is replaced by its expected value): temperature and humidity = norm
    midpoints, pressure 1013, wind 3, precipitation = the month's mean, cloudiness 30.
    The spine is cities x ``days`` (parameter-bounded); norms are the fixed 72-row table."""
    from agrospark.dims import NORM_DEFAULT_CITY, dim
    spark = cities.sparkSession
    d0 = F.to_date(F.lit(str(start)))
    spine = cities.select(city_col).distinct().withColumn(
        "day", F.explode(F.sequence(d0, F.date_add(d0, days - 1))))
    norms = dim(spark, "seasonal_norms")
    known = [r for r in ("Dakar", "Thiès", "Saint-Louis", "Kaolack", "Ziguinchor", "Tambacounda")]
    key = F.when(F.col(city_col).isin(known), F.col(city_col)).otherwise(F.lit(NORM_DEFAULT_CITY))
    n = norms.select(F.col("city").alias("_nc"), F.col("month").alias("_nm"), "temp_min", "temp_max", "hum_min",
                     "hum_max", "precip_avg")
    j = spine.withColumns({"_k": key, "_m": F.month("day")}).join(
        F.broadcast(n), (F.col("_k") == F.col("_nc")) & (F.col("_m") == F.col("_nm")), "left")
    return j.select(city_col, "day",
                    ((F.col("temp_min") + F.col("temp_max")) / F.lit(2.0)).alias("temperature"),
                    ((F.col("hum_min") + F.col("hum_max")) / F.lit(2.0)).alias("humidity"),
                    F.lit(1013.0).alias("pressure"), F.lit(3.0).alias("wind_speed"),
                    F.col("precip_avg").alias("precipitation"), F.lit(30.0).alias("cloudiness"))
