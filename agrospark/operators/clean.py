"""Projection, coercion, cleaning and dedup operators (DataFrame -> DataFrame).

All are narrow (no shuffle) except ``dedup_exact`` (one hash shuffle on all columns, map-side
combined) and ``merge_sources``/``dedup_key`` (aggregations with partial aggregation, so a hot
(region, date) key is pre-combined on every mapper before it is shuffled).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrospark.functions.calendar import cyclic, season2 as _season2, season4 as _season4
from agrospark.functions.numeric import nan_to_null

PANEL_NUMERIC = [
    "surface_solar_radiation_downwards_sum", "temperature_2m",
    "total_precipitation_sum", "u_component_of_wind_10m", "v_component_of_wind_10m",
    "precipitation", "lst_day_1km", "lst_night_1km",
    "temp_day_celsius", "temp_night_celsius",
    "evi", "ndvi", "ndvi_normalized", "evi_normalized",
    "ssm", "latitude", "longitude",
]

PANEL_COLUMNS = [
    "region", "latitude", "longitude", "date",
    "year", "month", "day", "season",
    "surface_solar_radiation_downwards_sum", "temperature_2m",
    "total_precipitation_sum", "u_component_of_wind_10m", "v_component_of_wind_10m",
    "precipitation", "lst_day_1km", "lst_night_1km",
    "temp_day_celsius", "temp_night_celsius",
    "evi", "ndvi", "ndvi_normalized", "evi_normalized",
    "ssm", "data_source",
]

METEO_NUMERIC = ["temperature", "humidite", "pression", "vent", "pluie"]


# ----------------------------------------------------------------------------- B1-B3, B21, B22

def normalize_names(df: DataFrame, space: str = "_") -> DataFrame:
    """strip + lower (+ space -> '_'); metadata only."""
    return df.toDF(*[c.strip().lower().replace(" ", space) for c in df.columns])


def _to_double(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        v = F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)")
    else:
        v = F.col(c).cast("double")
    return nan_to_null(v)


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``pd.to_numeric(errors='coerce')``: unparsable -> null, NaN -> null; absent columns ignored."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    repl = {c: _to_double(c, types[c]) for c in cols if c in types}
    return df.withColumns(repl) if repl else df


def coerce_date(df: DataFrame, col: str = "date") -> DataFrame:
    """Unparsable dates -> null (``errors='coerce'``)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return df.withColumn(col, F.expr(f"try_cast(`{col}` AS DATE)"))
    return df.withColumn(col, F.to_date(F.col(col)))


def trim_strings(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast to string and strip. Nulls stay null (the platform turned them into the text 'nan')."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.trim(F.col(c).cast("string")) for c in present}) if present else df


def project_known(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select the wanted columns, in wanted order, skipping absent ones."""
    return df.select(*[c for c in wanted if c in df.columns])


# ----------------------------------------------------------------------------- B4-B10

def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def plausible_range(df: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Inclusive range filter, null-rejecting (a null value fails ``between``)."""
    bounds = bounds or {"humidite": (0.0, 100.0), "temperature": (-80.0, 60.0)}
    cond = None
    for c, (lo, hi) in bounds.items():
        k = F.col(c).between(F.lit(float(lo)), F.lit(float(hi)))
        cond = k if cond is None else cond & k
    return df.filter(cond)


def kelvin_to_celsius(df: DataFrame, cols=("temperature_2m", "lst_day_1km", "lst_night_1km"),
                      above: float = 200.0) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(F.col(c) > F.lit(above), F.col(c) - F.lit(273.15)).otherwise(F.col(c))
                           for c in present}) if present else df


def scale_bands(df: DataFrame, lst_scale: float = 1.0, vi_scale: float = 10000.0) -> DataFrame:
    """Derived satellite bands: LST -> degC (raw value, scale factor 1 by default) and VI / 10000."""
    out = {}
    if "lst_day_1km" in df.columns:
        out["temp_day_celsius"] = F.col("lst_day_1km") * F.lit(lst_scale) - F.lit(273.15) if lst_scale != 1.0 \
            else F.col("lst_day_1km") - F.lit(273.15)
    if "lst_night_1km" in df.columns:
        out["temp_night_celsius"] = F.col("lst_night_1km") * F.lit(lst_scale) - F.lit(273.15) if lst_scale != 1.0 \
            else F.col("lst_night_1km") - F.lit(273.15)
    if "ndvi" in df.columns:
        out["ndvi_normalized"] = F.col("ndvi") / F.lit(vi_scale)
    if "evi" in df.columns:
        out["evi_normalized"] = F.col("evi") / F.lit(vi_scale)
    return df.withColumns(out) if out else df


def repair_ssm(df: DataFrame, col: str = "ssm") -> DataFrame:
    """Soil moisture: < 0 -> null, then > 1 -> /100 (applied once)."""
    if col not in df.columns:
        return df
    s = F.col(col)
    return df.withColumn(col, F.when(s < 0, F.lit(None).cast("double")).when(s > 1, s / F.lit(100.0)).otherwise(s))


def calendar_parts(df: DataFrame, date_col: str = "date", doy: bool = False) -> DataFrame:
    d = F.col(date_col)
    out = {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}
    if doy:
        out["day_of_year"] = F.dayofyear(d)
    return df.withColumns(out)


def season4(df: DataFrame, month_col: str = "month", out: str = "season") -> DataFrame:
    return df.withColumn(out, _season4(F.col(month_col)))


def season2(df: DataFrame, month_col: str = "month", wet_months=(6, 7, 8, 9, 10), out: str = "season2") -> DataFrame:
    return df.withColumn(out, _season2(F.col(month_col), wet_months))


def season_flags(df: DataFrame, season_col: str = "season") -> DataFrame:
    """is_dry_season = (season == 'Dry'); is_wet_season = (season == 'Wet') (never true on the 4-season panel)."""
    s = F.col(season_col)
    return df.withColumns({
        "is_dry_season": F.coalesce(s == F.lit("Dry"), F.lit(False)).cast("int"),
        "is_wet_season": F.coalesce(s == F.lit("Wet"), F.lit(False)).cast("int"),
    })


def cyclic_time(df: DataFrame, month_col: str = "month", day_col: str = "day", day_basis: str = "month") -> DataFrame:
    """month/12 and day/365 encodings; day_basis='month' uses day-of-month (training), 'year' day-of-year (scoring)."""
    ms, mc = cyclic(F.col(month_col), 12)
    dcol = F.col(day_col) if day_basis == "month" else F.dayofyear(F.col("date"))
    ds, dc = cyclic(dcol, 365)
    return df.withColumns({"month_sin": ms, "month_cos": mc, "day_sin": ds, "day_cos": dc})


def derived_features(df: DataFrame) -> DataFrame:
    """temp_range, wind_speed = sqrt(u^2 + v^2), vegetation_health = (ndvi + evi) / 2."""
    u, v = F.col("u_component_of_wind_10m"), F.col("v_component_of_wind_10m")
    return df.withColumns({
        "temp_range": F.col("temp_day_celsius") - F.col("temp_night_celsius"),
        "wind_speed": F.sqrt(u * u + v * v),
        "vegetation_health": (F.col("ndvi") + F.col("evi")) / F.lit(2.0),
    })


# ----------------------------------------------------------------------------- A5

def valid_locations(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Skip locations whose lat or lon is missing or 0 (Python truthiness)."""
    return df.filter((F.col(lat) != 0) & (F.col(lon) != 0))


# ----------------------------------------------------------------------------- C1-C3

def dedup_exact(df: DataFrame) -> DataFrame:
    """Exact full-row dedup (nulls compare equal)."""
    return df.dropDuplicates()


def merge_sources(df: DataFrame, keys=("region", "date", "latitude", "longitude"),
                  order: Sequence[str] = ("source_rank",), cols: Sequence[str] | None = None) -> DataFrame:
    """Coalescing merge: per key, each column takes its first non-null value in ``order``.

    One aggregation (hash on the keys, partial aggregation on the map side, so a hot key is
    combined before the shuffle). Rows with a null key are dropped, as pandas' groupby does.
    ``order`` must be a total order inside a key for the result to be deterministic.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys and c not in order]
    aggs = []
    for c in cols:
        # order, then the value itself: a total order even when order columns repeat.
        # min_by ignores rows whose ordering is null: null the ordering where the value is null.
        ordk = F.struct(*[F.col(o) for o in order], F.col(c).alias("_v"))
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordk)).alias(c))
    nn = None
    for k in keys:
        nn = F.col(k).isNotNull() if nn is None else nn & F.col(k).isNotNull()
    return df.filter(nn).groupBy(*keys).agg(*aggs)


def merge_by_rank(df: DataFrame, keys=("region", "date", "latitude", "longitude"), rank: str = "source_rank",
                  cols: Sequence[str] | None = None, labels: Sequence[str] | None = None,
                  label_col: str = "data_source") -> DataFrame:
    """Coalescing merge by source priority, as two hash aggregations with fixed-width buffers:

    1. per (key, rank): the smallest value of each column (the deterministic tie-break among
       duplicate rows of one source), combined map-side, so a hot key is reduced before the shuffle;
    2. per key: each column from its highest-priority (smallest rank) source that has a value;
       ``label_col`` = ``labels[min rank present]`` (the source of the first row in priority order).

    Rows with a null key are dropped (pandas' groupby default). Same answer as ``merge_sources``
    ordered by (rank, value); no sort-based aggregation on the raw input.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys and c != rank and c != label_col]
    nn = None
    for k in keys:
        nn = F.col(k).isNotNull() if nn is None else nn & F.col(k).isNotNull()
    per_rank = df.filter(nn).groupBy(*keys, rank).agg(*[F.min(c).alias(c) for c in cols])
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(rank))).alias(c) for c in cols]
    if labels is not None:
        aggs.append(F.min(rank).alias("_min_rank"))
    out = per_rank.groupBy(*keys).agg(*aggs)
    if labels is not None:
        out = out.withColumn(label_col, F.element_at(F.array(*[F.lit(x) for x in labels]),
                                                     F.col("_min_rank").cast("int"))).drop("_min_rank")
    return out


def dedup_first_in_series(df: DataFrame, series: str = "region", key: str = "date",
                          order=("latitude", "longitude"), by_key: bool = False) -> DataFrame:
    """One row per (series, key): the smallest ``order``. Evaluated inside the series partitioning
    (a window ordered by key then ``order``; the first row of each key is kept), so it shares the
    exchange and the sort of the per-series windows that follow instead of adding a shuffle.
    ``by_key``: partition by (series, key) instead - groups of a few locations, so a hot series is
    spread over many tasks (used with blocked windows, which re-partition anyway)."""
    w = Window.partitionBy(series, key).orderBy(*order) if by_key else Window.partitionBy(series).orderBy(key, *order)
    prev = F.lag(F.col(key)).over(w)
    return df.withColumn("_prev_key", prev).filter(F.col("_prev_key").isNull() | (F.col("_prev_key") != F.col(key))) \
        .drop("_prev_key")


def dedup_key(df: DataFrame, keys=("region", "date"), order=("latitude", "longitude")) -> DataFrame:
    """Keep one row per key: the smallest ``order`` (a second aggregation, map-side combined)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_r")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_r." + c).alias(c) for c in rest])


# ----------------------------------------------------------------------------- C4, C5, A13

def clean_weather(df: DataFrame) -> DataFrame:
    """C1 -> B4 -> B2 -> B5, in this order (coercion runs after the null drop)."""
    df = dedup_exact(df)
    df = drop_incomplete(df, ["date", "temperature", "humidite"])
    df = coerce_numeric(df, METEO_NUMERIC)
    return plausible_range(df)


FAO_COLUMNS = ["element", "item", "year", "unit", "value", "source"]


def clean_fao(df: DataFrame) -> DataFrame:
    """names -> projection -> value numeric -> drop null value -> year int -> drop null year -> trim strings."""
    df = normalize_names(df)
    df = project_known(df, FAO_COLUMNS)
    df = coerce_numeric(df, ["value"])
    df = df.filter(F.col("value").isNotNull())
    y = F.expr("try_cast(trim(cast(`year` AS STRING)) AS DOUBLE)")
    # integral years only (a fractional year raised there; ours becomes null and is dropped)
    df = df.withColumn("year", F.when(y == F.floor(y), y.cast("int")))
    df = df.filter(F.col("year").isNotNull())
    return trim_strings(df, ["element", "item", "unit", "source"])


def conform_fao(df: DataFrame, required=("element", "item", "year", "unit", "value")) -> DataFrame:
    """Load-time conform: lower/strip names, required-column check, truncation, year int, value double."""
    df = normalize_names(df, space=" ")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    out = df.withColumns({
        "element": F.substring(F.col("element").cast("string"), 1, 255),
        "item": F.substring(F.col("item").cast("string"), 1, 255),
        "unit": F.substring(F.col("unit").cast("string"), 1, 50),
        "year": F.expr("try_cast(try_cast(cast(`year` AS STRING) AS DOUBLE) AS INT)"),
        "value": F.expr("try_cast(cast(`value` AS STRING) AS DOUBLE)"),
    })
    if "source" in out.columns:
        out = out.withColumn("source", F.substring(F.col("source").cast("string"), 1, 100))
    return out
