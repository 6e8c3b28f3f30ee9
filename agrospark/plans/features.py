"""Feature frames I1-I4 over the clean panel, plus the labelled frames used for training.

Each frame is one plan: per-region windows (one Exchange on region, shared sorts), global
statistics as a broadcast one-row frame, then the table-order fill. Feature lists keep the
platform's column order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.dims import CROPS
from agrospark.functions.calendar import cyclic
from agrospark.operators import blocked as B
from agrospark.operators import clean as C
from agrospark.operators import fill as D
from agrospark.operators import indices as H
from agrospark.operators import windows as G

KEYS = ["region", "date"]

RAIN_WEATHER = ["temperature_2m", "total_precipitation_sum", "u_component_of_wind_10m",
                "v_component_of_wind_10m", "surface_solar_radiation_downwards_sum"]
SATELLITE9 = ["lst_day_1km", "lst_night_1km", "temp_day_celsius", "temp_night_celsius",
              "evi", "ndvi", "ndvi_normalized", "evi_normalized", "ssm"]
RAINFALL_FEATURES = (RAIN_WEATHER + SATELLITE9
                     + ["month_sin", "month_cos", "day_sin", "day_cos", "temp_range", "wind_speed", "vegetation_health"]
                     + [f"precipitation_lag_{k}" for k in (1, 3, 7)]
                     + [f"temp_ma_{w}" for w in (3, 7, 15)]
                     + [f"humidity_ma_{w}" for w in (3, 7, 15)])

DROUGHT_BASE = ["temperature_2m", "total_precipitation_sum", "surface_solar_radiation_downwards_sum",
                "lst_day_1km", "lst_night_1km", "temp_day_celsius", "temp_night_celsius",
                "evi", "ndvi", "ndvi_normalized", "evi_normalized", "ssm"]
DW = (7, 15, 30)
DROUGHT_FEATURES = (DROUGHT_BASE
                    + ["month_sin", "month_cos", "is_dry_season", "water_stress_index",
                       "meteorological_drought_index", "agricultural_drought_index", "consecutive_dry_days"]
                    + [f"temp_ma_{w}" for w in DW] + [f"precip_ma_{w}" for w in DW]
                    + [f"ndvi_ma_{w}" for w in DW] + [f"ssm_ma_{w}" for w in DW]
                    + [f"temp_deviation_{w}" for w in DW] + [f"precip_deviation_{w}" for w in DW]
                    + [f"ndvi_deviation_{w}" for w in DW]
                    + [f"precip_cumul_{p}" for p in (7, 15, 30, 60)])

IRR_WEATHER = ["temperature_2m", "total_precipitation_sum", "surface_solar_radiation_downwards_sum",
               "u_component_of_wind_10m", "v_component_of_wind_10m", "ssm"]
SATELLITE8 = ["lst_day_1km", "lst_night_1km", "temp_day_celsius", "temp_night_celsius",
              "evi", "ndvi", "ndvi_normalized", "evi_normalized"]
IW = (3, 7, 15)
IRRIGATION_FEATURES = (IRR_WEATHER + SATELLITE8
                       + ["temp_max", "temp_min", "temp_range", "wind_speed", "et0", "etc",
                          "month_sin", "month_cos", "is_dry_season", "day_of_year",
                          "soil_water_deficit", "vegetation_stress", "irrigation_efficiency", "growth_stage"]
                       + [f"temp_ma_{w}" for w in IW] + [f"precip_ma_{w}" for w in IW]
                       + [f"ssm_ma_{w}" for w in IW] + [f"et0_ma_{w}" for w in IW]
                       + [f"precip_cumul_{p}" for p in IW]
                       + [f"crop_{c}" for c in CROPS])

DISEASE_FEATURES = (IRR_WEATHER + SATELLITE8
                    + ["month_sin", "month_cos", "is_wet_season", "day_of_year"]
                    + [f"crop_{c}" for c in CROPS])


def _month_cyc(df: DataFrame) -> DataFrame:
    s, c = cyclic(F.col("month"), 12)
    return df.withColumns({"month_sin": s, "month_cos": c})


def _positions(df: DataFrame, block_rows: int) -> DataFrame:
    """Blocked evaluation: row positions once per frame, shared by every operator."""
    return B.ensure_positions(df, "region", "date") if block_rows else df


def _finish(df: DataFrame, features, fill: str | None = "table", carry=(), block_rows=None) -> DataFrame:
    pos = ["_pos"] if "_pos" in df.columns else []
    out = df.select(*KEYS, *features, *carry, *pos)
    res = D.fill_table_order(out, list(features), "region", "date", scope=fill, block_rows=block_rows) \
        if fill else out
    return res.drop(*pos)


def rainfall_features(panel: DataFrame, fill: str | None = "table", block_rows: int | None = None, carry=()) -> DataFrame:
    block_rows = B.resolve(panel, block_rows)
    f = C.cyclic_time(_positions(panel, block_rows), day_basis="month")
    f = C.derived_features(f)
    f = G.lags(f, "total_precipitation_sum", (1, 3, 7), "precipitation_lag", block_rows=block_rows)
    f = G.moving_averages(f, {"temp": "temperature_2m", "humidity": "ssm"}, (3, 7, 15), block_rows=block_rows)
    return _finish(f, RAINFALL_FEATURES, fill, carry, block_rows=block_rows)


def drought_features(panel: DataFrame, fill: str | None = "table", block_rows: int | None = None, carry=()) -> DataFrame:
    block_rows = B.resolve(panel, block_rows)
    f = _month_cyc(_positions(panel, block_rows))
    f = C.season_flags(f)
    f = H.drought_indices(f)
    f = G.moving_averages(f, {"temp": "temperature_2m", "precip": "total_precipitation_sum", "ndvi": "ndvi",
                              "ssm": "ssm"}, DW, block_rows=block_rows)
    f = G.ma_deviation(f, {"temp": "temperature_2m", "precip": "total_precipitation_sum", "ndvi": "ndvi"}, DW)
    f = G.rolling_sums(f, "total_precipitation_sum", (7, 15, 30, 60), "precip_cumul", block_rows=block_rows)
    f = G.consecutive_dry_days(f, "total_precipitation_sum", 0.1, block_rows=block_rows)
    return _finish(f, DROUGHT_FEATURES, fill, carry, block_rows=block_rows)


def irrigation_base(panel: DataFrame) -> DataFrame:
    """Irrigation columns before windows: temperatures, wind, ET0, crop and stage, ETc, water terms."""
    f = panel.withColumns({"temp_max": F.col("temp_day_celsius"), "temp_min": F.col("temp_night_celsius")})
    u, v = F.col("u_component_of_wind_10m"), F.col("v_component_of_wind_10m")
    f = f.withColumns({"temp_range": F.col("temp_max") - F.col("temp_min"), "wind_speed": F.sqrt(u * u + v * v),
                       "day_of_year": F.dayofyear("date")})
    f = H.et0(f)
    f = H.assign_crop(f)
    f = H.crop_et(f)
    f = _month_cyc(f)
    f = C.season_flags(f)
    return H.water_features(f)


def irrigation_features(panel: DataFrame, fill: str | None = "table", carry=(),
                        block_rows: int | None = None) -> DataFrame:
    block_rows = B.resolve(panel, block_rows)
    f = irrigation_base(_positions(panel, block_rows))
    f = f.withColumns({alias: F.col(src) for alias, src in carry})
    f = G.moving_averages(f, {"temp": "temperature_2m", "precip": "total_precipitation_sum", "ssm": "ssm",
                              "et0": "et0"}, IW, block_rows=block_rows)
    f = G.rolling_sums(f, "total_precipitation_sum", IW, "precip_cumul", block_rows=block_rows)
    f = H.crop_onehot(f)
    return _finish(f, IRRIGATION_FEATURES, fill, [alias for alias, _ in carry], block_rows=block_rows)


def disease_features(panel: DataFrame, fill: str | None = "table", block_rows: int | None = None, carry=()) -> DataFrame:
    block_rows = B.resolve(panel, block_rows)
    f = _month_cyc(panel)
    f = C.season_flags(f)
    f = f.withColumn("day_of_year", F.dayofyear("date"))
    f = H.assign_crop(f)
    f = H.crop_onehot(f)
    return _finish(f, DISEASE_FEATURES, fill, carry, block_rows=block_rows)


def irrigation_labelled(panel: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Features (after the table-order fill) + need; the need's rainfall term is the panel's."""
    feats = irrigation_features(panel, carry=[("_panel_precip", "total_precipitation_sum")], block_rows=block_rows)
    return H.irrigation_need(feats, "_panel_precip").drop("_panel_precip")
