"""Registered queries: windows, indices, labels and feature frames."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrospark.dims import values_sql
from agrospark.functions.numeric import snap
from agrospark.operators import indices as H
from agrospark.operators import stats as ST
from agrospark.operators import windows as G
from agrospark.plans import features as FT
from agrospark.plans import features_sql as FS
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_panel import panel
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap

W = "partition by region order by date"


def snapped(df, keep=()):
    """Snap every double column (report boundary), keep the rest."""
    return df.select(*[snap(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       and f.name not in keep else F.col(f.name) for f in df.schema.fields])


@register("rainfall_features", FS.rainfall_sql())
def q_rainfall_features(spark, sf):
    return snapped(FT.rainfall_features(panel(spark, sf)))


@register("drought_features", FS.drought_sql())
def q_drought_features(spark, sf):
    return snapped(FT.drought_features(panel(spark, sf)))


@register("irrigation_features", FS.irrigation_sql())
def q_irrigation_features(spark, sf):
    return snapped(FT.irrigation_features(panel(spark, sf)))


@register("disease_features", FS.disease_sql())
def q_disease_features(spark, sf):
    return snapped(FT.disease_features(panel(spark, sf)))


@register("irrigation_need", FS.irrigation_need_sql())
def q_irrigation_need(spark, sf):
    d = FT.irrigation_labelled(panel(spark, sf))
    return snapped(d.select("region", "date", "etc", "soil_water_deficit", "irrigation_efficiency", "irrigation_need"))


@register("precip_lags", f"""{panel_ctes()}
select region, date, {', '.join(f"lag(total_precipitation_sum, {k}) over ({W}) as precipitation_lag_{k}"
                                 for k in (1, 3, 7))} from panel""")
def q_precip_lags(spark, sf):
    return G.lags(panel(spark, sf), "total_precipitation_sum", (1, 3, 7)).select(
        "region", "date", "precipitation_lag_1", "precipitation_lag_3", "precipitation_lag_7")


@register("rain_target", f"""{panel_ctes()}
select region, date, coalesce(lead(total_precipitation_sum, 1) over ({W}), cast(0 as double)) as target from panel""")
def q_rain_target(spark, sf):
    return G.rain_target(panel(spark, sf)).select("region", "date", "target")


_MA = [("temp", "temperature_2m"), ("precip", "total_precipitation_sum"), ("ndvi", "ndvi"), ("ssm", "ssm")]


@register("moving_averages", f"""{panel_ctes()}
select region, date, {', '.join(f"{ssnap(FS.strict('avg', c, w))} as {p}_ma_{w}" for w in (3, 7, 15, 30)
                                 for p, c in _MA)} from panel""")
def q_moving_averages(spark, sf):
    d = G.moving_averages(panel(spark, sf), dict(_MA), (3, 7, 15, 30))
    return snapped(d.select("region", "date", *[f"{p}_ma_{w}" for w in (3, 7, 15, 30) for p, _ in _MA]))


@register("ma_deviation", f"""{panel_ctes()}, m as (select *, {', '.join(
    f"{FS.strict('avg', c, w)} as {p}_ma_{w}" for w in FT.DW for p, c in _MA[:3])} from panel)
select region, date, {', '.join(f"{ssnap(f'{c} - {p}_ma_{w}')} as {p}_deviation_{w}" for w in FT.DW
                                 for p, c in _MA[:3])} from m""")
def q_ma_deviation(spark, sf):
    spec = dict(_MA[:3])
    d = G.ma_deviation(G.moving_averages(panel(spark, sf), spec, FT.DW), spec, FT.DW)
    return snapped(d.select("region", "date", *[f"{p}_deviation_{w}" for w in FT.DW for p in spec]))


@register("precip_cumul", f"""{panel_ctes()}
select region, date, {', '.join(f"{ssnap(FS.strict('sum', 'total_precipitation_sum', p))} as precip_cumul_{p}"
                                 for p in (3, 7, 15, 30, 60))} from panel""")
def q_precip_cumul(spark, sf):
    d = G.rolling_sums(panel(spark, sf), "total_precipitation_sum", (3, 7, 15, 30, 60))
    return snapped(d.select("region", "date", *[f"precip_cumul_{p}" for p in (3, 7, 15, 30, 60)]))


@register("consecutive_dry_days", f"""{panel_ctes()},
a as (select region, date, row_number() over ({W}) as _pos,
        coalesce(total_precipitation_sum < cast(0.1 as double), false) as _dry from panel),
b as (select *, max(case when not _dry then _pos end) over ({W} rows between unbounded preceding and current row)
        as _lw from a)
select region, date, cast(case when _dry then _pos - coalesce(_lw, 0) else 0 end as integer) as consecutive_dry_days
from b""")
def q_consecutive_dry_days(spark, sf):
    return G.consecutive_dry_days(panel(spark, sf)).select("region", "date", "consecutive_dry_days")


_STATS_COLS = ["temp_day_celsius", "ndvi", "temperature_2m", "total_precipitation_sum", "ssm"]


@register("index_stats", f"""{panel_ctes()}
select {', '.join(f"{ssnap(f'avg({c})')} as {c}_mean, {ssnap(f'stddev_samp({c})')} as {c}_std, max({c}) as {c}_max"
                  for c in _STATS_COLS)} from panel""")
def q_index_stats(spark, sf):
    st = ST.index_stats(panel(spark, sf), _STATS_COLS)
    return st.select(*[snap(F.col(c)).alias(c) if not c.endswith("_max") else F.col(c) for c in st.columns])


_QSPEC = {"temperature_2m": [0.2, 0.4, 0.6, 0.7, 0.8], "ssm": [0.2, 0.7], "ndvi": [0.2],
          "total_precipitation_sum": [0.6], "surface_solar_radiation_downwards_sum": [0.4]}


@register("threshold_quantiles", f"""{panel_ctes()}
select {', '.join(f"{ssnap(f'quantile_cont({c}, {q})')} as {ST.qname(c, q)}" for c, qs in _QSPEC.items()
                  for q in qs)} from panel""")
def q_threshold_quantiles(spark, sf):
    q = ST.threshold_quantiles(panel(spark, sf), _QSPEC, method="rank")
    return snapped(q)


@register("drought_indices", f"""{panel_ctes()}, st as ({FS.stats_sql()})
select region, date,
  {ssnap(f"{FS.z('temp_day_celsius')} - {FS.z('ndvi')}")} as water_stress_index,
  {ssnap(f"{FS.z('temperature_2m')} - {FS.z('total_precipitation_sum')}")} as meteorological_drought_index,
  {ssnap("(cast(1 as double) - ssm / x_ssm) * (cast(1 as double) - ndvi_normalized)")} as agricultural_drought_index
from panel cross join st""")
def q_drought_indices(spark, sf):
    d = H.drought_indices(panel(spark, sf))
    return snapped(d.select("region", "date", "water_stress_index", "meteorological_drought_index",
                            "agricultural_drought_index"))


def _drought_label_sql():
    D = FS.D
    return f"""{panel_ctes()},
d as (select *, {ssnap(FS.strict('sum', 'total_precipitation_sum', 30), 9)} as precip_sum_30 from panel),
q as (select quantile_cont(precip_sum_30, 0.2) as qa, quantile_cont(temperature_2m, 0.8) as qb,
        quantile_cont(ssm, 0.2) as qc, quantile_cont(ndvi, 0.2) as qd from d),
s as (select d.*, (case when coalesce(precip_sum_30 < qa, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(temperature_2m > qb, false) then {D(0.2)} else {D(0)} end)
    + (case when coalesce(ssm < qc, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(ndvi < qd, false) then {D(0.2)} else {D(0)} end) as drought_score from d cross join q),
labelled as (select *, case when drought_score <= {D(0.2)} then 0 when drought_score <= {D(0.4)} then 1
    when drought_score <= {D(0.6)} then 2 else 3 end as drought_class from s)"""


def _labelled(spark, sf):
    return H.drought_label(panel(spark, sf))


@register("drought_label", f"""{_drought_label_sql()}
select region, season, drought_class, count(*) as n_days, {ssnap('avg(drought_score)')} as mean_score
from labelled group by region, season, drought_class""")
def q_drought_label(spark, sf):
    """Flagship: drought class counts per region and season (full labelled panel aggregated)."""
    d = _labelled(spark, sf)
    return d.groupBy("region", "season", "drought_class").agg(
        F.count(F.lit(1)).alias("n_days"), snap(F.avg("drought_score")).alias("mean_score"))


@register("drought_label_rows", f"""{_drought_label_sql()}
select region, date, season, {ssnap('precip_sum_30')} as precip_sum_30, drought_score, drought_class from labelled""")
def q_drought_label_rows(spark, sf):
    d = _labelled(spark, sf)
    return d.select("region", "date", "season", snap(F.col("precip_sum_30")).alias("precip_sum_30"),
                    "drought_score", "drought_class")


@register("disease_label", f"""{panel_ctes()},
q as (select quantile_cont(ssm, 0.7) as qa, quantile_cont(total_precipitation_sum, 0.6) as qb,
        quantile_cont(surface_solar_radiation_downwards_sum, 0.4) as qc from panel),
s as (select panel.*, (case when coalesce(ssm > qa, false) then {FS.D(0.4)} else {FS.D(0)} end)
    + (case when coalesce(temperature_2m between 20 and 32, false) then {FS.D(0.3)} else {FS.D(0)} end)
    + (case when coalesce(total_precipitation_sum > qb, false) then {FS.D(0.2)} else {FS.D(0)} end)
    + (case when coalesce(surface_solar_radiation_downwards_sum < qc, false) then {FS.D(0.1)} else {FS.D(0)} end)
    as disease_score from panel cross join q)
select region, date, disease_score, case when disease_score <= {FS.D(0.3)} then 0 when disease_score <= {FS.D(0.6)}
  then 1 when disease_score <= {FS.D(0.8)} then 2 else 3 end as disease_class from s""")
def q_disease_label(spark, sf):
    return H.disease_label(panel(spark, sf), stored=True).select("region", "date", "disease_score", "disease_class")


@register("et0", f"""{panel_ctes()}
select region, date, {ssnap(FS.et0_sql('temp_day_celsius', 'temp_night_celsius', 'ssm * cast(100 as double)',
    'sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m)',
    'surface_solar_radiation_downwards_sum / cast(1000000 as double)'))} as et0 from panel""")
def q_et0(spark, sf):
    d = FT.irrigation_base(panel(spark, sf))
    return snapped(d.select("region", "date", "et0"))


@register("crop_et", f"""{FS.irrigation_chain()}
select region, date, crop_type, growth_stage, {ssnap('etc')} as etc from i3""")
def q_crop_et(spark, sf):
    return snapped(FT.irrigation_base(panel(spark, sf)).select("region", "date", "crop_type", "growth_stage", "etc"))


@register("assign_crop", f"""{panel_ctes()} select region, date, {FS.crop_cols()} from panel""")
def q_assign_crop(spark, sf):
    return H.assign_crop(panel(spark, sf).select("region", "date"))


@register("crop_onehot", f"""{panel_ctes()}, c as (select region, date, {FS.crop_cols()} from panel)
select region, date, crop_type, {FS.onehot()} from c""")
def q_crop_onehot(spark, sf):
    d = H.crop_onehot(H.assign_crop(panel(spark, sf).select("region", "date")))
    return d.drop("growth_stage")


@register("water_features", f"""{FS.irrigation_chain()}
select region, date, {ssnap('soil_water_deficit')} as soil_water_deficit, {ssnap('vegetation_stress')}
  as vegetation_stress, {ssnap('irrigation_efficiency')} as irrigation_efficiency from i3""")
def q_water_features(spark, sf):
    d = FT.irrigation_base(panel(spark, sf))
    return snapped(d.select("region", "date", "soil_water_deficit", "vegetation_stress", "irrigation_efficiency"))


@register("growth_stage", f"""{panel_ctes()}, c as (select region, date, {FS.crop_cols()} from panel)
select c.region, c.date, c.crop_type, cast(least(180, greatest(1, (case when month(c.date) >= planting_month
    then month(c.date) - planting_month else 12 - planting_month + month(c.date) end) * 30 + day(c.date))) as integer)
    as growth_stage
from c left join {values_sql('crop_calendar')}
  on c.crop_type = crop_calendar.crop""")
def q_growth_stage(spark, sf):
    d = H.assign_crop(panel(spark, sf).select("region", "date")).drop("growth_stage")
    return H.growth_stage(d)


# ----------------------------------------------------------------------------- skew-proof (blocked) variants
# Same results as the per-region windows above, evaluated per block of consecutive rows so a hot
# region is spread over many tasks. The block size here is small so that every region of the
# test data spans several blocks (halo copies and carries are exercised); production sizes are
# 1e5-1e6 rows per block.
from agrospark.plans.registry import ORACLE  # noqa: E402
from agrospark.operators import fill as _fill  # noqa: E402

BLOCK = 256


@register("moving_averages_blocked", ORACLE["moving_averages"])
def q_moving_averages_blocked(spark, sf):
    d = G.moving_averages(panel(spark, sf), dict(_MA), (3, 7, 15, 30), block_rows=BLOCK)
    return snapped(d.select("region", "date", *[f"{p}_ma_{w}" for w in (3, 7, 15, 30) for p, _ in _MA]))


@register("precip_cumul_blocked", ORACLE["precip_cumul"])
def q_precip_cumul_blocked(spark, sf):
    d = G.rolling_sums(panel(spark, sf), "total_precipitation_sum", (3, 7, 15, 30, 60), block_rows=BLOCK)
    return snapped(d.select("region", "date", *[f"precip_cumul_{p}" for p in (3, 7, 15, 30, 60)]))


@register("precip_lags_blocked", ORACLE["precip_lags"])
def q_precip_lags_blocked(spark, sf):
    return G.lags(panel(spark, sf), "total_precipitation_sum", (1, 3, 7), block_rows=BLOCK).select(
        "region", "date", "precipitation_lag_1", "precipitation_lag_3", "precipitation_lag_7")


@register("rain_target_blocked", ORACLE["rain_target"])
def q_rain_target_blocked(spark, sf):
    return G.rain_target(panel(spark, sf), block_rows=BLOCK).select("region", "date", "target")


@register("consecutive_dry_days_blocked", ORACLE["consecutive_dry_days"])
def q_consecutive_dry_days_blocked(spark, sf):
    return G.consecutive_dry_days(panel(spark, sf), block_rows=BLOCK).select("region", "date",
                                                                             "consecutive_dry_days")


@register("interpolate_linear_blocked", ORACLE["interpolate_linear"])
def q_interpolate_linear_blocked(spark, sf):
    from agrospark.plans.q_panel import NUM, _keyed
    return _fill.interpolate_linear(_keyed(spark, sf), NUM, "region", "date", block_rows=BLOCK)


@register("build_panel_blocked", ORACLE["build_panel"])
def q_build_panel_blocked(spark, sf):
    """The whole ETL with the skew-proof evaluation (dedup per (region, date), blocked windows)."""
    from agrospark.plans import panel as P
    from agrospark.sources import adapters as A
    return P.build_panel(A.obs(spark, sf), block_rows=BLOCK)


@register("drought_features_blocked", ORACLE["drought_features"])
def q_drought_features_blocked(spark, sf):
    return snapped(FT.drought_features(panel(spark, sf), block_rows=BLOCK))


@register("irrigation_features_blocked", ORACLE["irrigation_features"])
def q_irrigation_features_blocked(spark, sf):
    return snapped(FT.irrigation_features(panel(spark, sf), block_rows=BLOCK))


@register("drought_label_blocked", ORACLE["drought_label"])
def q_drought_label_blocked(spark, sf):
    d = H.drought_label(panel(spark, sf), block_rows=BLOCK)
    return d.groupBy("region", "season", "drought_class").agg(
        F.count(F.lit(1)).alias("n_days"), snap(F.avg("drought_score")).alias("mean_score"))
