"""DuckDB rendering of the feature frames and labels (oracle side), from the same column lists."""

from __future__ import annotations

from agrospark.dims import CROPS, values_sql
from agrospark.plans import features as FT
from agrospark.plans.panel_sql import fill_sql, panel_ctes
from agrospark.plans.sqlkit import snap

TWO_PI = "cast(6.283185307179586 as double)"
W = "partition by region order by date"


def D(x):
    return f"cast({x} as double)"


def strict(fn, col, n):
    fr = f"over ({W} rows between {n - 1} preceding and current row)"
    return f"case when count({col}) {fr} = {n} then {fn}({col}) {fr} end"


def month_cyc():
    return (f"sin({TWO_PI} * month / {D(12)}) as month_sin, cos({TWO_PI} * month / {D(12)}) as month_cos")


def crop_key():
    return "(cast(date_diff('day', DATE '1970-01-01', date) as bigint) * 31 + ascii(right(region, 1)))"


def crop_cols():
    arr = "[" + ", ".join(f"'{c}'" for c in CROPS) + "]"
    return (f"{arr}[({crop_key()} % {len(CROPS)}) + 1] as crop_type, "
            f"cast(1 + ({crop_key()} * 7) % 179 as integer) as growth_stage")


def onehot():
    return ", ".join(f"cast(crop_type = '{c}' as integer) as crop_{c}" for c in CROPS)


def es(t):
    return f"({D(0.6108)} * exp({D(17.27)} * {t} / ({t} + {D(237.3)})))"


def et0_sql(tmax, tmin, hum, wind, solar):
    tm = f"(({tmax} + {tmin}) / {D(2)})"
    delta = (f"({D(4098)} * ({D(0.6108)} * exp({D(17.27)} * {tm} / ({tm} + {D(237.3)}))) "
             f"/ pow({tm} + {D(237.3)}, {D(2)}))")
    gamma = f"({D(0.665)} * {D(101.3)})"
    e_s = f"(({es(tmax)} + {es(tmin)}) / {D(2)})"
    ea = f"({e_s} * {hum} / {D(100)})"
    rn = (f"({solar} * {D(0.77)} - {D(4.903e-9)} * (pow({tmax} + {D(273.16)}, {D(4)}) + pow({tmin} + {D(273.16)}, "
          f"{D(4)})) / {D(2)} * ({D(0.34)} - {D(0.14)} * sqrt({ea})))")
    num = (f"({D(0.408)} * {delta} * ({rn} - {D(0)}) + {gamma} * {D(900)} / ({tm} + {D(273)}) * {wind} "
           f"* ({e_s} - {ea}))")
    den = f"({delta} + {gamma} * ({D(1)} + {D(0.34)} * {wind}))"
    v = f"({num} / {den})"
    return f"case when not isnan({v}) and {v} > {D(0)} then {v} else {D(0)} end"


def kc_sql(stage, ki, km, ke, days):
    d = f"cast({days} as double)"
    s = f"cast({stage} as double)"
    p1 = f"(({s} - {d} * {D(0.25)}) / ({d} * {D(0.5)}))"
    p2 = f"(({s} - {d} * {D(0.75)}) / ({d} * {D(0.25)}))"
    return (f"case when {s} <= {d} * {D(0.25)} then {ki} when {s} <= {d} * {D(0.75)} then {ki} + {p1} * ({km} - {ki}) "
            f"else {km} + {p2} * ({ke} - {km}) end")


def finish(src, features, fill=True, ints=(), carry=()):
    """table-order fill of ``features`` over ``src`` then snap every double feature."""
    feat = f"select region, date, {', '.join(list(features) + list(carry))} from {src}"
    body = f"({fill_sql('feat_in', list(features), True)})" if fill else "feat_in"
    cols = ", ".join(c if c in ints else f"{snap(c)} as {c}" for c in features)
    return feat, body, cols


INT_FEATURES = {"is_dry_season", "is_wet_season", "consecutive_dry_days", "day_of_year", "growth_stage"} | {
    f"crop_{c}" for c in CROPS}


def frame_sql(chain: str, last: str, features, carry=()) -> str:
    feat, body, cols = finish(last, features, True, INT_FEATURES, carry)
    extra = "".join(f", {c}" for c in carry)
    return f"""{chain},
feat_in as ({feat}),
feat_out as (select * from {body} z)
select region, date, {cols}{extra} from feat_out"""


def rainfall_sql() -> str:
    chain = f"""{panel_ctes()},
r1 as (select *, {month_cyc()}, sin({TWO_PI} * day / {D(365)}) as day_sin, cos({TWO_PI} * day / {D(365)}) as day_cos,
    temp_day_celsius - temp_night_celsius as temp_range,
    sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m)
      as wind_speed,
    (ndvi + evi) / {D(2)} as vegetation_health,
    {', '.join(f"lag(total_precipitation_sum, {k}) over ({W}) as precipitation_lag_{k}" for k in (1, 3, 7))},
    {', '.join(f"{strict('avg', 'temperature_2m', w)} as temp_ma_{w}, {strict('avg', 'ssm', w)} as humidity_ma_{w}"
               for w in (3, 7, 15))}
  from panel)"""
    return frame_sql(chain, "r1", FT.RAINFALL_FEATURES)


def stats_sql(src="panel"):
    cols = ["temp_day_celsius", "ndvi", "temperature_2m", "total_precipitation_sum"]
    parts = [f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in cols] + ["max(ssm) as x_ssm"]
    return f"select {', '.join(parts)} from {src}"


def z(c):
    return f"(case when s_{c} <> 0 then ({c} - m_{c}) / s_{c} end)"


def drought_sql() -> str:
    mas = ", ".join(f"{strict('avg', c, w)} as {p}_ma_{w}" for w in FT.DW for p, c in
                    [("temp", "temperature_2m"), ("precip", "total_precipitation_sum"), ("ndvi", "ndvi"), ("ssm", "ssm")])
    cum = ", ".join(f"{strict('sum', 'total_precipitation_sum', p)} as precip_cumul_{p}" for p in (7, 15, 30, 60))
    dev = ", ".join(f"{c} - {p}_ma_{w} as {p}_deviation_{w}" for w in FT.DW for p, c in
                    [("temp", "temperature_2m"), ("precip", "total_precipitation_sum"), ("ndvi", "ndvi")])
    chain = f"""{panel_ctes()},
st as ({stats_sql()}),
d1 as (select panel.*, {month_cyc()}, cast(coalesce(season = 'Dry', false) as integer) as is_dry_season,
    {z('temp_day_celsius')} - {z('ndvi')} as water_stress_index,
    {z('temperature_2m')} - {z('total_precipitation_sum')} as meteorological_drought_index,
    ({D(1)} - ssm / x_ssm) * ({D(1)} - ndvi_normalized) as agricultural_drought_index,
    row_number() over ({W}) as _pos, coalesce(total_precipitation_sum < {D(0.1)}, false) as _dry
  from panel cross join st),
d2 as (select *, {mas}, {cum},
    max(case when not _dry then _pos end) over ({W} rows between unbounded preceding and current row) as _lastwet
  from d1),
d3 as (select *, {dev},
    cast(case when _dry then _pos - coalesce(_lastwet, 0) else 0 end as integer) as consecutive_dry_days from d2)"""
    return frame_sql(chain, "d3", FT.DROUGHT_FEATURES)


def irrigation_chain() -> str:
    mas = ", ".join(f"{strict('avg', c, w)} as {p}_ma_{w}" for w in FT.IW for p, c in
                    [("temp", "temperature_2m"), ("precip", "total_precipitation_sum"), ("ssm", "ssm"), ("et0", "et0")])
    cum = ", ".join(f"{strict('sum', 'total_precipitation_sum', p)} as precip_cumul_{p}" for p in FT.IW)
    et0 = et0_sql("temp_max", "temp_min", f"ssm * {D(100)}", "wind_speed",
                  f"surface_solar_radiation_downwards_sum / {D(1000000)}")
    eff = f"({D(1)} - (wind_speed / {D(10)} + temp_range / {D(20)}) / {D(2)})"
    return f"""{panel_ctes()},
i1 as (select *, temp_day_celsius as temp_max, temp_night_celsius as temp_min,
    temp_day_celsius - temp_night_celsius as temp_range,
    sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m)
      as wind_speed,
    cast(dayofyear(date) as integer) as day_of_year, {crop_cols()} from panel),
i2 as (select i1.*, {et0} as et0 from i1),
i3 as (select i2.*, et0 * ({kc_sql('growth_stage', 'kc_initial', 'kc_mid', 'kc_end', 'growing_days')}) as etc,
    {month_cyc()}, cast(coalesce(season = 'Dry', false) as integer) as is_dry_season,
    case when {D(0.4)} - ssm is not null then greatest({D(0)}, {D(0.4)} - ssm) end as soil_water_deficit,
    {D(1)} - ndvi_normalized as vegetation_stress,
    case when {eff} is not null then least(greatest({eff}, {D(0.3)}), {D(1)}) end as irrigation_efficiency
  from i2 left join {values_sql('crop_kc')}
    on (case when i2.crop_type in ({', '.join(repr(c) for c in CROPS)}) then i2.crop_type else 'mil' end)
       = crop_kc.crop),
i4 as (select *, {mas}, {cum}, {onehot()} from i3)"""


def irrigation_sql() -> str:
    return frame_sql(irrigation_chain(), "i4", FT.IRRIGATION_FEATURES)


def irrigation_need_sql() -> str:
    feat = f"select region, date, {', '.join(FT.IRRIGATION_FEATURES)}, total_precipitation_sum as _pp from i4"
    raw = f"(etc - _pp * {D(0.8)} + soil_water_deficit * {D(10)})"
    pos = f"(case when {raw} is not null then greatest({D(0)}, {raw}) end)"
    v = f"({pos} / irrigation_efficiency)"
    return f"""{irrigation_chain()},
feat_in as ({feat}),
feat_out as (select * from ({fill_sql('feat_in', list(FT.IRRIGATION_FEATURES), True)}) z)
select region, date, {snap('etc')} as etc, {snap('soil_water_deficit')} as soil_water_deficit,
  {snap('irrigation_efficiency')} as irrigation_efficiency,
  {snap(f"case when {v} is not null then least(greatest({v}, {D(0)}), {D(15)}) end")} as irrigation_need
from feat_out"""


def disease_sql() -> str:
    chain = f"""{panel_ctes()},
s1 as (select *, {month_cyc()}, cast(coalesce(season = 'Wet', false) as integer) as is_wet_season,
    cast(dayofyear(date) as integer) as day_of_year, {crop_cols()} from panel),
s2 as (select *, {onehot()} from s1)"""
    return frame_sql(chain, "s2", FT.DISEASE_FEATURES)
