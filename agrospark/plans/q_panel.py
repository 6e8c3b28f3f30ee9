"""Registered queries: merge, dedup, gap filling and the panel build."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrospark.operators import clean as C
from agrospark.operators import fill as D
from agrospark.plans import panel as P
from agrospark.plans import panel_sql as S
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.sources import adapters as A

NUM = C.PANEL_NUMERIC


def _keyed(spark, sf):
    return P.merge_stage(A.obs(spark, sf))


def panel(spark, sf):
    """The clean panel as downstream jobs read it: written once per session and input as a
    table bucketed by region (see ``agrospark.plans.panel.materialize``)."""
    return P.materialize(spark, sf, lambda: P.build_panel(A.obs(spark, sf)), sized=A.obs(spark, sf))


_MERGED = S.merged_sql()
_KEYED = f"with merged as ({_MERGED}), keyed as ({S.dedup_sql('merged')})"


@register("merge_by_rank", _MERGED)
def q_merge_by_rank(spark, sf):
    obs = A.obs(spark, sf)
    return C.merge_by_rank(obs, P.MERGE_KEYS, "source_rank", [c for c in C.PANEL_NUMERIC if c not in P.MERGE_KEYS],
                           A.SOURCES, "data_source")


@register("merge_sources", S.merged_ordered_sql())
def q_merge_sources(spark, sf):
    obs = A.obs(spark, sf)
    vals = [c for c in obs.columns if c not in P.MERGE_KEYS and c not in A.OBS_ORDER]
    return C.merge_sources(obs, P.MERGE_KEYS, A.OBS_ORDER, vals)


@register("dedup_key", f"{_KEYED} select * from keyed")
def q_dedup_key(spark, sf):
    """The key dedup operator itself, over the merged rows."""
    obs = A.obs(spark, sf)
    merged = C.merge_by_rank(obs, P.MERGE_KEYS, "source_rank", [c for c in C.PANEL_NUMERIC if c not in P.MERGE_KEYS], A.SOURCES, "data_source")
    return C.dedup_key(merged, ("region", "date"), ("latitude", "longitude")).select(*_keyed(spark, sf).columns)


@register("interpolate_linear", f"{_KEYED}, i as ({S._interp_select('keyed', NUM)}) select * from i")
def q_interpolate_linear(spark, sf):
    return D.interpolate_linear(_keyed(spark, sf), NUM, "region", "date")


@register("fallback_fill", f"""{_KEYED}, i as ({S._interp_select('keyed', NUM)}),
f as ({S.fill_sql('i', NUM, False)}) select * from f""")
def q_fallback_fill(spark, sf):
    return D.fallback_fill(D.interpolate_linear(_keyed(spark, sf), NUM), NUM)


# raw (pre-interpolation) series have real gaps: exercise the fills there
_GAPPY = ["temperature_2m", "precipitation", "ndvi", "ssm", "lst_day_1km"]


@register("ffill_bfill", f"""{_KEYED}
select * exclude ({', '.join(_GAPPY)}), {', '.join(
    f"coalesce({c}, last_value({c} ignore nulls) over (partition by region order by date rows between unbounded "
    f"preceding and current row), first_value({c} ignore nulls) over (partition by region order by date rows between "
    f"current row and unbounded following)) as {c}" for c in _GAPPY)} from keyed""")
def q_ffill_bfill(spark, sf):
    return D.ffill_bfill(_keyed(spark, sf), _GAPPY)


@register("fill_table_order", f"{_KEYED}, f as ({S.fill_sql('keyed', _GAPPY, True)}) select * from f")
def q_fill_table_order(spark, sf):
    return D.fill_table_order(_keyed(spark, sf), _GAPPY, scope="table")


@register("build_panel", f"{S.panel_ctes()} select * from panel")
def q_build_panel(spark, sf):
    """The full ETL plan from the raw stacked rows (never the materialised copy)."""
    return P.build_panel(A.obs(spark, sf))


@register("stack_sources", f"""
select region, date, data_source, count(*) as n_rows, count(temperature_2m) as n_temperature, count(precipitation)
  as n_precipitation, count(lst_day_1km) as n_lst, count(ndvi) as n_ndvi, count(ssm) as n_ssm
from ({A.OBS_SQL}) o group by region, date, data_source""")
def q_stack_sources(spark, sf):
    from agrospark.sources.satellite import stack_sources
    from agrospark.plans.q_sources import _scratch
    path = _scratch(spark, "sources")            # one table per source, as the feeds land; the raw table is read once
    A.obs(spark, sf).write.partitionBy("data_source").parquet(path)
    parts = [spark.read.parquet(f"{path}/data_source={s}").withColumn("data_source", F.lit(s)) for s in A.SOURCES]
    st = stack_sources(parts)
    return st.groupBy("region", "date", "data_source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("temperature_2m").alias("n_temperature"),
        F.count("precipitation").alias("n_precipitation"), F.count("lst_day_1km").alias("n_lst"),
        F.count("ndvi").alias("n_ndvi"), F.count("ssm").alias("n_ssm"))


_OBS = f"({A.OBS_SQL}) o"


@register("kelvin_to_celsius", f"""
select l_orderkey, l_linenumber,
  case when temperature_2m > 200 then temperature_2m - cast(273.15 as double) else temperature_2m end as temperature_2m,
  case when lst_day_1km > 200 then lst_day_1km - cast(273.15 as double) else lst_day_1km end as lst_day_1km,
  case when lst_night_1km > 200 then lst_night_1km - cast(273.15 as double) else lst_night_1km end as lst_night_1km
from {_OBS}""")
def q_kelvin(spark, sf):
    o = A.obs(spark, sf).select("l_orderkey", "l_linenumber", "temperature_2m", "lst_day_1km", "lst_night_1km")
    return C.kelvin_to_celsius(o)


@register("scale_bands", f"""
select l_orderkey, l_linenumber, lst_day_1km, lst_night_1km, ndvi, evi,
  lst_day_1km - cast(273.15 as double) as temp_day_celsius, lst_night_1km - cast(273.15 as double) as temp_night_celsius,
  ndvi / cast(10000 as double) as ndvi_normalized, evi / cast(10000 as double) as evi_normalized
from {_OBS}""")
def q_scale_bands(spark, sf):
    o = A.obs(spark, sf).select("l_orderkey", "l_linenumber", "lst_day_1km", "lst_night_1km", "ndvi", "evi")
    return C.scale_bands(o)


@register("repair_ssm", f"""
select l_orderkey, l_linenumber,
  case when ssm < 0 then null when ssm > 1 then ssm / cast(100 as double) else ssm end as ssm
from {_OBS}""")
def q_repair_ssm(spark, sf):
    return C.repair_ssm(A.obs(spark, sf).select("l_orderkey", "l_linenumber", "ssm"))


_CAL = """select o_orderkey, cast(o_orderdate as date) as date, cast(year(o_orderdate) as integer) as year,
  cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
  cast(dayofyear(o_orderdate) as integer) as day_of_year from orders"""


@register("calendar_parts", _CAL)
def q_calendar_parts(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return C.calendar_parts(o, doy=True)


@register("season4", f"select o_orderkey, month, {S.season4_case('month')} as season from ({_CAL}) c")
def q_season4(spark, sf):
    return C.season4(C.calendar_parts(A.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"))).select("o_orderkey", "month"))


@register("season2", f"""
select o_orderkey, month, case when month in (6,7,8,9,10) then 'Wet' else 'Dry' end as season_wet_6_10,
  case when month in (5,6,7,8,9,10) then 'Wet' else 'Dry' end as season_wet_5_10
from ({_CAL}) c""")
def q_season2(spark, sf):
    o = C.calendar_parts(A.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date")))
    o = C.season2(o.select("o_orderkey", "month"), out="season_wet_6_10")
    return C.season2(o, wet_months=(5, 6, 7, 8, 9, 10), out="season_wet_5_10")


@register("season_flags", f"""{S.panel_ctes()}
select region, date, season, cast(coalesce(season = 'Dry', false) as integer) as is_dry_season,
  cast(coalesce(season = 'Wet', false) as integer) as is_wet_season from panel""")
def q_season_flags(spark, sf):
    return C.season_flags(panel(spark, sf).select("region", "date", "season"))


_TWO_PI = "cast(6.283185307179586 as double)"


@register("cyclic_time", f"""{S.panel_ctes()}
select region, date,
  {ssnap(f"sin({_TWO_PI} * month / cast(12 as double))", 9)} as month_sin,
  {ssnap(f"cos({_TWO_PI} * month / cast(12 as double))", 9)} as month_cos,
  {ssnap(f"sin({_TWO_PI} * day / cast(365 as double))", 9)} as day_sin,
  {ssnap(f"cos({_TWO_PI} * day / cast(365 as double))", 9)} as day_cos
from panel""")
def q_cyclic_time(spark, sf):
    from agrospark.functions.numeric import snap
    d = C.cyclic_time(panel(spark, sf).select("region", "date", "month", "day"))
    return d.select("region", "date", *[snap(F.col(c), 9).alias(c) for c in ("month_sin", "month_cos", "day_sin",
                                                                                "day_cos")])


@register("derived_features", f"""{S.panel_ctes()}
select region, date, temp_day_celsius - temp_night_celsius as temp_range,
  sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m)
    as wind_speed,
  (ndvi + evi) / cast(2 as double) as vegetation_health
from panel""")
def q_derived_features(spark, sf):
    return C.derived_features(panel(spark, sf)).select("region", "date", "temp_range", "wind_speed",
                                                       "vegetation_health")
