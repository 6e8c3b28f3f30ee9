"""Registered queries: payload parsers, zonal mean, file sinks and sources.

Payloads are built per event row from the whole ``events`` table (one bounded JSON document per
row) and parsed back; the oracle computes the same fields straight from ``events``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agrospark.dims import dim, values_sql
from agrospark.functions.numeric import snap
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_panel import panel
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.session import checkpoint_dir
from agrospark.sources import adapters as A
from agrospark.sources import json_feeds as J
from agrospark.sources.satellite import region_boxes, zonal_mean, zonal_mean_weighted

_CITY_SQL = ("case user_id % 6 when 0 then 'Dakar' when 1 then 'Thiès' when 2 then 'Saint-Louis' when 3 then "
             "'Kaolack' when 4 then 'Ziguinchor' else 'Tambacounda' end")
_EV = f"""e as (select event_id, {_CITY_SQL} as ville, cast(floor(epoch(ts)) as bigint) as ep,
  value / cast(4 as double) - cast(20 as double) as temp,
  cast(json_extract_string(props, '$.k') as double) * cast(1.2 as double) as hum,
  cast(1000 + event_id % 30 as double) as pres, cast(event_id % 150 as double) / cast(10 as double) as wind,
  case when event_id % 3 = 0 then value / cast(50 as double) end as r,
  case when event_id % 7 = 0 then null else event_type end as descr, value, event_type, user_id,
  cast(json_extract_string(props, '$.k') as double) as k from events)"""


def _events(spark, sf):
    ev = A.table(spark, sf, "events")
    city = F.element_at(F.array(*[F.lit(c) for c in A.METEO_CITIES]), (F.col("user_id") % 6 + 1).cast("int"))
    return ev.withColumns({"ville": city, "ep": F.unix_seconds(F.col("ts").cast("timestamp")),
                           "k": F.get_json_object("props", "$.k").cast("double")})


def _spread(df):
    """Small rows from which large payloads are made, dealt out to every core: a compact table is one or a few splits, which took the
    work of all its payloads."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _weather(eid):
    return F.when(eid % 7 == 0, F.array().cast("array<struct<description:string>>")) \
        .otherwise(F.array(F.struct(F.col("event_type").alias("description"))))


def onecall_payloads(spark, sf):
    e = _events(spark, sf)
    eid = F.col("event_id")
    temp = F.col("value") / F.lit(4.0) - F.lit(20.0)
    hum = F.col("k") * F.lit(1.2)
    pres = (F.lit(1000) + eid % 30).cast("double")
    wind = (eid % 150).cast("double") / F.lit(10.0)
    rain = F.when(eid % 3 == 0, F.struct((F.col("value") / F.lit(50.0)).alias("1h")))

    def reading(dt, t):
        return F.struct(dt.alias("dt"), t.alias("temp"), hum.alias("humidity"), pres.alias("pressure"),
                        wind.alias("wind_speed"), rain.alias("rain"), _weather(eid).alias("weather"))

    cur = F.when(eid % 11 != 0, reading(F.col("ep"), temp))
    hourly = F.when(eid % 5 == 0, F.array().cast(
        "array<struct<dt:bigint,temp:double,humidity:double,pressure:double,wind_speed:double,"
        "rain:struct<`1h`:double>,weather:array<struct<description:string>>>>")) \
        .otherwise(F.array(reading(F.col("ep") + F.lit(3600), temp + F.lit(1.0)),
                           reading(F.col("ep") + F.lit(7200), temp + F.lit(2.0))))
    daily = F.array(F.struct((F.col("ep") + F.lit(86400)).alias("dt"), F.struct(temp.alias("day")).alias("temp"),
                             hum.alias("humidity"), pres.alias("pressure"), wind.alias("wind_speed"),
                             F.when(eid % 3 == 0, F.col("value") / F.lit(50.0)).alias("rain"),
                             _weather(eid).alias("weather")))
    return e.select("ville", F.to_json(F.struct(cur.alias("current"), hourly.alias("hourly"),
                                                daily.alias("daily"))).alias("payload"))


@register("parse_onecall", f"""with {_EV}
select ville, 'current' as type, make_timestamp(ep * 1000000) as date, temp as temperature, hum as humidite,
  pres as pression, wind as vent, coalesce(r, cast(0 as double)) as pluie, descr as description from e
  where event_id % 11 <> 0
union all
select ville, 'hourly', make_timestamp((ep + 3600 * i) * 1000000), temp + cast(i as double), hum, pres, wind,
  coalesce(r, cast(0 as double)), descr from e cross join (values (1), (2)) v(i) where event_id % 5 <> 0
union all
select ville, 'daily', make_timestamp((ep + 86400) * 1000000), temp, hum, pres, wind, coalesce(r, cast(0 as double)),
  descr from e""")
def q_parse_onecall(spark, sf):
    return J.parse_onecall(onecall_payloads(spark, sf))


@register("parse_current", f"""with {_EV}
select ville as city, event_id, value / cast(10 as double) as temperature, k as humidity, pres as pressure,
  case when event_id % 4 = 0 then cast(0 as double) else wind end as wind_speed,
  case when event_id % 4 = 0 or event_id % 6 = 0 then cast(0 as double) else cast(event_id % 360 as double) end
    as wind_direction,
  cast(event_id % 100 as double) as cloudiness,
  coalesce(case when event_id % 9 = 0 then null else cast(5000 + event_id % 5000 as double) end, cast(10000 as double))
    / cast(1000 as double) as visibility,
  descr as weather_description from e""")
def q_parse_current(spark, sf):
    e = _events(spark, sf)
    eid = F.col("event_id")
    wind = F.when(eid % 4 != 0, F.struct(((eid % 150).cast("double") / F.lit(10.0)).alias("speed"),
                                         F.when(eid % 6 != 0, (eid % 360).cast("double")).alias("deg")))
    payload = F.to_json(F.struct(
        F.struct((F.col("value") / F.lit(10.0)).alias("temp"), F.col("k").alias("humidity"),
                 (F.lit(1000) + eid % 30).cast("double").alias("pressure")).alias("main"),
        wind.alias("wind"), F.struct((eid % 100).cast("double").alias("all")).alias("clouds"),
        F.when(eid % 9 != 0, (F.lit(5000) + eid % 5000).cast("double")).alias("visibility"),
        _weather(eid).alias("weather")))
    p = e.select(F.col("ville").alias("city"), "event_id", payload.alias("payload"))
    return J.parse_current(p, wind_default=0.0, keep=("city", "event_id"))


@register("payload_quarantine", f"""with {_EV},
r as (select event_id, value / cast(10 as double) as temperature, case when event_id % 29 = 0 then 'empty' when event_id % 13 = 0 then 'malformed'
  when event_id % 23 = 0 then 'not an object' when event_id % 19 = 0 or value is null or k is null then 'missing main.' || case when value is null then 'temp' else 'humidity' end
  when event_id % 17 = 0 then 'not a number: main.pressure' when event_id % 31 = 0 then 'not a number: wind.speed' else 'good' end as reason from e)
select reason, count(*) as n_rows, min(event_id) as first_event, max(event_id) as last_event,
  {ssnap("sum(case when reason = 'good' then temperature end)")} as temperature_sum from r group by reason""")
def q_payload_quarantine(spark, sf):
    """Current-weather payloads, some of them broken by a rule over event_id: good and quarantined rows by reason add up to the events."""
    from agrospark.sources.quarantine import split
    e, eid = _events(spark, sf), F.col("event_id")
    pressure, speed = (F.lit(1000) + eid % 30).cast("string"), ((eid % 150) / F.lit(10)).cast("string")
    quoted = lambda c, bad: F.when(bad, F.concat(F.lit('"'), c, F.lit(' "'))).otherwise(c)
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    humidity = F.when(eid % 19 != 0, F.concat(F.lit(', "humidity": '), number(F.col("k")))).otherwise(F.lit(""))
    text = F.concat(F.lit('{"main": {"temp": '), number(F.col("value") / F.lit(10.0)), humidity, F.lit(', "pressure": '), quoted(pressure, eid % 17 == 0),
                    F.lit('}, "wind": {"speed": '), quoted(speed, eid % 31 == 0), F.lit("}}"))
    payload = F.when(eid % 29 == 0, F.when(eid % 2 == 0, F.lit("  "))).when(eid % 13 == 0, F.expr("substring(t, 1, char_length(t) - 2)")).when(eid % 23 == 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    df = e.withColumn("t", text).select("event_id", F.col("ville").alias("city"), payload.alias("payload"))
    good, bad = split(df, "current", keep=("event_id",))
    rows = good.select(F.lit("good").alias("reason"), "event_id", "temperature").unionByName(bad.select("reason", "event_id", F.lit(None).cast("double").alias("temperature")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
                                      snap(F.sum("temperature")).alias("temperature_sum"))


@register("parse_forecast", f"""with {_EV}
select ville as city, event_id, cast(i as integer) as pos, make_timestamp((ep + 10800 * i) * 1000000) as datetime,
  value / cast(10 as double) + cast(i as double) * cast(0.5 as double) as temperature, k as humidity,
  pres as pressure, wind as wind_speed,
  case when i % 2 = 0 then value / cast(50 as double) else cast(0 as double) end as precipitation,
  cast(event_id % 100 as double) as cloudiness, event_type as weather_description
from e cross join range(0, 8) t(i)""")
def q_parse_forecast(spark, sf):
    e = _spread(_events(spark, sf).drop("props"))
    eid = F.col("event_id")

    def entry(i):
        return F.struct(
            (F.col("ep") + F.lit(10800 * i)).alias("dt"),
            F.struct((F.col("value") / F.lit(10.0) + F.lit(i * 0.5)).alias("temp"),
                     F.col("k").alias("humidity"), (F.lit(1000) + eid % 30).cast("double").alias("pressure"))
            .alias("main"),
            F.struct(((eid % 150).cast("double") / F.lit(10.0)).alias("speed")).alias("wind"),
            F.when(F.lit(i % 2 == 0), F.struct((F.col("value") / F.lit(50.0)).alias("3h"))).alias("rain"),
            F.struct((eid % 100).cast("double").alias("all")).alias("clouds"),
            F.array(F.struct(F.col("event_type").alias("description"))).alias("weather"))

    # entries spelled out: a lambda is interpreted, and would read props anew for each entry
    payload = F.to_json(F.struct(F.array(*[entry(i) for i in range(10)]).alias("list")))
    p = e.select(F.col("ville").alias("city"), "event_id", payload.alias("payload"))
    return J.parse_forecast(p, days=1, keep=("city", "event_id"))


@register("parse_geocode", f"""with {_EV}
select ville, round(cast(12 as double) + cast(event_id % 450 as double) / cast(100 as double)
    + cast(0.00001234 as double), 4) as lat,
  round(cast(-18 as double) + cast(user_id % 600 as double) / cast(100 as double) - cast(0.00004321 as double), 4) as lon
from e where event_id % 8 <> 0""")
def q_parse_geocode(spark, sf):
    e = _events(spark, sf)
    eid = F.col("event_id")
    hit = F.struct(F.col("ville").alias("name"),
                   (F.lit(12.0) + (eid % 450).cast("double") / F.lit(100.0) + F.lit(0.00001234)).alias("lat"),
                   (F.lit(-18.0) + (F.col("user_id") % 600).cast("double") / F.lit(100.0) - F.lit(0.00004321))
                   .alias("lon"))
    second = F.struct(F.lit("alt").alias("name"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    hits = F.when(eid % 8 == 0, F.array().cast("array<struct<name:string,lat:double,lon:double>>")) \
        .otherwise(F.array(hit, second))
    return J.parse_geocode(e.select("ville", F.to_json(hits).alias("payload")))


@register("zonal_mean", f"""with p as ({A.PIXELS_SQL}),
b as (select region, lon - buffer as lon_min, lat - buffer as lat_min, lon + buffer as lon_max, lat + buffer as lat_max
  from {values_sql('regions')})
select region, date, {ssnap('avg(band)')} as band, count(*) as n_pixels
from p join b on p.lon between lon_min and lon_max and p.lat between lat_min and lat_max
where date >= DATE '2024-01-01' and date < DATE '2024-01-31'
group by region, date""")
def q_zonal_mean(spark, sf):
    z = zonal_mean(A.pixels(spark, sf), region_boxes(dim(spark, "regions")), ["band"], "2024-01-01", "2024-01-31")
    return z.withColumn("band", snap(F.col("band")))


@register("zonal_mean_weighted", f"""with p as (select date, band, lon - 0.25::double as x1, lon + 0.25::double as x2, lat - 0.25::double as y1, lat + 0.25::double as y2
  from ({A.PIXELS_SQL}) q),
b as (select region, lon - buffer as lon_min, lat - buffer as lat_min, lon + buffer as lon_max, lat + buffer as lat_max
  from {values_sql('regions')}),
j as (select region, date, band, x1, x2, y1, y2, greatest(x1, lon_min) as a, least(x2, lon_max) as b, greatest(y1, lat_min) as c, least(y2, lat_max) as d
  from p join b on greatest(x1, lon_min) < least(x2, lon_max) and greatest(y1, lat_min) < least(y2, lat_max)
  where date >= DATE '2024-01-01' and date < DATE '2025-01-01'),
w as (select *, (sin(radians(d)) - sin(radians(c))) * (b - a) as w, (sin(radians(y2)) - sin(radians(y1))) * (x2 - x1) as whole from j)
select region, date, {ssnap('sum(band * w) / sum(case when band is not null then w end)')} as band, {ssnap('sum(w / whole)')} as covered, count(*) as n_pixels
from w group by region, date""")
def q_zonal_mean_weighted(spark, sf):
    """The year's area-weighted daily means of pixels half a degree wide: border pixels count by their covered share."""
    z = zonal_mean_weighted(A.pixels(spark, sf), region_boxes(dim(spark, "regions")), ["band"], 0.5, "2024-01-01", "2025-01-01")
    return z.withColumns({"band": snap(F.col("band")), "covered": snap(F.col("covered"))})


def _scratch(spark, name):
    """A fresh folder under the session's shared checkpoint location (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/agrospark-{name}-{uuid.uuid4().hex}"


@register("sink_roundtrip", f"""{panel_ctes()}
select region, date, year, temperature_2m, ssm from panel""")
def q_sink_roundtrip(spark, sf):
    from agrospark.sources.files import read_table, write_table
    path = _scratch(spark, "panel")
    write_table(panel(spark, sf).select("region", "date", "year", "temperature_2m", "ssm"), path,
                partition_by=("year",), sort_within=("region", "date"))
    return read_table(spark, path).select("region", "date", F.col("year").cast("int").alias("year"),
                                          "temperature_2m", "ssm")


@register("read_fao_csv", f"""with t as (select "Element" as element, "Item" as item, "Year" as year, "Unit" as unit,
  "Value" as value, regexp_replace(regexp_replace(file_name, '^FAOSTAT_data_', ''), '_Senegal.*$', '') as source
  from ({A.FAO_RAW_SQL}) r),
v as (select element, item, year, unit, try_cast(trim(value) as double) as value, source from t),
y as (select element, item, try_cast(trim(year) as double) as yd, unit, value, source from v where value is not null)
select trim(element) as element, trim(item) as item, cast(yd as integer) as year, trim(unit) as unit, value,
  trim(source) as source from y where yd is not null and yd = floor(yd)""")
def q_read_fao_csv(spark, sf):
    """FAO-style CSV files (one folder per source file name) written, then read back with source tags."""
    from agrospark.operators.clean import clean_fao
    from agrospark.sources.files import read_fao
    path = _scratch(spark, "fao")
    raw = A.fao_raw(spark, sf).withColumn("src", F.regexp_replace("file_name", r"\.csv$", ""))
    raw.drop("file_name", "row_id").write.mode("overwrite").option("header", True).partitionBy("src").csv(path)
    schema = "Element string, Item string, Year string, Unit string, Value string"
    back = read_fao(spark, f"{path}/*/*.csv", schema=schema)
    return clean_fao(back.drop("file_name"))
