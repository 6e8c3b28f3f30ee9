"""Adapters: the driver's generated tables -> the logical inputs of the platform.

Each adapter is a pure projection over a whole table, written once per dialect: a Spark
DataFrame function and the equivalent DuckDB SQL (used by the oracle queries). Parquet scans
are column-pruned by Catalyst, so an adapter reads only the columns it maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------------------- obs (from lineitem)

# source rank: l_linenumber % 5 -> 1 ERA5, 2 CHIRPS, 3 MODIS_TEMP, 4 MODIS_VI, 0 -> 5 SMAP
SOURCES = ["ERA5", "CHIRPS", "MODIS_TEMP", "MODIS_VI", "SMAP"]
OBS_ORDER = ["source_rank", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked sparse satellite rows: each source row fills only its own columns.

    Also carries the platform's derived bands (temp_*_celsius, *_normalized) computed at extract
    time from the raw LST / VI values.
    """
    li = table(spark, sf_dir, "lineitem")
    s = F.col("l_linenumber") % 5
    rank = F.when(s == 0, F.lit(5)).otherwise(s)
    q, d, t, p = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.col("l_extendedprice")
    k = F.col("l_suppkey") % 14

    def only(src: int, v):
        return F.when(s == src, v)

    src_name = F.element_at(F.array(*[F.lit(x) for x in SOURCES]), rank.cast("int"))
    lst_day = only(3, F.lit(290.0) + q * F.lit(0.5))
    lst_night = only(3, F.lit(283.0) + q * F.lit(0.25))
    ndvi = only(4, q * F.lit(180.0))
    evi = only(4, q * F.lit(150.0))
    return li.select(
        F.concat(F.lit("R"), F.lpad(k.cast("string"), 2, "0")).alias("region"),
        (F.lit(12.0) + k.cast("double") * F.lit(0.3)).alias("latitude"),
        (F.lit(-17.0) + k.cast("double") * F.lit(0.4)).alias("longitude"),
        F.to_date(F.col("l_shipdate")).alias("date"),
        only(1, F.lit(10000000.0) + p * F.lit(100.0)).alias("surface_solar_radiation_downwards_sum"),
        only(1, F.lit(285.0) + q * F.lit(0.5)).alias("temperature_2m"),
        only(1, F.when(d >= F.lit(0.05), (d - F.lit(0.05)) * F.lit(400.0)).otherwise(F.lit(0.0)))
        .alias("total_precipitation_sum"),
        only(1, q / F.lit(10.0) - F.lit(2.5)).alias("u_component_of_wind_10m"),
        only(1, t * F.lit(50.0) - F.lit(2.0)).alias("v_component_of_wind_10m"),
        only(2, d * F.lit(100.0)).alias("precipitation"),
        lst_day.alias("lst_day_1km"),
        lst_night.alias("lst_night_1km"),
        (lst_day - F.lit(273.15)).alias("temp_day_celsius"),
        (lst_night - F.lit(273.15)).alias("temp_night_celsius"),
        evi.alias("evi"),
        ndvi.alias("ndvi"),
        (ndvi / F.lit(10000.0)).alias("ndvi_normalized"),
        (evi / F.lit(10000.0)).alias("evi_normalized"),
        only(0, t * F.lit(15.0) - F.lit(0.1)).alias("ssm"),
        src_name.alias("data_source"),
        rank.cast("int").alias("source_rank"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )


OBS_SQL = """
  select concat('R', lpad(cast(l_suppkey % 14 as varchar), 2, '0')) as region,
    cast(12 as double) + cast(l_suppkey % 14 as double) * cast(0.3 as double) as latitude,
    cast(-17 as double) + cast(l_suppkey % 14 as double) * cast(0.4 as double) as longitude,
    cast(l_shipdate as date) as date,
    case when l_linenumber % 5 = 1 then cast(10000000 as double) + l_extendedprice * cast(100 as double) end
      as surface_solar_radiation_downwards_sum,
    case when l_linenumber % 5 = 1 then cast(285 as double) + l_quantity * cast(0.5 as double) end as temperature_2m,
    case when l_linenumber % 5 = 1 then case when l_discount >= cast(0.05 as double)
      then (l_discount - cast(0.05 as double)) * cast(400 as double) else cast(0 as double) end end
      as total_precipitation_sum,
    case when l_linenumber % 5 = 1 then l_quantity / cast(10 as double) - cast(2.5 as double) end
      as u_component_of_wind_10m,
    case when l_linenumber % 5 = 1 then l_tax * cast(50 as double) - cast(2 as double) end as v_component_of_wind_10m,
    case when l_linenumber % 5 = 2 then l_discount * cast(100 as double) end as precipitation,
    case when l_linenumber % 5 = 3 then cast(290 as double) + l_quantity * cast(0.5 as double) end as lst_day_1km,
    case when l_linenumber % 5 = 3 then cast(283 as double) + l_quantity * cast(0.25 as double) end as lst_night_1km,
    case when l_linenumber % 5 = 3 then cast(290 as double) + l_quantity * cast(0.5 as double) - cast(273.15 as double) end
      as temp_day_celsius,
    case when l_linenumber % 5 = 3 then cast(283 as double) + l_quantity * cast(0.25 as double) - cast(273.15 as double) end
      as temp_night_celsius,
    case when l_linenumber % 5 = 4 then l_quantity * cast(150 as double) end as evi,
    case when l_linenumber % 5 = 4 then l_quantity * cast(180 as double) end as ndvi,
    case when l_linenumber % 5 = 4 then l_quantity * cast(180 as double) / cast(10000 as double) end as ndvi_normalized,
    case when l_linenumber % 5 = 4 then l_quantity * cast(150 as double) / cast(10000 as double) end as evi_normalized,
    case when l_linenumber % 5 = 0 then l_tax * cast(15 as double) - cast(0.1 as double) end as ssm,
    case l_linenumber % 5 when 1 then 'ERA5' when 2 then 'CHIRPS' when 3 then 'MODIS_TEMP' when 4 then 'MODIS_VI'
      else 'SMAP' end as data_source,
    cast(case when l_linenumber % 5 = 0 then 5 else l_linenumber % 5 end as integer) as source_rank,
    l_orderkey, l_linenumber, l_partkey, l_extendedprice
  from lineitem
"""


# ----------------------------------------------------------------------------- meteo raw (from events)

METEO_CITIES = ["Dakar", "Thiès", "Saint-Louis", "Kaolack", "Ziguinchor", "Tambacounda"]


def meteo_raw(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    """Irregular weather readings with text-typed temperature (to exercise coercion).

    The whole events table is mapped; with ``with_duplicates`` the rows whose event_id is a
    multiple of 10 are appended a second time, so exact duplicates exist for the dedup step.
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    city = F.element_at(F.array(*[F.lit(c) for c in METEO_CITIES]), (F.col("user_id") % 6 + 1).cast("int"))
    typ = F.when(F.col("event_type") == "click", F.lit("hourly")) \
        .when(F.col("event_type") == "view", F.lit("daily")).otherwise(F.lit("current"))
    temp = F.when(eid % 97 == 0, F.lit("n/a")).when(eid % 89 == 0, F.lit(None).cast("string")) \
        .otherwise((F.col("value") / F.lit(4.0) - F.lit(20.0)).cast("string"))
    out = ev.select(
        city.alias("ville"), typ.alias("type"), F.col("ts").alias("date"),
        temp.alias("temperature"),
        (F.get_json_object("props", "$.k").cast("double") * F.lit(1.2)).alias("humidite"),
        (F.lit(1000) + eid % 30).alias("pression"),
        ((eid % 150).cast("double") / F.lit(10.0)).alias("vent"),
        F.when(eid % 3 == 0, F.col("value") / F.lit(50.0)).otherwise(F.lit(0.0)).alias("pluie"),
        F.col("event_type").alias("description"),
    )
    if with_duplicates:
        out = out.unionByName(_meteo_dups(ev, city, typ, temp))
    return out


def _meteo_dups(ev, city, typ, temp):
    eid = F.col("event_id")
    return ev.filter(eid % 10 == 0).select(
        city.alias("ville"), typ.alias("type"), F.col("ts").alias("date"),
        temp.alias("temperature"),
        (F.get_json_object("props", "$.k").cast("double") * F.lit(1.2)).alias("humidite"),
        (F.lit(1000) + eid % 30).alias("pression"),
        ((eid % 150).cast("double") / F.lit(10.0)).alias("vent"),
        F.when(eid % 3 == 0, F.col("value") / F.lit(50.0)).otherwise(F.lit(0.0)).alias("pluie"),
        F.col("event_type").alias("description"),
    )


_METEO_SELECT = """
  select case user_id % 6 when 0 then 'Dakar' when 1 then 'Thiès' when 2 then 'Saint-Louis' when 3 then 'Kaolack'
              when 4 then 'Ziguinchor' else 'Tambacounda' end as ville,
    case event_type when 'click' then 'hourly' when 'view' then 'daily' else 'current' end as type,
    ts as date,
    case when event_id % 97 = 0 then 'n/a' when event_id % 89 = 0 then null
         else cast(value / cast(4 as double) - cast(20 as double) as varchar) end as temperature,
    cast(json_extract_string(props, '$.k') as double) * cast(1.2 as double) as humidite,
    1000 + event_id % 30 as pression,
    cast(event_id % 150 as double) / cast(10 as double) as vent,
    case when event_id % 3 = 0 then value / cast(50 as double) else cast(0 as double) end as pluie,
    event_type as description
  from events"""

METEO_RAW_SQL = f"({_METEO_SELECT}) union all ({_METEO_SELECT} where event_id % 10 = 0)"


# stations of the first six regions, in the panel's years: the same readings under the regions' names
STATION_SHIFT_DAYS = 10227


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = meteo_raw(spark, sf_dir)
    names = F.create_map(*[x for i, c in enumerate(METEO_CITIES) for x in (F.lit(c), F.lit(f"R{i:02d}"))])
    return m.withColumns({"ville": names[F.col("ville")], "date": F.expr(f"date - interval {STATION_SHIFT_DAYS} days")})


STATIONS_SQL = f"""select * replace (case ville {' '.join(f"when '{c}' then 'R{i:02d}'" for i, c in enumerate(METEO_CITIES))} end as ville,
  date - INTERVAL {STATION_SHIFT_DAYS} DAY as date) from ({METEO_RAW_SQL}) raw0"""


# ----------------------------------------------------------------------------- readings (typed weather)

def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed current-weather readings per provider city (city, ts, measures) from the events table."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    city = F.element_at(F.array(*[F.lit(c) for c in METEO_CITIES]), (F.col("user_id") % 6 + 1).cast("int"))
    return ev.select(
        eid.alias("reading_id"),
        city.alias("city"),
        F.col("ts"),
        (F.lit(1) + eid % 12).cast("int").alias("month"),
        (F.col("value") / F.lit(10.0)).alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity"),
        (F.lit(1000.0) + (eid % 30).cast("double")).alias("pressure"),
        ((eid % 150).cast("double") / F.lit(10.0)).alias("wind_speed"),
        F.when(eid % 3 == 0, F.col("value") / F.lit(20.0)).otherwise(F.lit(0.0)).alias("precipitation"),
        F.col("event_type").alias("weather_description"),
    )


def extreme_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of a heat wave: hotter, drier and windier, so that every alert rule fires somewhere."""
    return readings(spark, sf_dir).withColumns({"temperature": F.col("temperature") + F.lit(30.0), "humidity": F.col("humidity") / F.lit(10.0),
                                                "wind_speed": F.col("wind_speed") + F.lit(8.0)})


READINGS_SQL = """
  select event_id as reading_id,
    case user_id % 6 when 0 then 'Dakar' when 1 then 'Thiès' when 2 then 'Saint-Louis' when 3 then 'Kaolack'
         when 4 then 'Ziguinchor' else 'Tambacounda' end as city,
    ts, cast(1 + event_id % 12 as integer) as month,
    value / cast(10 as double) as temperature,
    cast(json_extract_string(props, '$.k') as double) as humidity,
    cast(1000 as double) + cast(event_id % 30 as double) as pressure,
    cast(event_id % 150 as double) / cast(10 as double) as wind_speed,
    case when event_id % 3 = 0 then value / cast(20 as double) else cast(0 as double) end as precipitation,
    event_type as weather_description
  from events"""


EXTREME_SQL = f"""select * replace (temperature + cast(30 as double) as temperature, humidity / cast(10 as double) as humidity,
  wind_speed + cast(8 as double) as wind_speed) from ({READINGS_SQL}) r0"""


def field_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as taken in the panel's regions, on days (``as_of_day``) in and before the panel's time."""
    r = readings(spark, sf_dir)
    place = table(spark, sf_dir, "events").select(F.col("event_id").alias("reading_id"), F.concat(F.lit("R"), F.lpad((F.col("user_id") % 14).cast("string"), 2, "0")).alias("region"))
    day = F.date_add(F.lit("1991-12-01").cast("date"), ((F.col("reading_id") * 7919) % 2600).cast("int"))
    return r.join(place, "reading_id").withColumns({"as_of_day": day, "date": F.to_date("ts")})


FIELD_SQL = """
  select event_id as reading_id, concat('R', lpad(cast(user_id % 14 as varchar), 2, '0')) as region,
    DATE '1991-12-01' + cast((event_id * 7919) % 2600 as integer) as as_of_day
  from events"""


# ----------------------------------------------------------------------------- fao raw (from orders)

def fao_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FAOSTAT-like long table with raw header names and text-typed Year/Value, plus the file name."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("Element"),
        F.col("o_orderstatus").alias("Item"),
        F.year("o_orderdate").cast("string").alias("Year"),
        F.lit("t").alias("Unit"),
        F.when(F.col("o_orderkey") % 53 == 0, F.lit("F")).otherwise(F.col("o_totalprice").cast("string")).alias("Value"),
        F.concat(F.lit("FAOSTAT_data_"), F.col("o_orderpriority"), F.lit("_Senegal.csv")).alias("file_name"),
        F.col("o_orderkey").alias("row_id"),
    )


FAO_RAW_SQL = """
  select o_orderpriority as "Element", o_orderstatus as "Item", cast(year(o_orderdate) as varchar) as "Year",
    't' as "Unit",
    case when o_orderkey % 53 = 0 then 'F' else cast(o_totalprice as varchar) end as "Value",
    concat('FAOSTAT_data_', o_orderpriority, '_Senegal.csv') as file_name,
    o_orderkey as row_id
  from orders"""


# ----------------------------------------------------------------------------- predictions

def class_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string")).alias("model"),
        (F.col("l_linenumber") % 4).cast("int").alias("y"),
        ((F.col("l_linenumber") + F.when(F.col("l_partkey") % 7 == 0, F.lit(1)).otherwise(F.lit(0))) % 4)
        .cast("int").alias("yhat"),
    )


CLASS_PRED_SQL = """
  select concat('m', cast(l_suppkey % 3 as varchar)) as model, cast(l_linenumber % 4 as integer) as y,
    cast((l_linenumber + case when l_partkey % 7 = 0 then 1 else 0 end) % 4 as integer) as yhat
  from lineitem"""


def reg_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string")).alias("model"),
        F.col("l_quantity").alias("y"),
        (F.col("l_quantity") + (F.col("l_partkey") % 11).cast("double") - F.lit(5.0)).alias("yhat"),
    )


REG_PRED_SQL = """
  select concat('m', cast(l_suppkey % 3 as varchar)) as model, l_quantity as y,
    l_quantity + cast(l_partkey % 11 as double) - cast(5 as double) as yhat
  from lineitem"""


# ----------------------------------------------------------------------------- pixels (from events)

def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit("events").alias("collection"),
        F.to_date("ts").alias("date"),
        (F.lit(-18.0) + (F.col("user_id") % 60).cast("double") / F.lit(10.0)).alias("lon"),
        (F.lit(12.0) + (F.col("event_id") % 45).cast("double") / F.lit(10.0)).alias("lat"),
        F.col("value").alias("band"),
    )


PIXELS_SQL = """
  select 'events' as collection, cast(ts as date) as date,
    cast(-18 as double) + cast(user_id % 60 as double) / cast(10 as double) as lon,
    cast(12 as double) + cast(event_id % 45 as double) / cast(10 as double) as lat,
    value as band
  from events"""
