"""Registered queries: cleaning and coercion."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrospark.operators import clean as C
from agrospark.plans.registry import register
from agrospark.sources import adapters as A

_RAW = A.METEO_RAW_SQL

# numeric coercion in SQL mirrors coerce_numeric: try_cast text, cast numbers, NaN -> null
_COERCED = """select ville, type, date,
    try_cast(trim(temperature) as double) as temperature, cast(humidite as double) as humidite,
    cast(pression as double) as pression, cast(vent as double) as vent, cast(pluie as double) as pluie, description"""


@register("clean_weather", f"""
with raw as ({_RAW}),
d as (select distinct * from raw),
n as (select * from d where date is not null and temperature is not null and humidite is not null),
c as ({_COERCED} from n)
select * from c where humidite between 0 and 100 and temperature between -80 and 60
""")
def q_clean_weather(spark, sf):
    return C.clean_weather(A.meteo_raw(spark, sf))


@register("dedup_exact", f"select distinct * from ({_RAW}) raw")
def q_dedup_exact(spark, sf):
    return C.dedup_exact(A.meteo_raw(spark, sf))


@register("drop_incomplete", f"""
select * from ({_RAW}) raw where date is not null and temperature is not null and humidite is not null""")
def q_drop_incomplete(spark, sf):
    return C.drop_incomplete(A.meteo_raw(spark, sf), ["date", "temperature", "humidite"])


@register("coerce_numeric", f"{_COERCED} from ({_RAW}) raw")
def q_coerce_numeric(spark, sf):
    return C.coerce_numeric(A.meteo_raw(spark, sf), C.METEO_NUMERIC)


@register("plausible_range", f"""
with c as ({_COERCED} from ({_RAW}) raw)
select * from c where humidite between 0 and 100 and temperature between -80 and 60""")
def q_plausible_range(spark, sf):
    return C.plausible_range(C.coerce_numeric(A.meteo_raw(spark, sf), C.METEO_NUMERIC))


@register("coerce_date", """
select event_id, try_cast(case when event_id % 41 = 0 then 'not a date' else cast(cast(ts as date) as varchar) end
  as date) as date from events""")
def q_coerce_date(spark, sf):
    ev = A.table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 41 == 0, F.lit("not a date")).otherwise(F.to_date("ts").cast("string"))
    return C.coerce_date(ev.select("event_id", txt.alias("date")), "date")


@register("normalize_names", f"""
select "Element" as element, "Item" as item, "Year" as year, "Unit" as unit, "Value" as value, file_name, row_id
from ({A.FAO_RAW_SQL}) r""")
def q_normalize_names(spark, sf):
    return C.normalize_names(A.fao_raw(spark, sf))


_FAO_NORM = f"""select "Element" as element, "Item" as item, "Year" as year, "Unit" as unit, "Value" as value,
  regexp_replace(regexp_replace(file_name, '^FAOSTAT_data_', ''), '_Senegal.*$', '') as source, row_id
  from ({A.FAO_RAW_SQL}) r"""


@register("clean_fao", f"""
with t as ({_FAO_NORM}),
v as (select element, item, year, unit, try_cast(trim(value) as double) as value, source from t),
y as (select element, item, try_cast(trim(year) as double) as yd, unit, value, source from v where value is not null)
select trim(element) as element, trim(item) as item, cast(yd as integer) as year, trim(unit) as unit, value,
  trim(source) as source
from y where yd is not null and yd = floor(yd)""")
def q_clean_fao(spark, sf):
    from agrospark.sources.files import tag_source
    return C.clean_fao(tag_source(A.fao_raw(spark, sf), "file_name").drop("file_name", "row_id"))


@register("conform_fao", f"""
select substring("Element", 1, 255) as element, substring("Item", 1, 255) as item,
  try_cast(try_cast("Year" as double) as integer) as year, substring("Unit", 1, 50) as unit,
  try_cast("Value" as double) as value, file_name, row_id
from ({A.FAO_RAW_SQL}) r""")
def q_conform_fao(spark, sf):
    return C.conform_fao(A.fao_raw(spark, sf))


@register("trim_strings", """
select o_orderkey, trim(concat('  ', o_orderpriority, ' ')) as o_orderpriority, trim(o_orderstatus) as o_orderstatus
from orders""")
def q_trim_strings(spark, sf):
    o = A.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("o_orderpriority"),
        "o_orderstatus")
    return C.trim_strings(o, ["o_orderpriority", "o_orderstatus", "absent_column"])


@register("project_known", f"""
select region, latitude, longitude, date, temperature_2m, ssm, data_source from ({A.OBS_SQL}) o""")
def q_project_known(spark, sf):
    return C.project_known(A.obs(spark, sf), ["region", "latitude", "longitude", "date", "year", "temperature_2m",
                                              "ssm", "data_source"])


@register("valid_locations", """
select s_suppkey, s_acctbal as lat, cast(s_nationkey as double) as lon from supplier
where s_acctbal <> 0 and cast(s_nationkey as double) <> 0""")
def q_valid_locations(spark, sf):
    s = A.table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("lat"),
                                              F.col("s_nationkey").cast("double").alias("lon"))
    return C.valid_locations(s, "lat", "lon")
