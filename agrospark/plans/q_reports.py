"""Registered queries: reports, metrics, reshape and joins."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from agrospark.dims import values_sql
from agrospark.functions.numeric import snap
from agrospark.operators import reports as RP
from agrospark.operators import reshape as K
from agrospark.operators.clean import clean_fao
from agrospark.plans import features as FT
from agrospark.plans import features_sql as FS
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_features import snapped
from agrospark.plans.q_panel import panel
from agrospark.plans.q_rules import _need_expr
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.sources import adapters as A
from agrospark.sources.files import tag_source

D = FS.D


def _fao(spark, sf):
    return clean_fao(tag_source(A.fao_raw(spark, sf), "file_name").drop("file_name", "row_id"))


_FAO_CLEAN = f"""with t as (select "Element" as element, "Item" as item, "Year" as year, "Unit" as unit, "Value" as value,
  regexp_replace(regexp_replace(file_name, '^FAOSTAT_data_', ''), '_Senegal.*$', '') as source from ({A.FAO_RAW_SQL}) r),
v as (select element, item, year, unit, try_cast(trim(value) as double) as value, source from t),
y as (select element, item, try_cast(trim(year) as double) as yd, unit, value, source from v where value is not null),
fao as (select trim(element) as element, trim(item) as item, cast(yd as integer) as year, trim(unit) as unit, value,
  trim(source) as source from y where yd is not null and yd = floor(yd))"""


@register("profile_fao", f"""{_FAO_CLEAN}
select count(*) as total_records, count(distinct element) as unique_elements, count(distinct item) as unique_items,
  min(year) as year_min, max(year) as year_max, count(value) as value_count, {ssnap('avg(value)')} as value_mean,
  {ssnap('stddev_samp(value)')} as value_std, min(value) as value_min, max(value) as value_max,
  {ssnap('quantile_cont(value, 0.25)')} as value_25, {ssnap('quantile_cont(value, 0.5)')} as value_50,
  {ssnap('quantile_cont(value, 0.75)')} as value_75 from fao""")
def q_profile_fao(spark, sf):
    p = RP.profile_fao(_fao(spark, sf))
    return p.select(*[snap(F.col(c)).alias(c) if c in ("value_mean", "value_std", "value_25", "value_50", "value_75")
                      else F.col(c) for c in p.columns])


@register("top_items", f"""{_FAO_CLEAN}
select item, count(*) as count from fao group by item order by count desc, item limit 5""")
def q_top_items(spark, sf):
    return RP.top_items(_fao(spark, sf), "item", 5)




@register("fao_source_tag", f"""
select file_name, regexp_replace(regexp_replace(file_name, '^FAOSTAT_data_', ''), '_Senegal.*$', '') as source,
  count(*) as n_rows from ({A.FAO_RAW_SQL}) r group by file_name""")
def q_fao_source_tag(spark, sf):
    t = tag_source(A.fao_raw(spark, sf), "file_name")
    return t.groupBy("file_name", "source").agg(F.count(F.lit(1)).alias("n_rows"))


@register("latest_file", f"""
select * from ({A.FAO_RAW_SQL}) r where file_name = (select max(file_name) from ({A.FAO_RAW_SQL}) r2)""")
def q_latest_file(spark, sf):
    from agrospark.sources.files import latest_version
    return latest_version(A.fao_raw(spark, sf), "file_name")


_PRED_C = f"({A.CLASS_PRED_SQL}) p"
_PRED_R = f"({A.REG_PRED_SQL}) p"


@register("regression_metrics", f"""
select model, {ssnap('avg((y - yhat) * (y - yhat))')} as mse, {ssnap('sqrt(avg((y - yhat) * (y - yhat)))')} as rmse,
  {ssnap(f'case when var_pop(y) <> 0 then {D(1)} - avg((y - yhat) * (y - yhat)) / var_pop(y) end')} as r2,
  {ssnap('avg(abs(y - yhat))')} as mae,
  {ssnap(f'avg(abs((y - yhat) / greatest(y, {D(1e-8)}))) * {D(100)}')} as mape, count(*) as n
from {_PRED_R} group by model""")
def q_regression_metrics(spark, sf):
    m = RP.regression_metrics(A.reg_predictions(spark, sf), "y", "yhat", "model")
    return snapped(m)


@register("confusion_matrix", f"select model, y, yhat, count(*) as n from {_PRED_C} group by model, y, yhat")
def q_confusion_matrix(spark, sf):
    return RP.confusion_matrix(A.class_predictions(spark, sf))


_REPORT = f"""with cm as (select model, y, yhat, count(*) as n from {_PRED_C} group by model, y, yhat),
t as (select model, y as label, cast(sum(n) as bigint) as support,
  cast(sum(case when y = yhat then n else 0 end) as bigint) as tp from cm group by model, y),
p as (select model, yhat as label, cast(sum(n) as bigint) as predicted from cm group by model, yhat),
r as (select coalesce(t.model, p.model) as model, coalesce(t.label, p.label) as label,
  coalesce(support, 0) as support, coalesce(tp, 0) as tp, coalesce(predicted, 0) as predicted
  from t full join p on t.model = p.model and t.label = p.label),
r2 as (select *, case when predicted > 0 then tp / predicted else {D(0)} end as precision,
  case when support > 0 then tp / support else {D(0)} end as recall from r),
rep as (select *, case when precision + recall > 0 then {D(2)} * precision * recall / (precision + recall)
  else {D(0)} end as f1 from r2)"""


@register("class_report", f"""{_REPORT}
select model, label, support, tp, predicted, {ssnap('precision')} as precision, {ssnap('recall')} as recall,
  {ssnap('f1')} as f1 from rep""")
def q_class_report(spark, sf):
    return snapped(RP.class_report(A.class_predictions(spark, sf)))


@register("classification_metrics", f"""{_REPORT}
select model, {ssnap('sum(tp) / sum(support)')} as accuracy, {ssnap('sum(precision * support) / sum(support)')}
  as precision, {ssnap('sum(recall * support) / sum(support)')} as recall,
  {ssnap('sum(f1 * support) / sum(support)')} as f1, cast(sum(support) as bigint) as n from rep group by model""")
def q_classification_metrics(spark, sf):
    return snapped(RP.classification_metrics(A.class_predictions(spark, sf)))


@register("class_distribution", f"""{panel_ctes()},
d as (select *, {ssnap(FS.strict('sum', 'total_precipitation_sum', 30), 9)} as precip_sum_30 from panel),
q as (select quantile_cont(precip_sum_30, 0.2) as qa, quantile_cont(temperature_2m, 0.8) as qb,
        quantile_cont(ssm, 0.2) as qc, quantile_cont(ndvi, 0.2) as qd from d),
s as (select d.*, (case when coalesce(precip_sum_30 < qa, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(temperature_2m > qb, false) then {D(0.2)} else {D(0)} end)
    + (case when coalesce(ssm < qc, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(ndvi < qd, false) then {D(0.2)} else {D(0)} end) as drought_score from d cross join q)
select case when drought_score <= {D(0.2)} then 0 when drought_score <= {D(0.4)} then 1
    when drought_score <= {D(0.6)} then 2 else 3 end as drought_class, count(*) as n from s group by 1""")
def q_class_distribution(spark, sf):
    from agrospark.operators.indices import drought_label
    return RP.class_distribution(drought_label(panel(spark, sf)), "drought_class")


@register("target_summary", f"""select {ssnap('min(irrigation_need)')} as min, {ssnap('max(irrigation_need)')} as max,
  {ssnap('avg(irrigation_need)')} as mean, count(irrigation_need) as n from ({FS.irrigation_need_sql()}) x""")
def q_target_summary(spark, sf):
    lab = FT.irrigation_labelled(panel(spark, sf)).select(snap(F.col("irrigation_need")).alias("irrigation_need"))
    return snapped(RP.target_summary(lab, "irrigation_need"))


@register("residual_histogram", f"""with r as (select model, y - yhat as residual from {_PRED_R}),
mm as (select model, min(residual) as _lo, max(residual) as _hi from r group by model),
j as (select r.model, residual, _lo, _hi, (_hi - _lo) / {D(30)} as w from r join mm using (model)),
b as (select model, _lo, _hi, case when w = 0 then 0 else least(29, cast(floor((residual - _lo) / w) as integer)) end
  as bin from j)
select model, bin, count(*) as n, {ssnap(f'first(_lo) + bin * (first(_hi) - first(_lo)) / {D(30)}')} as bin_start
from b group by model, bin""")
def q_residual_histogram(spark, sf):
    h = RP.residual_histogram(A.reg_predictions(spark, sf), "y", "yhat", 30, "model")
    return h.withColumn("bin_start", snap(F.col("bin_start")))


@register("best_model", f"""with m as (select model, {ssnap(f'case when var_pop(y) <> 0 then {D(1)} - avg((y - yhat) * (y - yhat)) / var_pop(y) end')} as r2 from {_PRED_R} group by model)
select min(model) as model, max(r2) as r2 from m where r2 = (select max(r2) from m)""")
def q_best_model(spark, sf):
    m = snapped(RP.regression_metrics(A.reg_predictions(spark, sf)))
    return RP.best_model(m, "r2").select("model", "r2")


_OBS_COLUMNS = re.findall(r" as (\w+)(?=,|\n)", re.sub(r"\n\s*as ", " as ", A.OBS_SQL.split("\n  from lineitem")[0]) + "\n") + [
    "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


@register("null_profile", f"""
select column_name, n_rows, n_non_null, n_non_null / n_rows as completeness from (
  select count(*) as n_rows, {', '.join(f"count({c}) as c_{c}" for c in _OBS_COLUMNS)}
  from ({A.OBS_SQL}) o) t
unpivot (n_non_null for column_name in ({', '.join(f"c_{c} as '{c}'" for c in _OBS_COLUMNS)}))""")
def q_null_profile(spark, sf):
    """Completeness of every column."""
    return RP.null_profile(A.obs(spark, sf))


@register("clean_audit", f"""with raw as ({A.METEO_RAW_SQL}),
d as (select distinct * from raw),
c as (select *, date is not null and temperature is not null and humidite is not null as _complete,
  try_cast(trim(temperature) as double) as t, cast(humidite as double) as h from d)
select (select count(*) from raw) as n_raw, (select count(*) from raw) - count(*) as n_duplicates,
  count(*) filter (where not _complete) as n_incomplete,
  count(*) filter (where _complete and not coalesce(h between 0 and 100 and t between -80 and 60, false))
    as n_out_of_range,
  count(*) filter (where _complete and coalesce(h between 0 and 100 and t between -80 and 60, false)) as n_kept
from c""")
def q_clean_audit(spark, sf):
    return RP.clean_audit(A.meteo_raw(spark, sf))


_READ = f"({A.READINGS_SQL}) r"


@register("city_risk_summary", f"""with h as (select city, cast(ts as date) as day, precipitation as predicted_mm,
    case when month in (5,6,7,8,9,10) then 1 else 2 end as severity,
    greatest({D(1)}, case when month in (5,6,7,8,9,10) then {D(3)} else {D(5)} end + (temperature - {D(25)}) * {D(0.2)}
      + ({D(70)} - humidity) * {D(0.05)}) as irrigation_need from {_READ})
select day, count(distinct city) as total_cities,
  array_to_string(coalesce(list_sort(list(distinct city) filter (where predicted_mm > {D(10)})), []), ', ')
    as high_rainfall_cities,
  array_to_string(coalesce(list_sort(list(distinct city) filter (where severity >= 2)), []), ', ')
    as drought_risk_cities,
  array_to_string(coalesce(list_sort(list(distinct city) filter (where irrigation_need > {D(6)})), []), ', ')
    as high_irrigation_need_cities
from h group by day""")
def q_city_risk_summary(spark, sf):
    r = A.readings(spark, sf)
    wet = F.col("month").isin(5, 6, 7, 8, 9, 10)
    h = r.select("city", F.to_date("ts").alias("day"), F.col("precipitation").alias("predicted_mm"),
                 F.when(wet, F.lit(1)).otherwise(F.lit(2)).alias("severity"),
                 F.greatest(F.lit(1.0), F.when(wet, F.lit(3.0)).otherwise(F.lit(5.0))
                            + (F.col("temperature") - F.lit(25.0)) * F.lit(0.2)
                            + (F.lit(70.0) - F.col("humidity")) * F.lit(0.05)).alias("irrigation_need"))
    s = RP.city_risk_summary(h, by="day")
    lists = ["high_rainfall_cities", "drought_risk_cities", "high_irrigation_need_cities"]
    # city lists rendered as text (as the platform displayed them), so results are plain scalars
    return s.drop("n_high_rainfall", "n_drought_risk", "n_high_irrigation_need") \
        .withColumns({c: F.array_join(c, ", ") for c in lists})


_TREND_CITIES = ["Dakar", "Thiès", "Saint-Louis", "Kaolack"]


_TREND_COLS = ", ".join(f"{ssnap(f'avg(precipitation) filter (where city = {chr(39)}{c}{chr(39)})')} as \"{c}\""
                        for c in _TREND_CITIES)


@register("trend_wide", f"""select cast(ts as date) as day, {_TREND_COLS}
from {_READ} group by 1""")
def q_trend_wide(spark, sf):
    r = A.readings(spark, sf).withColumn("day", F.to_date("ts"))
    return snapped(K.trend_wide(r, _TREND_CITIES, "precipitation"))


@register("trend_long", f"""select day, city, {ssnap('avg(precipitation)')} as value from (
  select cast(ts as date) as day, city, precipitation from {_READ} where city in ({', '.join(repr(c) for c in _TREND_CITIES)})) t
group by day, city""")
def q_trend_long(spark, sf):
    r = A.readings(spark, sf).withColumn("day", F.to_date("ts"))
    w = K.trend_wide(r, _TREND_CITIES, "precipitation")
    long = K.trend_long(w, "day", "city", "value").filter(F.col("value").isNotNull())
    return long.withColumn("value", snap(F.col("value")))


@register("regional_trend", f"""with spine as (select cast(unnest(generate_series(DATE '2024-01-30' - INTERVAL 6 DAY,
    DATE '2024-01-30', INTERVAL 1 DAY)) as date) as day),
cs as (select * from spine cross join (values {', '.join(f"('{c}')" for c in _TREND_CITIES)}) v(city)),
daily as (select city, cast(ts as date) as day, avg(precipitation) as precipitation, avg(temperature) as temperature
  from {_READ} where city in ({', '.join(repr(c) for c in _TREND_CITIES)}) group by 1, 2)
select cs.day, cs.city, {ssnap('daily.precipitation')} as precipitation, {ssnap('daily.temperature')} as temperature
from cs left join daily on cs.city = daily.city and cs.day = daily.day""")
def q_regional_trend(spark, sf):
    from agrospark.operators.fill import regional_trend
    t = regional_trend(A.readings(spark, sf), _TREND_CITIES, "2024-01-30", 7)
    return t.select("day", "city", snap(F.col("precipitation")).alias("precipitation"),
                    snap(F.col("temperature")).alias("temperature"))


@register("water_need_compare", f"""{FS.irrigation_chain()},
feat_in as (select region, date, {', '.join(FT.IRRIGATION_FEATURES)}, total_precipitation_sum as _pp from i4),
feat_out as (select * from ({FS.fill_sql('feat_in', list(FT.IRRIGATION_FEATURES), True)}) z),
n as (select region, date, et0, etc, {_need_expr()}
  as irrigation_need from feat_out)
select region, date, metric, {ssnap('value')} as value from (
  select region, date, 'ET0' as metric, et0 as value from n union all
  select region, date, 'ETc', etc from n union all
  select region, date, 'Besoin irrigation', irrigation_need from n) u""")
def q_water_need_compare(spark, sf):
    lab = FT.irrigation_labelled(panel(spark, sf)).select("region", "date", "et0", "etc", "irrigation_need")
    return K.water_need_compare(lab).withColumn("value", snap(F.col("value"))).select("region", "date", "metric",
                                                                                      "value")


@register("city_region_overlap", f"""select c.city, c.n_readings, r.region is not null as in_regions from
  (select city, count(*) as n_readings from {_READ} group by city) c
  left join (select distinct region from {values_sql('regions')}) r on c.city = r.region""")
def q_city_region_overlap(spark, sf):
    from agrospark.dims import dim
    c = A.readings(spark, sf).groupBy("city").agg(F.count(F.lit(1)).alias("n_readings"))
    return K.city_region_overlap(c, dim(spark, "regions")).select("city", "n_readings", "in_regions")


@register("panel_with_weather", f"""{panel_ctes()},
raw as ({A.STATIONS_SQL}),
m as (select ville, date, try_cast(trim(temperature) as double) as temperature, cast(humidite as double) as humidite,
  cast(pluie as double) as pluie from raw),
daily as (select ville as _city, cast(date as date) as _day, avg(temperature) as station_temperature,
  avg(humidite) as station_humidite, avg(pluie) as station_pluie from m group by 1, 2)
select region, date, temperature_2m, {ssnap('station_temperature')} as station_temperature,
  {ssnap('station_humidite')} as station_humidite, {ssnap('station_pluie')} as station_pluie
from panel left join daily on panel.region = daily._city and panel.date = daily._day""")
def q_panel_with_weather(spark, sf):
    from agrospark.operators.clean import METEO_NUMERIC, coerce_numeric
    m = coerce_numeric(A.stations(spark, sf), METEO_NUMERIC)
    j = K.panel_with_weather(panel(spark, sf), m)
    return snapped(j.select("region", "date", "temperature_2m", "station_temperature", "station_humidite",
                            "station_pluie"), keep=("temperature_2m",))


@register("merge_append", f"""with e as (select * from {_READ} where ts < TIMESTAMP '2024-01-20'),
n as (select * from {_READ} where ts >= TIMESTAMP '2024-01-15')
select * from e union all select * from n where reading_id not in (select reading_id from e)""")
def q_merge_append(spark, sf):
    r = A.readings(spark, sf)
    existing = r.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = r.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return K.merge_append(existing, new, ["reading_id"])


@register("impute_mean", f"""{panel_ctes()},
k as (select region, date, case when day % 3 = 0 then null else ssm end as ssm,
  case when day % 4 = 0 then null else ndvi end as ndvi from panel),
m as (select avg(ssm) as ms, avg(ndvi) as mn from k)
select region, date, {ssnap('coalesce(ssm, ms)')} as ssm, {ssnap('coalesce(ndvi, mn)')} as ndvi from k cross join m""")
def q_impute_mean(spark, sf):
    from agrospark.operators.fill import impute_mean
    p = panel(spark, sf).select("region", "date", F.when(F.col("day") % 3 == 0, F.lit(None)).otherwise(F.col("ssm"))
                                .alias("ssm"),
                                F.when(F.col("day") % 4 == 0, F.lit(None)).otherwise(F.col("ndvi")).alias("ndvi"))
    return snapped(impute_mean(p, ["ssm", "ndvi"]))


@register("training_frame", f"""{panel_ctes()},
t as (select region, date, temperature_2m, ssm, lag(total_precipitation_sum, 7) over (partition by region order by date)
  as precipitation_lag_7, coalesce(lead(total_precipitation_sum, 1) over (partition by region order by date),
  {D(0)}) as target from panel)
select * from t where temperature_2m is not null and ssm is not null and precipitation_lag_7 is not null
  and target is not null""")
def q_training_frame(spark, sf):
    from agrospark.operators.windows import lags, rain_target
    p = rain_target(lags(panel(spark, sf), "total_precipitation_sum", (7,)))
    return K.training_frame(p, ["temperature_2m", "ssm", "precipitation_lag_7"], "target")
