"""Registered queries: rules, recommendations, alerts, risk, baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrospark.dims import dim, values_sql
from agrospark.functions.numeric import snap
from agrospark.operators import rules as R
from agrospark.operators.indices import disease_label, drought_label
from agrospark.operators.windows import rain_target
from agrospark.plans import features as FT
from agrospark.plans import features_sql as FS
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_features import _drought_label_sql, snapped
from agrospark.plans.q_panel import panel
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.sources import adapters as A

D = FS.D
W = "partition by region order by date"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def band_sql(x, bands, top, pick):
    whens = " ".join(f"when {x} < {D(b[0])} then {q(b[pick])}" for b in bands)
    return f"case {whens} when {x} is not null then {q(top[pick - 1])} end"


def lookup_sql(x, pairs, default=None):
    whens = " ".join(f"when {x} = {k} then {q(v)}" for k, v in pairs)
    return f"case {whens} else {q(default) if default is not None else 'null'} end"


def list_sql(items):
    return "[" + ", ".join(q(s) for s in items) + "]"


def explode_sql(src, keys, list_expr, out="text"):
    """rows (keys..., pos 0-based, text) of a list expression."""
    k = ", ".join(keys)
    return (f"select {k}, cast(generate_subscripts(_l, 1) - 1 as integer) as pos, unnest(_l) as {out} "
            f"from (select {k}, {list_expr} as _l from {src}) x")


def posexploded(df, keys, arr_col, out="text"):
    return df.select(*keys, F.posexplode(arr_col).alias("pos", out))


_TARGET = f"""{panel_ctes()},
t as (select region, date, coalesce(lead(total_precipitation_sum, 1) over ({W}), {D(0)}) as predicted_mm from panel)"""


def _targets(spark, sf):
    return rain_target(panel(spark, sf), out="predicted_mm").select("region", "date", "predicted_mm")


@register("rain_category", f"""{_TARGET}
select region, date, predicted_mm, {band_sql('predicted_mm', R.RAIN_BANDS, R.RAIN_TOP, 1)} as category,
  {band_sql('predicted_mm', R.RAIN_BANDS, R.RAIN_TOP, 2)} as risk_level,
  least({D(100)}, greatest({D(0)}, {D(100)} - abs(predicted_mm) * {D(10)})) as confidence from t""")
def q_rain_category(spark, sf):
    return R.rain_category(_targets(spark, sf))


def _rain_recs_sql(x):
    whens = " ".join(f"when {x} < {D(b)} then {list_sql(recs)}" for (b, _, _), recs in
                     zip(R.RAIN_BANDS, R.RAIN_RECOMMENDATIONS))
    return f"case {whens} when {x} is not null then {list_sql(R.RAIN_RECOMMENDATIONS[-1])} end"


@register("recommend_rain", f"""{_TARGET}
{explode_sql('t', ['region', 'date'], _rain_recs_sql('predicted_mm'), 'recommendation')}""")
def q_recommend_rain(spark, sf):
    return posexploded(R.recommend_rain(_targets(spark, sf)), ["region", "date"], "recommendations", "recommendation")


_LABELLED = f"{_drought_label_sql()}, lab as (select region, date, drought_class as severity from labelled)"


def _severity(spark, sf):
    return drought_label(panel(spark, sf)).select("region", "date", F.col("drought_class").alias("severity"))


@register("drought_level", f"""{_LABELLED}
select region, date, severity,
  {lookup_sql('severity', [(k, lv) for k, lv, _, _ in R.DROUGHT_LEVELS])} as drought_level,
  {lookup_sql('severity', [(k, r) for k, _, r, _ in R.DROUGHT_LEVELS])} as risk_category,
  {lookup_sql('severity', [(k, c) for k, _, _, c in R.DROUGHT_LEVELS])} as alert_color,
  {lookup_sql('severity', R.DROUGHT_SHORT, R.UNKNOWN)} as risk_short from lab""")
def q_drought_level(spark, sf):
    return R.drought_level(_severity(spark, sf))


def _drought_recs_sql(x):
    recs = (f"case when {x} = 0 then {list_sql(R.DROUGHT_RECOMMENDATIONS[0])} when {x} = 1 then "
            f"{list_sql(R.DROUGHT_RECOMMENDATIONS[1])} when {x} = 2 then {list_sql(R.DROUGHT_RECOMMENDATIONS[2])} "
            f"else {list_sql(R.DROUGHT_RECOMMENDATIONS[3])} end")
    mon = (f"list_concat({list_sql(R.MONITORING_BASE)}, case when {x} >= 1 then {list_sql(R.MONITORING_FROM_1)} "
           f"else []::varchar[] end, case when {x} >= 2 then {list_sql(R.MONITORING_FROM_2)} else []::varchar[] end, "
           f"case when {x} = 3 then {list_sql(R.MONITORING_AT_3)} else []::varchar[] end)")
    return recs, mon


_DR, _MON = _drought_recs_sql("severity")


@register("recommend_drought", f"""{_LABELLED},
a as ({explode_sql('lab', ['region', 'date'], _DR)}),
b as ({explode_sql('lab', ['region', 'date'], _MON)})
select region, date, 'recommendation' as kind, pos, text from a
union all select region, date, 'monitoring' as kind, pos, text from b""")
def q_recommend_drought(spark, sf):
    d = R.recommend_drought(_severity(spark, sf))
    a = posexploded(d, ["region", "date"], "recommendations").withColumn("kind", F.lit("recommendation"))
    b = posexploded(d, ["region", "date"], "monitoring_actions").withColumn("kind", F.lit("monitoring"))
    return a.unionByName(b).select("region", "date", "kind", "pos", "text")


def _irr_frame(spark, sf):
    """Irrigation need with crop, ETc and the inputs of the time-slot rule."""
    from agrospark.operators.indices import assign_crop
    lab = FT.irrigation_labelled(panel(spark, sf))
    crop = assign_crop(lab.select("region", "date")).select("region", "date", "crop_type")
    return lab.select("region", "date", "irrigation_need", "etc", "temp_max", "wind_speed").join(crop,
                                                                                                  ["region", "date"])


def _irr_sql_ctes():
    """Irrigation chain -> filled features -> need, with crop / temp_max / wind for the rules."""
    return f"""{FS.irrigation_chain()},
feat_in as (select region, date, {', '.join(FT.IRRIGATION_FEATURES)}, total_precipitation_sum as _pp from i4),
feat_out as (select * from ({FS.fill_sql('feat_in', list(FT.IRRIGATION_FEATURES), True)}) z),
need as (select region, date, etc, temp_max, wind_speed, {_need_expr()} as irrigation_need from feat_out),
crop as (select region, date, crop_type from i1),
irr as (select need.*, crop.crop_type from need join crop using (region, date))"""


def _need_expr():
    raw = f"(etc - _pp * {D(0.8)} + soil_water_deficit * {D(10)})"
    pos = f"(case when {raw} is not null then greatest({D(0)}, {raw}) end)"
    v = f"({pos} / irrigation_efficiency)"
    return f"case when {v} is not null then least(greatest({v}, {D(0)}), {D(15)}) end"


@register("irrigation_schedule", f"""{_irr_sql_ctes()}
select region, date, {ssnap('irrigation_need')} as irrigation_need,
  {band_sql('irrigation_need', R.IRRIGATION_BANDS, R.IRRIGATION_TOP, 1)} as frequency,
  {band_sql('irrigation_need', R.IRRIGATION_BANDS, R.IRRIGATION_TOP, 2)} as duration from irr""")
def q_irrigation_schedule(spark, sf):
    d = R.irrigation_schedule(_irr_frame(spark, sf))
    return d.select("region", "date", snap(F.col("irrigation_need")).alias("irrigation_need"), "frequency", "duration")


@register("irrigation_score", f"""{_irr_sql_ctes()}
select region, date, case when etc = 0 then 100 else cast(trunc(least({D(100)}, greatest({D(0)},
    {D(100)} - abs(irrigation_need - etc) / etc * {D(50)}))) as integer) end as efficiency_score,
  {ssnap(f'irrigation_need * {D(0.1)}')} as water_cost from irr""")
def q_irrigation_score(spark, sf):
    d = R.irrigation_score(_irr_frame(spark, sf))
    return d.select("region", "date", "efficiency_score", snap(F.col("water_cost")).alias("water_cost"))


def _irr_recs_sql():
    x = "irrigation_need"
    whens = " ".join(f"when {x} < {D(b)} then {list_sql(recs)}" for (b, _, _), recs in
                     zip(R.IRRIGATION_BANDS, R.IRRIGATION_RECOMMENDATIONS))
    base = f"case {whens} else {list_sql(R.IRRIGATION_RECOMMENDATIONS[-1])} end"
    extra = " ".join(f"when crop_type in ({', '.join(q(c) for c in crops)}) then [{q(line)}]"
                     for crops, line in R.CROP_LINES)
    return f"list_concat({base}, case {extra} else []::varchar[] end)"


def _tips_sql():
    return (f"list_concat({list_sql(R.CONSERVATION_BASE)}, case when irrigation_need > {D(5)} then "
            f"{list_sql(R.CONSERVATION_HIGH)} else []::varchar[] end)")


@register("recommend_irrigation", f"""{_irr_sql_ctes()},
a as ({explode_sql('irr', ['region', 'date'], _irr_recs_sql())}),
b as ({explode_sql('irr', ['region', 'date'], _tips_sql())})
select region, date, 'recommendation' as kind, pos, text from a
union all select region, date, 'conservation' as kind, pos, text from b""")
def q_recommend_irrigation(spark, sf):
    d = R.recommend_irrigation(_irr_frame(spark, sf))
    a = posexploded(d, ["region", "date"], "recommendations").withColumn("kind", F.lit("recommendation"))
    b = posexploded(d, ["region", "date"], "conservation_tips").withColumn("kind", F.lit("conservation"))
    return a.unionByName(b).select("region", "date", "kind", "pos", "text")


@register("irrigation_times", f"""{_irr_sql_ctes()},
tt as (select region, date, coalesce(temp_max, {D(35)}) as t, coalesce(wind_speed, {D(2)}) as w from irr)
{explode_sql('tt', ['region', 'date'], f"list_concat([case when t > 30 then {q(R.TIME_EARLY_HOT)} else {q(R.TIME_EARLY)} end], case when t > 35 or w > 5 then [{q(R.TIME_EVENING)}] else []::varchar[] end)", 'slot')}""")
def q_irrigation_times(spark, sf):
    d = R.irrigation_times(_irr_frame(spark, sf))
    return posexploded(d, ["region", "date"], "best_times", "slot")


_READ = f"({A.READINGS_SQL}) r"
_COND_SQL = f"""select reading_id, city, temperature, humidity,
  case when month in (6,7,8,9,10) then 'Wet' else 'Dry' end as season from {_READ}"""


def _conditions(spark, sf):
    r = A.readings(spark, sf)
    return r.select("reading_id", "city", "temperature", "humidity",
                    F.when(F.col("month").isin(6, 7, 8, 9, 10), F.lit("Wet")).otherwise(F.lit("Dry")).alias("season"))


@register("disease_rules", f"""with c as ({_COND_SQL}),
j as (select c.reading_id, c.city, r.crop, r.disease,
  case when (temperature between temp_min and temp_max) and humidity >= humidity_min and season = risk_season then 2
       when ((temperature between temp_min and temp_max) and humidity >= humidity_min)
         or ((temperature between temp_min and temp_max) and season = risk_season) then 1 else 0 end as lvl
  from c cross join {values_sql('disease_rules', 'r')}),
g as (select reading_id, city, crop, max(lvl) as risk_level,
  list_sort(list(disease) filter (where lvl = 2)) as hi, list_sort(list(disease) filter (where lvl = 1)) as med,
  count(*) as n_diseases from j group by reading_id, city, crop)
select reading_id, city, crop, risk_level,
  case when risk_level = 2 then {q(R.RISK_NAMES[0])} when risk_level = 1 then {q(R.RISK_NAMES[1])}
    else {q(R.RISK_NAMES[2])} end as risk_name,
  case when risk_level = 2 then array_to_string(hi, ', ') when risk_level = 1 then array_to_string(med, ', ')
    else '' end as diseases, n_diseases from g""")
def q_disease_rules(spark, sf):
    d = R.disease_rules(_conditions(spark, sf), key=("reading_id", "city"))
    return d.withColumn("diseases", F.array_join("diseases", ", "))


_DISEASE_LAB = f"""{panel_ctes()},
dq as (select quantile_cont(ssm, 0.7) as qa, quantile_cont(total_precipitation_sum, 0.6) as qb,
        quantile_cont(surface_solar_radiation_downwards_sum, 0.4) as qc from panel),
ds as (select panel.region, panel.date, (case when coalesce(ssm > qa, false) then {D(0.4)} else {D(0)} end)
    + (case when coalesce(temperature_2m between 20 and 32, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(total_precipitation_sum > qb, false) then {D(0.2)} else {D(0)} end)
    + (case when coalesce(surface_solar_radiation_downwards_sum < qc, false) then {D(0.1)} else {D(0)} end)
    as disease_score from panel cross join dq),
dl as (select region, date, case when disease_score <= {D(0.3)} then 0 when disease_score <= {D(0.6)} then 1
    when disease_score <= {D(0.8)} then 2 else 3 end as disease_class from ds)"""


@register("disease_advice", f"""{_DISEASE_LAB},
dx as (select region, date, disease_class, case when disease_class in (0,1,2,3) then disease_class else 0 end as k
  from dl)
select region, date, disease_class,
  {lookup_sql('k', [(k, lv) for k, lv, _, _ in R.DISEASE_LEVELS])} as overall_risk_level,
  {lookup_sql('k', [(k, c) for k, _, c, _ in R.DISEASE_LEVELS])} as alert_color,
  {lookup_sql('k', [(k, a) for k, _, _, a in R.DISEASE_LEVELS])} as recommended_action,
  case when disease_class = 0 then {q(R.DISEASE_MONITORING[0])} else {q(R.DISEASE_MONITORING[1])} end
    as monitoring_frequency,
  {q(R.DISEASE_FOCUS)} as monitoring_focus,
  case when disease_class < 2 then {q(R.DISEASE_TREATMENT[0])} else {q(R.DISEASE_TREATMENT[1])} end as treatment,
  {lookup_sql('disease_class', [(k, lv) for k, lv, _, _ in R.DISEASE_LEVELS], R.UNKNOWN)} as risk_short
from dx""")
def q_disease_advice(spark, sf):
    d = disease_label(panel(spark, sf), stored=True).select("region", "date", "disease_class")
    return R.disease_advice(d).drop("prevention_measures")


_NORM_CITIES = "('Dakar', 'Thiès', 'Saint-Louis', 'Kaolack', 'Ziguinchor', 'Tambacounda')"
_NORMS_JOIN = f"""left join {values_sql('seasonal_norms')}
  on (case when r.city in {_NORM_CITIES} then r.city else 'Dakar' end) = seasonal_norms.city
  and r.month = seasonal_norms.month"""


@register("seasonal_norms", f"""select r.reading_id, r.city, r.month, temp_min, temp_max, hum_min, hum_max, precip_avg,
  seasonal_norms.season as norm_season from {_READ} {_NORMS_JOIN}""")
def q_seasonal_norms(spark, sf):
    r = A.readings(spark, sf).select("reading_id", "city", "month")
    return R.seasonal_norms(r)


def _fmt1_sql(x):
    return f"cast(floor({x} * {D(10)} + 0.5) / {D(10)} as varchar)"


_CURRENT = f"""cur0 as (select city, arg_max(struct_pack(reading_id := reading_id, ts := ts, month := month,
    temperature := temperature, humidity := humidity, wind_speed := wind_speed), struct_pack(a := ts, b := reading_id))
    as s from {_READ} group by city),
cur as (select cur0.city, pc.city_rank, s.reading_id as reading_id, s.ts as ts, s.month as month,
    s.temperature as temperature, s.humidity as humidity, s.wind_speed as wind_speed
  from cur0 join {values_sql('provider_cities', 'pc')} on cur0.city = pc.city),
cn as (select r.*, temp_max, hum_min from cur r {_NORMS_JOIN}),
al as (select city, city_rank, reading_id, ts, 0 as rule_rank, {q(R.ALERT_RULES[0][1])} as type,
    {q(R.ALERT_RULES[0][2])} as level,
    concat({q(R.ALERT_RULES[0][3])}, {_fmt1_sql('temperature')}, {q(R.ALERT_RULES[0][4])}) as message
    from cn where temperature > temp_max + {D(3)}
  union all select city, city_rank, reading_id, ts, 1, {q(R.ALERT_RULES[1][1])}, {q(R.ALERT_RULES[1][2])},
    concat({q(R.ALERT_RULES[1][3])}, case when humidity = floor(humidity) then cast(cast(humidity as bigint) as varchar) else cast(humidity as varchar) end, {q(R.ALERT_RULES[1][4])})
    from cn where humidity < hum_min - {D(10)}
  union all select city, city_rank, reading_id, ts, 2, {q(R.ALERT_RULES[2][1])}, {q(R.ALERT_RULES[2][2])},
    concat({q(R.ALERT_RULES[2][3])}, {_fmt1_sql('wind_speed')}, {q(R.ALERT_RULES[2][4])})
    from cn where wind_speed > {D(10)})"""


@register("daily_alerts", f"""with {_CURRENT.replace(_READ, f'({A.EXTREME_SQL}) r')}
select * from al order by city_rank, rule_rank limit 3""")
def q_daily_alerts(spark, sf):
    return R.daily_alerts(A.extreme_readings(spark, sf), limit=3)


@register("alerts_all", f"""with cn as (select r.*, temp_max, hum_min from {_READ} {_NORMS_JOIN}),
al as (select city, reading_id, ts, 0 as rule_rank, {q(R.ALERT_RULES[0][1])} as type, {q(R.ALERT_RULES[0][2])} as level,
    concat({q(R.ALERT_RULES[0][3])}, {_fmt1_sql('temperature')}, {q(R.ALERT_RULES[0][4])}) as message
    from cn where temperature > temp_max + {D(3)}
  union all select city, reading_id, ts, 1, {q(R.ALERT_RULES[1][1])}, {q(R.ALERT_RULES[1][2])},
    concat({q(R.ALERT_RULES[1][3])}, case when humidity = floor(humidity) then cast(cast(humidity as bigint) as varchar) else cast(humidity as varchar) end, {q(R.ALERT_RULES[1][4])})
    from cn where humidity < hum_min - {D(10)}
  union all select city, reading_id, ts, 2, {q(R.ALERT_RULES[2][1])}, {q(R.ALERT_RULES[2][2])},
    concat({q(R.ALERT_RULES[2][3])}, {_fmt1_sql('wind_speed')}, {q(R.ALERT_RULES[2][4])})
    from cn where wind_speed > {D(10)})
select * from al""")
def q_alerts_all(spark, sf):
    """Every reading's alerts (no top-k): the batch twin of the streaming alert job."""
    r = R.seasonal_norms(A.readings(spark, sf))
    return R.alert_rows(r)


@register("fallback_weather", f"""select r.reading_id, r.city, r.ts, r.month,
  coalesce(case when r.reading_id % 7 = 0 then null else r.temperature end, (temp_min + temp_max) / {D(2)})
    as temperature,
  coalesce(case when r.reading_id % 5 = 0 then null else r.humidity end, (hum_min + hum_max) / {D(2)}) as humidity,
  coalesce(case when r.reading_id % 11 = 0 then null else r.pressure end, {D(1013)}) as pressure,
  coalesce(case when r.reading_id % 13 = 0 then null else r.wind_speed end, {D(3)}) as wind_speed
from {_READ} {_NORMS_JOIN}""")
def q_fallback_weather(spark, sf):
    from agrospark.operators.fill import fallback_weather
    r = A.readings(spark, sf)
    rid = F.col("reading_id")
    gappy = r.select("reading_id", "city", "ts", "month",
                     F.when(rid % 7 == 0, F.lit(None)).otherwise(F.col("temperature")).alias("temperature"),
                     F.when(rid % 5 == 0, F.lit(None)).otherwise(F.col("humidity")).alias("humidity"),
                     F.when(rid % 11 == 0, F.lit(None)).otherwise(F.col("pressure")).alias("pressure"),
                     F.when(rid % 13 == 0, F.lit(None)).otherwise(F.col("wind_speed")).alias("wind_speed"))
    return fallback_weather(gappy, dim(spark, "seasonal_norms"))


def _global_risk_sql():
    dis = _DISEASE_LAB[len(panel_ctes()):]   # the disease CTEs that follow the panel chain
    return f"""{_drought_label_sql()}{dis},
t as (select region, date, coalesce(lead(total_precipitation_sum, 1) over ({W}), {D(0)}) as predicted_mm from panel),
gc as (select t.region, t.date, t.predicted_mm, cast(l.drought_class as double) as sev,
    cast(dl.disease_class as double) as dis
  from t join labelled l using (region, date) join dl using (region, date)),
gs as (select *, case when predicted_mm > {D(15)} then {D(3)} when predicted_mm < {D(1)} then {D(1)} end as rs from gc),
gm as (select *, ({D(0)} + coalesce(rs, {D(0)}) + coalesce(sev, {D(0)}) + coalesce(dis, {D(0)}))
    / cast((case when rs is null then 0 else 1 end) + (case when sev is null then 0 else 1 end)
           + (case when dis is null then 0 else 1 end) as double) as risk_mean from gs)
select region, date, risk_mean,
  case when risk_mean >= 2.5 then {q(R.GLOBAL_RISK_BANDS[0][1])} when risk_mean >= 1.5 then {q(R.GLOBAL_RISK_BANDS[1][1])}
    when risk_mean >= 0.5 then {q(R.GLOBAL_RISK_BANDS[2][1])} else {q(R.GLOBAL_RISK_LOW)} end as global_risk,
  concat_ws(' | ',
    case when predicted_mm > 15 then {q(R.GLOBAL_ALERTS['rain_high'])} when predicted_mm < 1
      then {q(R.GLOBAL_ALERTS['rain_low'])} end,
    case when sev >= 2 then concat({q(R.GLOBAL_ALERTS['drought'])},
      {lookup_sql('cast(sev as integer)', [(k, lv) for k, lv, _, _ in R.DROUGHT_LEVELS], '')}) end,
    case when dis >= 2 then concat({q(R.GLOBAL_ALERTS['disease'])},
      {lookup_sql('cast(dis as integer)', [(k, lv) for k, lv, _, _ in R.DISEASE_LEVELS], '')}) end) as alerts
from gm"""


@register("global_risk", _global_risk_sql())
def q_global_risk(spark, sf):
    p = panel(spark, sf)
    t = rain_target(p, out="predicted_mm").select("region", "date", "predicted_mm")
    dr = drought_label(p).select("region", "date", F.col("drought_class").alias("severity"))
    di = disease_label(p, stored=True).select("region", "date", "disease_class")
    c = t.join(dr, ["region", "date"]).join(di, ["region", "date"])
    g = R.global_risk(c)
    return g.select("region", "date", "risk_mean", "global_risk", F.array_join("alerts", " | ").alias("alerts"))


_SEASON5 = "case when month in (5,6,7,8,9,10) then 'Wet' else 'Dry' end"


@register("heuristic_predictions", f"""with r as (select reading_id, city, temperature, humidity, {_SEASON5} as season
  from {_READ}),
p as (select r.*, sp.ssm_mean as soil_moisture from r left join {values_sql('season_params', 'sp')}
  on r.season = sp.season),
h as (select *, case when season = 'Dry' then {D(5)} else {D(3)} end + (temperature - {D(25)}) * {D(0.2)}
    + ({D(70)} - humidity) * {D(0.05)} as _n from p)
select reading_id, city, season, soil_moisture, case when season = 'Dry' then {D(0.5)} else {D(3)} end as predicted_mm,
  case when season = 'Dry' and soil_moisture < {D(0.3)} then 2 else 1 end as severity,
  {ssnap(f'case when _n is not null then greatest({D(1)}, _n) end')} as irrigation_need from h""")
def q_heuristic_predictions(spark, sf):
    r = A.readings(spark, sf)
    r = r.select("reading_id", "city", "temperature", "humidity",
                 F.when(F.col("month").isin(list(R.EMPIRICAL_WET_MONTHS)), F.lit("Wet")).otherwise(F.lit("Dry"))
                 .alias("season"))
    sp = dim(spark, "season_params").select(F.col("season").alias("_s"), F.col("ssm_mean").alias("soil_moisture"))
    r = r.join(sp, F.col("season") == F.col("_s"), "left").drop("_s")
    h = R.heuristic_predictions(r)
    return h.select("reading_id", "city", "season", "soil_moisture", "predicted_mm", "severity",
                    snap(F.col("irrigation_need")).alias("irrigation_need"))


@register("condition_flags", f"""with r as (select reading_id, temperature, humidity / {D(100)} * {D(0.8)} as sm
  from {_READ}), c as (select reading_id, coalesce(sm, {D(0.6)}) as s, coalesce(temperature, {D(25)}) as t from r)
select reading_id, cast(s > 0.7 and t between 20 and 30 as integer) as fungal_conditions,
  cast(s > 0.8 and t > 25 as integer) as bacterial_conditions,
  cast(t between 25 and 35 and s between 0.4 and 0.8 as integer) as viral_conditions,
  {ssnap(f'abs(t - {D(25)}) / {D(10)}')} as thermal_stress from c""")
def q_condition_flags(spark, sf):
    r = A.readings(spark, sf).select("reading_id", "temperature",
                                     (F.col("humidity") / F.lit(100.0) * F.lit(0.8)).alias("soil_moisture"))
    d = R.condition_flags(r)
    return d.select("reading_id", "fungal_conditions", "bacterial_conditions", "viral_conditions",
                    snap(F.col("thermal_stress")).alias("thermal_stress"))


@register("equal_width_bins", f"""{panel_ctes()}, st as ({FS.stats_sql()}),
st2 as (select avg(ssm) as m_ssm, stddev_samp(ssm) as s_ssm from panel),
sc as (select region, date, {FS.z('temperature_2m')} - {FS.z('ssm')} as score from panel cross join st cross join st2),
mm as (select min(score) as mn, max(score) as mx from sc)
select region, date, {ssnap('score')} as score, case when score is not null then
  {' + '.join(f"(case when score > mn + {D(k)} * ((mx - mn) / {D(4)}) then 1 else 0 end)" for k in (1, 2, 3))} end as bin
from sc cross join mm""")
def q_equal_width_bins(spark, sf):
    from agrospark.operators.stats import index_stats, with_stats, zscore
    p = panel(spark, sf)
    st = index_stats(p, ["temperature_2m", "ssm"])
    j = with_stats(p, st)
    sc = j.select("region", "date", (zscore(F.col("temperature_2m"), F.col("temperature_2m_mean"),
                                            F.col("temperature_2m_std"))
                                     - zscore(F.col("ssm"), F.col("ssm_mean"), F.col("ssm_std"))).alias("score"))
    b = R.equal_width_bins(sc, "score", 4)
    return b.select("region", "date", snap(F.col("score")).alias("score"), "bin")


def _baseline_input(spark, sf):
    r = A.readings(spark, sf)
    return r.select("city", F.to_date("ts").alias("date")).distinct()


_BASE_SQL = f"""with cd as (select distinct city, cast(ts as date) as date from {_READ}),
s as (select cd.*, {_SEASON5.replace('month', 'month(date)')} as season from cd),
j as (select s.*, ca.d_temp, ca.d_humidity, sp.ndvi_mean, sp.ssm_mean from s
  left join {values_sql('city_adjust', 'ca')} on s.city = ca.city
  left join {values_sql('season_params', 'sp')} on s.season = sp.season),
b as (select city, date, season,
  case when season = 'Dry' then {D(R.BASELINE_TEMP['Dry'])} else {D(R.BASELINE_TEMP['Wet'])} end
    + cast(coalesce(d_temp, 0) as double) as temperature,
  greatest({D(20)}, least({D(100)}, case when season = 'Dry' then {D(R.BASELINE_HUMIDITY['Dry'])}
    else {D(R.BASELINE_HUMIDITY['Wet'])} end + cast(coalesce(d_humidity, 0) as double))) as humidity,
  {D(R.BASELINE_PRESSURE)} as pressure, {D(R.BASELINE_WIND + 1.0)} as wind_speed,
  greatest({D(0.1)}, least({D(1)}, ndvi_mean)) as ndvi, greatest({D(0.1)}, least({D(1)}, ssm_mean)) as soil_moisture,
  greatest({D(10)}, {D(20)} + {D(5)} * sin(cast(6.283185307179586 as double) * month(date) / {D(12)}))
    as solar_radiation,
  case when season = 'Dry' then {D(0)} else {D(10)} end as precipitation_7d,
  case when season = 'Dry' then {D(2)} else {D(12)} end as leaf_wetness,
  greatest({D(0.1)}, least({D(1)}, ndvi_mean)) * {D(0.8)} as evi, 'mil' as crop_type from j),
g as (select b.*, cast(least(180, greatest(1, (case when month(date) >= planting_month then month(date) - planting_month
    else 12 - planting_month + month(date) end) * 30 + day(date))) as integer) as growth_stage
  from b left join {values_sql('crop_calendar', 'cc')} on b.crop_type = cc.crop)"""


@register("seasonal_baseline", f"""{_BASE_SQL}
select city, date, season, temperature, humidity, pressure, wind_speed, ndvi, soil_moisture,
  {ssnap('solar_radiation')} as solar_radiation, precipitation_7d, leaf_wetness, {ssnap('evi')} as evi, crop_type,
  growth_stage from g""")
def q_seasonal_baseline(spark, sf):
    b = R.seasonal_baseline(_baseline_input(spark, sf))
    return b.select("city", "date", "season", "temperature", "humidity", "pressure", "wind_speed", "ndvi",
                    "soil_moisture", snap(F.col("solar_radiation")).alias("solar_radiation"), "precipitation_7d",
                    "leaf_wetness", snap(F.col("evi")).alias("evi"), "crop_type", "growth_stage")


def _serving_sql(features):
    """SQL twin of ``rules.serving_features`` for readings with temperature, humidity, wind and rain
    (every other input takes its default), same operation order."""
    dv = R.SERVING_DEFAULTS
    temp = f"coalesce(temperature, {D(dv['temperature'])})"
    precip = f"coalesce(precipitation, {D(dv['precipitation'])})"
    wind = f"coalesce(wind_speed, {D(dv['wind_speed'])})"
    hum = f"coalesce(humidity, {D(dv['humidity'])})"
    ndvi, evi, sm, p7 = D(dv["ndvi"]), D(dv["evi"]), D(dv["soil_moisture"]), D(dv["precipitation_7d"])
    tmax, tmin = temp, f"({temp} - {D(8)})"
    ssm = f"({hum} / {D(100)} * {D(0.8)})"
    two_pi = "cast(6.283185307179586 as double)"
    e = {
        "temperature_2m": temp, "total_precipitation_sum": precip,
        "surface_solar_radiation_downwards_sum": f"{D(dv['solar_radiation'])} * {D(1000000)}",
        "u_component_of_wind_10m": f"{wind} * {D(0.7)}", "v_component_of_wind_10m": f"{wind} * {D(0.3)}",
        "lst_day_1km": f"{tmax} * {D(100)}", "lst_night_1km": f"{tmin} * {D(100)}",
        "temp_day_celsius": tmax, "temp_night_celsius": tmin, "evi": evi, "ndvi": ndvi,
        "ndvi_normalized": ndvi, "evi_normalized": evi, "ssm": ssm,
        "month_sin": f"sin({two_pi} * month(date) / {D(12)})", "month_cos": f"cos({two_pi} * month(date) / {D(12)})",
        "is_dry_season": "0", "is_wet_season": "1", "day_of_year": "dayofyear(date)", "wind_speed": wind, "temp_max": tmax, "temp_min": tmin,
        "day_sin": f"sin({two_pi} * dayofyear(date) / {D(365)})", "day_cos": f"cos({two_pi} * dayofyear(date) / {D(365)})",
        "temp_range": f"({tmax} - {tmin})", "temp_variation": f"({tmax} - {tmin})", "vegetation_health": f"({ndvi} + {evi}) / {D(2)}",
        "temp_humidity_index": f"{temp} * {sm}", "leaf_wetness_duration": D(dv["leaf_wetness"]), "thermal_stress": f"abs({temp} - {D(25)}) / {D(10)}",
        "water_stress": f"greatest({D(0)}, {D(0.4)} - {sm})", "soil_water_deficit": f"greatest({D(0)}, {D(0.4)} - {sm})", "vegetation_density": ndvi,
        "vegetation_stress": f"{D(1)} - {ndvi}", "growth_stage": D(dv["growth_stage"]), "irrigation_efficiency": D(0.8), "et0": D(5), "etc": D(6),
        "fungal_conditions": f"case when {sm} > {D(0.7)} and {temp} between 20 and 30 then 1 else 0 end",
        "bacterial_conditions": f"case when {sm} > {D(0.8)} and {temp} > 25 then 1 else 0 end",
        "viral_conditions": f"case when {temp} between 25 and 35 and {sm} between {D(0.4)} and {D(0.8)} then 1 else 0 end",
        "consecutive_fungal_days": "0", "crop_mil": "1",
        "water_stress_index": f"({temp} - {D(25)}) / {D(10)} - ({ndvi} - {D(0.5)}) / {D(0.3)}",
        "meteorological_drought_index": f"({temp} - {D(25)}) / {D(10)} - ({precip} - {D(2)}) / {D(5)}",
        "agricultural_drought_index": f"({D(1)} - {sm}) * ({D(1)} - {ndvi})",
        "consecutive_dry_days": f"case when {p7} > 1 then 0 else 3 end",
    }
    for w in (3, 7, 14, 15, 30):
        e[f"leaf_wetness_ma_{w}"], e[f"et0_ma_{w}"], e[f"humidity_ma_{w}"] = D(dv["leaf_wetness"]), D(5), ssm
        e.update({f"temp_ma_{w}": temp, f"precip_ma_{w}": precip, f"ssm_ma_{w}": ssm, f"ndvi_ma_{w}": ndvi,
                  f"temp_deviation_{w}": D(0), f"precip_deviation_{w}": D(0), f"ndvi_deviation_{w}": D(0)})
    for p in (1, 3, 7, 14, 15, 30, 60):
        e[f"precip_cumul_{p}"] = f"{p7} * ({D(p)} / {D(7)})"
    cols = ", ".join(f"{ssnap(f'cast({e.get(f, D(0))} as double)')} as {f}" for f in features)
    return f"""select reading_id, city, cast(ts as date) as date, {cols} from {_READ}"""


#: the names of all four models, and the other inputs that a model may ask for
SERVING_LIST = list(dict.fromkeys([
    *FT.RAINFALL_FEATURES, *FT.DROUGHT_FEATURES, *FT.IRRIGATION_FEATURES, *FT.DISEASE_FEATURES, "temp_humidity_index", "leaf_wetness_duration", "thermal_stress",
    "water_stress", "vegetation_density", "temp_variation", "fungal_conditions", "bacterial_conditions", "viral_conditions", "consecutive_fungal_days",
    *[f"leaf_wetness_ma_{w}" for w in (3, 7, 14, 15, 30)]]))


@register("serving_features", _serving_sql(SERVING_LIST))
def q_serving_features(spark, sf):
    """Model inputs of all four feature lists, from each reading."""
    r = A.readings(spark, sf).select("reading_id", "city", F.to_date("ts").alias("date"), "temperature", "humidity",
                                     "wind_speed", "precipitation")
    return snapped(R.serving_features(r, SERVING_LIST))


@register("serving_history", f"""with base as ({_serving_sql(FT.DROUGHT_FEATURES)}), hist as ({FS.drought_sql()}),
f as ({A.FIELD_SQL}),
m as (select f.reading_id, f.region, f.as_of_day, h.date as as_of, h.* exclude (region, date) from f asof left join hist h on f.region = h.region and f.as_of_day >= h.date)
select m.reading_id, m.region, cast(m.as_of as varchar) as as_of, {', '.join(f"coalesce(cast(m.{c} as double), base.{c}) as {c}" for c in FT.DROUGHT_FEATURES)}
from m join base using (reading_id)""")
def q_serving_history(spark, sf):
    """The drought model's inputs of every reading: the features of its region's latest day up to the reading's, its own values before the first."""
    r = A.field_readings(spark, sf).select("reading_id", "region", "date", "as_of_day", "temperature", "humidity", "wind_speed", "precipitation")
    got = R.serving_features(r, FT.DROUGHT_FEATURES, history=FT.drought_features(panel(spark, sf)), as_of="as_of_day")
    return got.select("reading_id", "region", F.col("as_of").cast("string").alias("as_of"), *[snap(F.col(c)).alias(c) for c in FT.DROUGHT_FEATURES])


@register("score_all_cities", f"""with {_CURRENT},
bs as (select c.city, c.city_rank, c.temperature, c.humidity,
    case when month(cast(c.ts as date)) in (5,6,7,8,9,10) then 'Wet' else 'Dry' end as season from cur c),
bp as (select bs.*, sp.ssm_mean as soil_moisture from bs left join {values_sql('season_params', 'sp')}
    on bs.season = sp.season),
h as (select *, case when season = 'Dry' then {D(0.5)} else {D(3)} end as predicted_mm,
    case when season = 'Dry' and soil_moisture < {D(0.3)} then 2 else 1 end as severity,
    case when (case when season = 'Dry' then {D(5)} else {D(3)} end + (temperature - {D(25)}) * {D(0.2)}
      + ({D(70)} - humidity) * {D(0.05)}) is not null then greatest({D(1)}, case when season = 'Dry' then {D(5)}
      else {D(3)} end + (temperature - {D(25)}) * {D(0.2)} + ({D(70)} - humidity) * {D(0.05)}) end as irrigation_need
  from bp)
select city, city_rank, season, predicted_mm, {band_sql('predicted_mm', R.RAIN_BANDS, R.RAIN_TOP, 1)} as category,
  severity, {lookup_sql('severity', R.DROUGHT_SHORT, R.UNKNOWN)} as risk_short, {ssnap('irrigation_need')}
  as irrigation_need, {band_sql('irrigation_need', R.IRRIGATION_BANDS, R.IRRIGATION_TOP, 1)} as frequency from h""")
def q_score_all_cities(spark, sf):
    from agrospark.plans.scoring import score_all_cities
    d = score_all_cities(A.readings(spark, sf))
    return d.select("city", "city_rank", "season", "predicted_mm", "category", "severity", "risk_short",
                    snap(F.col("irrigation_need")).alias("irrigation_need"), "frequency")


@register("irrigation_page_plan", f"""{_irr_sql_ctes()}
select region, date, {ssnap('irrigation_need')} as irrigation_need,
  case when irrigation_need is not null then case when irrigation_need > {D(R.PAGE_THRESHOLD)}
    then {q(R.PAGE_HIGH[0])} else {q(R.PAGE_LOW[0])} end end as page_frequency,
  case when irrigation_need is not null then case when irrigation_need > {D(R.PAGE_THRESHOLD)}
    then {q(R.PAGE_HIGH[1])} else {q(R.PAGE_LOW[1])} end end as page_duration,
  {ssnap(f'irrigation_need * {D(R.PAGE_ETC_FACTOR)}')} as page_etc,
  {ssnap(f'irrigation_need * {D(R.PAGE_ET0_FACTOR)}')} as page_et0 from irr""")
def q_irrigation_page_plan(spark, sf):
    d = R.irrigation_page_plan(_irr_frame(spark, sf))
    return d.select("region", "date", snap(F.col("irrigation_need")).alias("irrigation_need"), "page_frequency",
                    "page_duration", snap(F.col("page_etc")).alias("page_etc"),
                    snap(F.col("page_et0")).alias("page_et0"))


def _advice_sql():
    lvl = " ".join(f"when irrigation_need > {D(lo)} then {q(name)}" for lo, name, _ in R.ADVICE_BANDS)
    plan = " ".join(f"when irrigation_need > {D(lo)} then {list_sql(lines)}" for lo, _, lines in R.ADVICE_BANDS)
    return (f"case {lvl} when irrigation_need is not null then {q(R.ADVICE_LOW[0])} end",
            f"case {plan} when irrigation_need is not null then {list_sql(R.ADVICE_LOW[1])} end")


_ADV_LVL, _ADV_PLAN = _advice_sql()


@register("irrigation_advice", f"""{_irr_sql_ctes()},
adv as (select region, date, {_ADV_LVL} as need_level, {_ADV_PLAN} as plan from irr)
select region, date, need_level, cast(generate_subscripts(plan, 1) - 1 as integer) as pos, unnest(plan) as text
from adv""")
def q_irrigation_advice(spark, sf):
    d = R.irrigation_advice(_irr_frame(spark, sf))
    return d.select("region", "date", "need_level", F.posexplode("plan").alias("pos", "text"))


@register("fallback_forecast", f"""with c as (select distinct city from {_READ}),
s as (select city, cast(unnest(generate_series(DATE '2024-01-30', DATE '2024-01-30' + INTERVAL 6 DAY,
    INTERVAL 1 DAY)) as date) as day from c)
select s.city, s.day, (temp_min + temp_max) / {D(2)} as temperature, (hum_min + hum_max) / {D(2)} as humidity,
  {D(1013)} as pressure, {D(3)} as wind_speed, precip_avg as precipitation, {D(30)} as cloudiness
from s left join {values_sql('seasonal_norms')}
  on (case when s.city in {_NORM_CITIES} then s.city else 'Dakar' end) = seasonal_norms.city
  and month(s.day) = seasonal_norms.month""")
def q_fallback_forecast(spark, sf):
    from agrospark.operators.fill import fallback_forecast
    return fallback_forecast(A.readings(spark, sf).select("city"), "2024-01-30", 7)
