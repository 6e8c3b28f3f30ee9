"""Rule layer: categories, recommendations, alerts, global risk, serving features.

Everything is a column expression over scored rows (``when`` chains, arrays built by rule), or a
broadcast join to a fixed dimension. Arrays can be exploded with ``posexplode`` for row form.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.dims import CROPS, DISEASE_RULES, NORM_DEFAULT_CITY, dim

# ---------------------------------------------------------------- FIXED VALUES (begin)
# labels and texts shown to users; they must equal the platform's wording

RAIN_BANDS = [  # upper bound (exclusive), category, risk
    (1.0, "Pas de pluie", "Faible"),
    (5.0, "Pluie légère", "Modéré"),
    (15.0, "Pluie modérée", "Élevé"),
]
RAIN_TOP = ("Pluie forte", "Très élevé")

RAIN_RECOMMENDATIONS = [
    ["Prévoir l'irrigation des cultures", "Surveiller l'humidité du sol", "Protéger les jeunes plants du soleil"],
    ["Réduire l'irrigation prévue", "Préparer les systèmes de drainage légers"],
    ["Suspendre l'irrigation", "Vérifier les systèmes de drainage", "Protéger les cultures sensibles"],
    ["Arrêter toute irrigation", "Activer les systèmes de drainage", "Protéger les cultures contre l'excès d'eau",
     "Reporter les activités agricoles en extérieur"],
]

DROUGHT_LEVELS = [  # severity, level, risk, colour
    (0, "Pas de sécheresse", "Faible", "green"),
    (1, "Sécheresse légère", "Modéré", "yellow"),
    (2, "Sécheresse modérée", "Élevé", "orange"),
    (3, "Sécheresse sévère", "Critique", "red"),
]
DROUGHT_SHORT = [(0, "Aucun"), (1, "Léger"), (2, "Modéré"), (3, "Sévère")]
UNKNOWN = "Inconnu"

DROUGHT_RECOMMENDATIONS = [
    ["Maintenir les pratiques d'irrigation normales", "Surveiller les indicateurs météorologiques",
     "Préparer les plans de gestion de l'eau"],
    ["Optimiser l'efficacité de l'irrigation", "Surveiller l'humidité du sol quotidiennement",
     "Considérer des cultures résistantes à la sécheresse", "Réduire les pertes d'eau par évaporation"],
    ["Implémenter des mesures d'économie d'eau strictes", "Prioriser l'irrigation des cultures les plus sensibles",
     "Utiliser du paillis pour conserver l'humidité", "Considérer l'irrigation goutte-à-goutte",
     "Reporter les nouvelles plantations"],
    ["Activer les protocoles d'urgence pour la sécheresse", "Rationner l'eau d'irrigation",
     "Récolter prématurément si nécessaire", "Protéger les cultures permanentes prioritaires",
     "Chercher des sources d'eau alternatives", "Considérer l'assurance récolte"],
]
MONITORING_BASE = ["Surveiller les prévisions météorologiques à 7 jours", "Mesurer l'humidité du sol quotidiennement"]
MONITORING_FROM_1 = ["Surveiller l'état de la végétation via satellite", "Mesurer les niveaux des réservoirs d'eau"]
MONITORING_FROM_2 = ["Surveillance quotidienne des cultures sensibles", "Coordination avec les autorités locales"]
MONITORING_AT_3 = ["Surveillance continue 24h/24", "Activation du comité de crise sécheresse"]

IRRIGATION_BANDS = [  # upper bound (exclusive), frequency, duration
    (2.0, "Tous les 3-4 jours", "15-30 minutes"),
    (5.0, "Tous les 2 jours", "30-45 minutes"),
    (8.0, "Quotidienne", "45-60 minutes"),
]
IRRIGATION_TOP = ("2 fois par jour", "30-45 minutes par session")
IRRIGATION_RECOMMENDATIONS = [
    ["Irrigation légère suffisante", "Surveiller l'humidité du sol",
     "Profiter des conditions favorables pour économiser l'eau"],
    ["Irrigation modérée recommandée", "Utiliser l'irrigation goutte-à-goutte si possible",
     "Vérifier l'uniformité de distribution"],
    ["Irrigation intensive nécessaire", "Fractionner en plusieurs applications",
     "Surveiller le drainage pour éviter l'engorgement"],
    ["Besoins en eau très élevés", "Irrigation fractionnée obligatoire", "Considérer l'ombrage temporaire",
     "Vérifier l'état du système d'irrigation"],
]
CROP_LINES = [  # crops, extra recommendation
    (["riz"], "Maintenir une lame d'eau de 2-5 cm"),
    (["mil", "sorgho"], "Éviter l'excès d'eau, ces cultures tolèrent la sécheresse"),
    (["coton"], "Irrigation critique pendant la floraison"),
]
CONSERVATION_BASE = ["Utiliser du paillis pour réduire l'évaporation", "Vérifier et réparer les fuites du système",
                     "Ajuster les asperseurs pour éviter le gaspillage"]
CONSERVATION_HIGH = ["Considérer l'irrigation goutte-à-goutte", "Installer des capteurs d'humidité du sol",
                     "Programmer l'irrigation aux heures fraîches"]
TIME_EARLY_HOT = "05h00 - 07h00 (optimal)"
TIME_EARLY = "06h00 - 08h00"
TIME_EVENING = "17h00 - 19h00 (si nécessaire)"
WATER_COST_PER_MM = 0.1

DISEASE_LEVELS = [  # class, level, colour, action
    (0, "Faible", "green", "Surveillance normale"),
    (1, "Modéré", "yellow", "Surveillance renforcée"),
    (2, "Élevé", "orange", "Mesures préventives"),
    (3, "Critique", "red", "Intervention immédiate"),
]
DISEASE_PREVENTION = ["Améliorer la circulation d'air", "Éviter l'irrigation par aspersion", "Surveiller les symptômes"]
DISEASE_MONITORING = ("Hebdomadaire", "Quotidienne")   # class 0, otherwise
DISEASE_FOCUS = "Surveillance générale"
DISEASE_TREATMENT = ("Traitement préventif", "Traitement curatif")   # class < 2, otherwise
RISK_NAMES = ("élevé", "modéré", "faible")

ALERT_RULES = [  # rule rank, type, level, message prefix, unit
    (0, "Température", "Critique", "Température extrême: ", "°C"),
    (1, "Sécheresse", "Élevé", "Humidité très faible: ", "%"),
    (2, "Vent", "Modéré", "Vent fort: ", " m/s"),
]
ALERT_TEMP_MARGIN = 3.0
ALERT_HUMIDITY_MARGIN = 10.0
ALERT_WIND = 10.0

GLOBAL_RISK_BANDS = [(2.5, "CRITIQUE"), (1.5, "ÉLEVÉ"), (0.5, "MODÉRÉ")]
GLOBAL_RISK_LOW = "FAIBLE"
GLOBAL_ALERTS = {"rain_high": "🔴 Fortes précipitations prévues", "rain_low": "🟡 Risque de manque d'eau",
                 "drought": "🟠 Risque de sécheresse ", "disease": "🔴 Risque de maladie "}

# scoring defaults of a thin reading (serving features)
SERVING_DEFAULTS = {"temperature": 25.0, "precipitation": 0.0, "solar_radiation": 20.0, "wind_speed": 2.0,
                    "evi": 0.5, "ndvi": 0.6, "humidity": 70.0, "soil_moisture": 0.6, "leaf_wetness": 8.0,
                    "growth_stage": 60.0, "precipitation_7d": 0.0}
SERVING_FIXED = {"irrigation_efficiency": 0.8, "et0": 5.0, "etc": 6.0}

# seasonal baseline (default weather) parameters
BASELINE_TEMP = {"Dry": 28.0, "Wet": 26.0}
BASELINE_HUMIDITY = {"Dry": 45.0, "Wet": 75.0}
BASELINE_PRESSURE = 1012.0
BASELINE_WIND = 2.5
EMPIRICAL_WET_MONTHS = (5, 6, 7, 8, 9, 10)

# second bandings of the irrigation need: the prediction page (threshold 5) and the advice panel (3 / 6)
PAGE_THRESHOLD = 5.0
PAGE_HIGH = ("Quotidienne", "45-60 minutes")
PAGE_LOW = ("Tous les 2 jours", "30-45 minutes")
PAGE_ETC_FACTOR = 0.8
PAGE_ET0_FACTOR = 0.7
ADVICE_BANDS = [  # lower bound (exclusive), level, plan lines
    (6.0, "Besoins élevés", ["Irrigation 2 fois par jour (matin et soir)", "Durée : 45-60 minutes par session",
                             "Surveiller le drainage pour éviter l'engorgement"]),
    (3.0, "Besoins modérés", ["Irrigation quotidienne ou tous les 2 jours", "Durée : 30-45 minutes",
                              "Meilleurs moments : 6h-8h ou 17h-19h"]),
]
ADVICE_LOW = ("Besoins faibles", ["Irrigation tous les 3-4 jours", "Durée : 15-30 minutes",
                                  "Surveiller l'humidité du sol"])

# ---------------------------------------------------------------- FIXED VALUES (end)


def _arr(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(s) for s in items])


def _band(x: Column, bands, top, pick: int) -> Column:
    expr = None
    for b in bands:
        cond = x < F.lit(b[0])
        expr = F.when(cond, F.lit(b[pick])) if expr is None else expr.when(cond, F.lit(b[pick]))
    return expr.when(x.isNotNull(), F.lit(top[pick - 1]))


def _lookup(x: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# ----------------------------------------------------------------------------- H7 / B23 rain

def rain_category(df: DataFrame, col: str = "predicted_mm") -> DataFrame:
    x = F.col(col)
    conf = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.lit(100.0) - F.abs(x) * F.lit(10.0)))
    return df.withColumns({"category": _band(x, RAIN_BANDS, RAIN_TOP, 1), "risk_level": _band(x, RAIN_BANDS, RAIN_TOP, 2),
                           "confidence": conf})


def recommend_rain(df: DataFrame, col: str = "predicted_mm", out: str = "recommendations") -> DataFrame:
    x = F.col(col)
    expr = None
    for (b, _, _), recs in zip(RAIN_BANDS, RAIN_RECOMMENDATIONS):
        expr = F.when(x < F.lit(b), _arr(recs)) if expr is None else expr.when(x < F.lit(b), _arr(recs))
    return df.withColumn(out, expr.when(x.isNotNull(), _arr(RAIN_RECOMMENDATIONS[-1])))


# ----------------------------------------------------------------------------- H8 / B23 drought

def drought_level(df: DataFrame, col: str = "severity") -> DataFrame:
    x = F.col(col)
    return df.withColumns({
        "drought_level": _lookup(x, [(k, lvl) for k, lvl, _, _ in DROUGHT_LEVELS]),
        "risk_category": _lookup(x, [(k, r) for k, _, r, _ in DROUGHT_LEVELS]),
        "alert_color": _lookup(x, [(k, c) for k, _, _, c in DROUGHT_LEVELS]),
        "risk_short": _lookup(x, DROUGHT_SHORT, UNKNOWN),
    })


def recommend_drought(df: DataFrame, col: str = "severity") -> DataFrame:
    """Recommendations by severity (anything but 0/1/2 gets the severe list) and cumulative
    monitoring actions (+2 from 1, +2 from 2, +2 at 3)."""
    x = F.col(col)
    rec = F.when(x == 0, _arr(DROUGHT_RECOMMENDATIONS[0])).when(x == 1, _arr(DROUGHT_RECOMMENDATIONS[1])) \
        .when(x == 2, _arr(DROUGHT_RECOMMENDATIONS[2])).otherwise(_arr(DROUGHT_RECOMMENDATIONS[3]))
    empty = F.array().cast("array<string>")
    mon = F.concat(_arr(MONITORING_BASE),
                   F.when(x >= 1, _arr(MONITORING_FROM_1)).otherwise(empty),
                   F.when(x >= 2, _arr(MONITORING_FROM_2)).otherwise(empty),
                   F.when(x == 3, _arr(MONITORING_AT_3)).otherwise(empty))
    return df.withColumns({"recommendations": rec, "monitoring_actions": mon})


# ----------------------------------------------------------------------------- H9, H10, B23 irrigation

def irrigation_schedule(df: DataFrame, col: str = "irrigation_need") -> DataFrame:
    x = F.col(col)
    return df.withColumns({"frequency": _band(x, IRRIGATION_BANDS, IRRIGATION_TOP, 1),
                           "duration": _band(x, IRRIGATION_BANDS, IRRIGATION_TOP, 2)})


def irrigation_score(df: DataFrame, need: str = "irrigation_need", etc: str = "etc") -> DataFrame:
    """efficiency_score = int(clip(100 - |need - etc| / etc * 50, 0, 100)), etc == 0 -> 100;
    water cost = need * 0.1."""
    n, e = F.col(need), F.col(etc)
    raw = F.lit(100.0) - F.abs(n - e) / e * F.lit(50.0)
    score = F.when(e == 0, F.lit(100)).otherwise(F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw)).cast("int"))
    return df.withColumns({"efficiency_score": score, "water_cost": n * F.lit(WATER_COST_PER_MM)})


def recommend_irrigation(df: DataFrame, need: str = "irrigation_need", crop: str = "crop_type") -> DataFrame:
    x, c = F.col(need), F.col(crop)
    expr = None
    for (b, _, _), recs in zip(IRRIGATION_BANDS, IRRIGATION_RECOMMENDATIONS):
        expr = F.when(x < F.lit(b), _arr(recs)) if expr is None else expr.when(x < F.lit(b), _arr(recs))
    base = expr.otherwise(_arr(IRRIGATION_RECOMMENDATIONS[-1]))
    extra = None
    for crops, line in CROP_LINES:
        cond = c.isin(crops)
        extra = F.when(cond, F.array(F.lit(line))) if extra is None else extra.when(cond, F.array(F.lit(line)))
    extra = extra.otherwise(F.array().cast("array<string>"))
    tips = F.concat(_arr(CONSERVATION_BASE),
                    F.when(x > F.lit(5.0), _arr(CONSERVATION_HIGH)).otherwise(F.array().cast("array<string>")))
    return df.withColumns({"recommendations": F.concat(base, extra), "conservation_tips": tips})


def irrigation_times(df: DataFrame, temp_max: str = "temp_max", wind: str = "wind_speed") -> DataFrame:
    """Morning slot by temp_max (> 30 -> early optimal); evening slot when temp_max > 35 or wind > 5.
    Missing inputs take the platform's defaults (35, 2)."""
    t = F.coalesce(F.col(temp_max), F.lit(35.0))
    w = F.coalesce(F.col(wind), F.lit(2.0))
    first = F.when(t > 30, F.lit(TIME_EARLY_HOT)).otherwise(F.lit(TIME_EARLY))
    return df.withColumn("best_times", F.concat(F.array(first), F.when((t > 35) | (w > 5), F.array(F.lit(TIME_EVENING)))
                                                .otherwise(F.array().cast("array<string>"))))


# ----------------------------------------------------------------------------- H11, H12 disease

def disease_rules(conditions: DataFrame, rules: Sequence[tuple] = DISEASE_RULES, temp: str = "temperature", humidity: str = "humidity",
                  season: str = "season", key: Sequence[str] = ("city",)) -> DataFrame:
    """Per condition row and crop: worst rule level (2 high = temp & humidity & season, 1 medium =
    temp & (humidity or season), 0 low) and the sorted names of diseases at that level.

    ``rules``: (crop, disease, temp_min, temp_max, humidity_min, season) tuples, a fixed catalogue: its rules are evaluated
    inside the row and one row per crop is inlined. No join and no shuffle."""
    def level(r):
        t_ok = F.col(temp).between(F.lit(r[2]), F.lit(r[3]))
        h_ok, s_ok = F.col(humidity) >= F.lit(r[4]), F.col(season) == F.lit(r[5])
        return F.when(t_ok & h_ok & s_ok, F.lit(2)).when((t_ok & h_ok) | (t_ok & s_ok), F.lit(1)).otherwise(F.lit(0))

    crops = list(dict.fromkeys(r[0] for r in rules))
    none = F.array().cast("array<string>")
    per_crop = []
    for crop in crops:
        own = F.array(*[F.struct(level(r).alias("lvl"), F.lit(r[1]).alias("disease")) for r in rules if r[0] == crop])
        per_crop.append(F.struct(F.lit(crop).alias("crop"), own.alias("own")))
    rows = conditions.select(*key, F.inline(F.array(*per_crop)))
    rows = rows.withColumn("risk_level", F.array_max(F.transform("own", lambda x: x["lvl"])))
    worst = F.sort_array(F.transform(F.filter("own", lambda x: x["lvl"] == F.col("risk_level")), lambda x: x["disease"]))
    return rows.select(*key, "crop", "risk_level",
                       F.when(F.col("risk_level") == 2, F.lit(RISK_NAMES[0])).when(F.col("risk_level") == 1,
                                                                                   F.lit(RISK_NAMES[1]))
                       .otherwise(F.lit(RISK_NAMES[2])).alias("risk_name"),
                       F.when(F.col("risk_level") > 0, worst).otherwise(none).alias("diseases"),
                       F.size("own").cast("long").alias("n_diseases"))


def disease_advice(df: DataFrame, col: str = "disease_class") -> DataFrame:
    """Level / colour / action for 0..3 (anything else -> class 0's entry), monitoring, treatment."""
    x = F.col(col)
    known = x.isin([k for k, *_ in DISEASE_LEVELS])
    xx = F.when(known, x).otherwise(F.lit(0))
    return df.withColumns({
        "overall_risk_level": _lookup(xx, [(k, lv) for k, lv, _, _ in DISEASE_LEVELS]),
        "alert_color": _lookup(xx, [(k, c) for k, _, c, _ in DISEASE_LEVELS]),
        "recommended_action": _lookup(xx, [(k, a) for k, _, _, a in DISEASE_LEVELS]),
        "prevention_measures": _arr(DISEASE_PREVENTION),
        "monitoring_frequency": F.when(x == 0, F.lit(DISEASE_MONITORING[0])).otherwise(F.lit(DISEASE_MONITORING[1])),
        "monitoring_focus": F.lit(DISEASE_FOCUS),
        "treatment": F.when(x < 2, F.lit(DISEASE_TREATMENT[0])).otherwise(F.lit(DISEASE_TREATMENT[1])),
        "risk_short": _lookup(x, [(k, lv) for k, lv, _, _ in DISEASE_LEVELS], UNKNOWN),
    })


# ----------------------------------------------------------------------------- H13, H14 alerts and norms

def seasonal_norms(df: DataFrame, norms: DataFrame | None = None, city: str = "city", month: str = "month") -> DataFrame:
    """Attach the city x month norms (fixed 72-row table, broadcast); unknown cities use Dakar's."""
    norms = norms if norms is not None else dim(df.sparkSession, "seasonal_norms")
    cities = [r for r in ("Dakar", "Thiès", "Saint-Louis", "Kaolack", "Ziguinchor", "Tambacounda")]
    ncity = F.when(F.col(city).isin(cities), F.col(city)).otherwise(F.lit(NORM_DEFAULT_CITY))
    n = norms.select(F.col("city").alias("_n_city"), F.col("month").alias("_n_month"), "temp_min", "temp_max",
                     "hum_min", "hum_max", "precip_avg", F.col("season").alias("norm_season"))
    return df.withColumn("_norm_key", ncity).join(
        F.broadcast(n), (F.col("_norm_key") == F.col("_n_city")) & (F.col(month) == F.col("_n_month")), "left") \
        .drop("_norm_key", "_n_city", "_n_month")


def _fmt1(x: Column) -> Column:
    """One decimal, rounded half up on the binary value, rendered as the shortest decimal."""
    return (F.floor(x * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)).cast("string")


def _fmt_raw(x: Column) -> Column:
    """The reading as given: integral values without a decimal part (45 -> '45'), others as is."""
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))


def alert_rows(readings: DataFrame, city: str = "city", city_rank: str = "city_rank") -> DataFrame:
    """All alerts of the given readings (norms attached): one row per fired rule, with ranks."""
    t, h, w = F.col("temperature"), F.col("humidity"), F.col("wind_speed")
    cand = F.array(
        F.struct(F.lit(0).alias("rule_rank"), (t > F.col("temp_max") + F.lit(ALERT_TEMP_MARGIN)).alias("fired"),
                 F.lit(ALERT_RULES[0][1]).alias("type"), F.lit(ALERT_RULES[0][2]).alias("level"),
                 F.concat(F.lit(ALERT_RULES[0][3]), _fmt1(t), F.lit(ALERT_RULES[0][4])).alias("message")),
        F.struct(F.lit(1).alias("rule_rank"), (h < F.col("hum_min") - F.lit(ALERT_HUMIDITY_MARGIN)).alias("fired"),
                 F.lit(ALERT_RULES[1][1]).alias("type"), F.lit(ALERT_RULES[1][2]).alias("level"),
                 F.concat(F.lit(ALERT_RULES[1][3]), _fmt_raw(h), F.lit(ALERT_RULES[1][4])).alias("message")),
        F.struct(F.lit(2).alias("rule_rank"), (w > F.lit(ALERT_WIND)).alias("fired"),
                 F.lit(ALERT_RULES[2][1]).alias("type"), F.lit(ALERT_RULES[2][2]).alias("level"),
                 F.concat(F.lit(ALERT_RULES[2][3]), _fmt1(w), F.lit(ALERT_RULES[2][4])).alias("message")))
    keep = [c for c in readings.columns if c in (city, city_rank, "ts", "reading_id")]
    return readings.select(*keep, F.inline(cand)).filter(F.col("fired")).drop("fired")


def latest_per_city(readings: DataFrame, city: str = "city", ts: str = "ts", tie: str = "reading_id") -> DataFrame:
    """The current reading of each city: max (ts, tie) per city, an aggregation (map-side combined)."""
    cols = [c for c in readings.columns if c != city]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts), F.col(tie)))
    return readings.groupBy(city).agg(best.alias("_r")).select(city, *[F.col("_r." + c).alias(c) for c in cols])


def daily_alerts(readings: DataFrame, limit: int | None = 3, city: str = "city") -> DataFrame:
    """Alerts of each provider city's current reading vs its month's norms, in city order then
    rule order; the first ``limit`` (a top-k report, so the limit is the feature)."""
    cities = dim(readings.sparkSession, "provider_cities").select(F.col("city").alias("_pc"), "city_rank")
    cur = latest_per_city(readings, city)
    cur = cur.join(cities, F.col(city) == F.col("_pc")).drop("_pc")
    cur = seasonal_norms(cur, city=city, month="month")
    a = alert_rows(cur, city)
    a = a.orderBy("city_rank", "rule_rank")
    return a.limit(limit) if limit else a


# ----------------------------------------------------------------------------- H15, H16

def global_risk(df: DataFrame, rain: str = "predicted_mm", drought: str = "severity",
                disease: str = "disease_class") -> DataFrame:
    """Mean of the available risk scores (rain > 15 -> 3, < 1 -> 1, otherwise no rain score) and
    alerts; bands at 2.5 / 1.5 / 0.5."""
    r = F.col(rain) if rain in df.columns else F.lit(None).cast("double")
    d = F.col(drought).cast("double") if drought in df.columns else F.lit(None).cast("double")
    s = F.col(disease).cast("double") if disease in df.columns else F.lit(None).cast("double")
    rain_score = F.when(r > F.lit(15.0), F.lit(3.0)).when(r < F.lit(1.0), F.lit(1.0))
    scores = F.filter(F.array(rain_score, d, s), lambda v: v.isNotNull())
    n = F.size(scores)
    mean = F.when(n > 0, F.aggregate(scores, F.lit(0.0), lambda acc, v: acc + v) / n.cast("double"))
    band = F.when(mean >= 2.5, F.lit(GLOBAL_RISK_BANDS[0][1])).when(mean >= 1.5, F.lit(GLOBAL_RISK_BANDS[1][1])) \
        .when(mean >= 0.5, F.lit(GLOBAL_RISK_BANDS[2][1])).when(mean.isNotNull(), F.lit(GLOBAL_RISK_LOW))
    empty = F.array().cast("array<string>")
    alerts = F.concat(
        F.when(r > 15, F.array(F.lit(GLOBAL_ALERTS["rain_high"]))).when(r < 1, F.array(F.lit(GLOBAL_ALERTS["rain_low"])))
        .otherwise(empty),
        F.when(d >= 2, F.array(F.concat(F.lit(GLOBAL_ALERTS["drought"]), F.coalesce(
            _lookup(d.cast("int"), [(k, lv) for k, lv, _, _ in DROUGHT_LEVELS]), F.lit(""))))).otherwise(empty),
        F.when(s >= 2, F.array(F.concat(F.lit(GLOBAL_ALERTS["disease"]), F.coalesce(
            _lookup(s.cast("int"), [(k, lv) for k, lv, _, _ in DISEASE_LEVELS]), F.lit(""))))).otherwise(empty))
    return df.withColumns({"risk_mean": mean, "global_risk": band, "alerts": alerts})


def heuristic_predictions(df: DataFrame, season: str = "season", ssm: str = "soil_moisture",
                          temp: str = "temperature", humidity: str = "humidity") -> DataFrame:
    """Model-free defaults: rain 0.5 (Dry) / 3.0; drought 2 when Dry and ssm < 0.3 else 1;
    irrigation max(1, base + 0.2(t - 25) + 0.05(70 - h)) with base 5 (Dry) / 3."""
    dry = F.col(season) == F.lit("Dry")
    base = F.when(dry, F.lit(5.0)).otherwise(F.lit(3.0))
    need = base + (F.col(temp) - F.lit(25.0)) * F.lit(0.2) + (F.lit(70.0) - F.col(humidity)) * F.lit(0.05)
    return df.withColumns({
        "predicted_mm": F.when(dry, F.lit(0.5)).otherwise(F.lit(3.0)),
        "severity": F.when(dry & (F.col(ssm) < F.lit(0.3)), F.lit(2)).otherwise(F.lit(1)),
        "irrigation_need": F.when(need.isNotNull(), F.greatest(F.lit(1.0), need)),
    })


# ----------------------------------------------------------------------------- H17, H18 serving

def condition_flags(df: DataFrame, ssm: str = "soil_moisture", temp: str = "temperature") -> DataFrame:
    s = F.coalesce(F.col(ssm), F.lit(SERVING_DEFAULTS["soil_moisture"]))
    t = F.coalesce(F.col(temp), F.lit(SERVING_DEFAULTS["temperature"]))
    return df.withColumns({
        "fungal_conditions": ((s > 0.7) & t.between(20, 30)).cast("int"),
        "bacterial_conditions": ((s > 0.8) & (t > 25)).cast("int"),
        "viral_conditions": (t.between(25, 35) & s.between(0.4, 0.8)).cast("int"),
        "thermal_stress": F.abs(t - F.lit(25.0)) / F.lit(10.0),
    })


def serving_features(df: DataFrame, feature_names: Sequence[str], date_col: str = "date",
                     history: DataFrame | None = None, on: Sequence[str] = ("region",), as_of: str | None = None) -> DataFrame:
    """Model input columns from a thin reading (one wide projection, no UDF): defaults for absent
    measures, moving averages = instant values, deviations and lags 0, cumulative rain from the
    7-day total. A feature name that is not known is an error. Keeps the input's key columns.

    ``history``: a feature frame (see ``plans.features``) with ``on`` and ``date``; each reading then takes the
    features of the latest history row of its series up to the day in ``as_of`` (default: ``date_col``), and the instant values only
    where there is none (``operators.asof``: no pairs of readings and history). Adds ``as_of``, the matched day."""
    def g(name):
        return F.coalesce(F.col(name), F.lit(SERVING_DEFAULTS[name])) if name in df.columns \
            else F.lit(SERVING_DEFAULTS[name])

    temp = g("temperature")
    tmax = F.coalesce(F.col("temp_max"), temp) if "temp_max" in df.columns else temp
    tmin = F.coalesce(F.col("temp_min"), temp - F.lit(8.0)) if "temp_min" in df.columns else temp - F.lit(8.0)
    precip, wind, ndvi, evi = g("precipitation"), g("wind_speed"), g("ndvi"), g("evi")
    sm = g("soil_moisture")
    hum = g("humidity")
    ssm = F.coalesce(F.col("soil_moisture"), hum / F.lit(100.0) * F.lit(0.8)) if "soil_moisture" in df.columns \
        else hum / F.lit(100.0) * F.lit(0.8)
    p7 = g("precipitation_7d")
    season = F.col("season") if "season" in df.columns else F.lit("Wet")
    d = F.to_date(F.col(date_col))
    doy = F.dayofyear(d)
    month = F.month(d)
    two_pi = F.lit(2.0 * math.pi)
    crop = F.coalesce(F.col("crop_type"), F.lit("mil")) if "crop_type" in df.columns else F.lit("mil")
    base = {
        "temperature_2m": temp, "total_precipitation_sum": precip,
        "surface_solar_radiation_downwards_sum": g("solar_radiation") * F.lit(1000000.0),
        "u_component_of_wind_10m": wind * F.lit(0.7), "v_component_of_wind_10m": wind * F.lit(0.3),
        "lst_day_1km": tmax * F.lit(100.0), "lst_night_1km": tmin * F.lit(100.0),
        "temp_day_celsius": tmax, "temp_night_celsius": tmin, "evi": evi, "ndvi": ndvi,
        "ndvi_normalized": ndvi, "evi_normalized": evi, "ssm": ssm,
        "month_sin": F.sin(two_pi * month / F.lit(12.0)), "month_cos": F.cos(two_pi * month / F.lit(12.0)),
        "day_sin": F.sin(two_pi * doy / F.lit(365.0)), "day_cos": F.cos(two_pi * doy / F.lit(365.0)),
        "is_dry_season": (season == F.lit("Dry")).cast("int"), "is_wet_season": (season == F.lit("Wet")).cast("int"),
        "day_of_year": doy, "temp_range": tmax - tmin, "wind_speed": wind, "temp_max": tmax, "temp_min": tmin,
        "vegetation_health": (ndvi + evi) / F.lit(2.0),
        "water_stress_index": (temp - F.lit(25.0)) / F.lit(10.0) - (ndvi - F.lit(0.5)) / F.lit(0.3),
        "meteorological_drought_index": (temp - F.lit(25.0)) / F.lit(10.0) - (precip - F.lit(2.0)) / F.lit(5.0),
        "agricultural_drought_index": (F.lit(1.0) - sm) * (F.lit(1.0) - ndvi),
        "soil_water_deficit": F.greatest(F.lit(0.0), F.lit(0.4) - sm),
        "vegetation_stress": F.lit(1.0) - ndvi,
        "growth_stage": g("growth_stage"),
        "consecutive_dry_days": F.when(p7 > 1, F.lit(0)).otherwise(F.lit(3)),
    }
    base.update({k: F.lit(v) for k, v in SERVING_FIXED.items()})
    base.update({
        "temp_humidity_index": temp * sm, "leaf_wetness_duration": g("leaf_wetness"), "thermal_stress": F.abs(temp - F.lit(25.0)) / F.lit(10.0),
        "water_stress": F.greatest(F.lit(0.0), F.lit(0.4) - sm), "vegetation_density": ndvi, "temp_variation": tmax - tmin,
        "fungal_conditions": ((sm > 0.7) & temp.between(20, 30)).cast("int"),
        "bacterial_conditions": ((sm > 0.8) & (temp > 25)).cast("int"),
        "viral_conditions": (temp.between(25, 35) & sm.between(0.4, 0.8)).cast("int"),
        "consecutive_fungal_days": F.lit(0),
    })
    for w in (3, 7, 14, 15, 30):
        base[f"leaf_wetness_ma_{w}"] = g("leaf_wetness")
        base.update({f"temp_ma_{w}": temp, f"precip_ma_{w}": precip, f"ssm_ma_{w}": ssm, f"ndvi_ma_{w}": ndvi,
                     f"humidity_ma_{w}": ssm, f"et0_ma_{w}": F.lit(5.0), f"temp_deviation_{w}": F.lit(0.0),
                     f"precip_deviation_{w}": F.lit(0.0), f"ndvi_deviation_{w}": F.lit(0.0)})
    for p in (1, 3, 7, 14, 15, 30, 60):
        base.update({f"precipitation_lag_{p}": F.lit(0.0),
                     f"precip_cumul_{p}": p7 * (F.lit(float(p)) / F.lit(7.0))})
    for c in CROPS:
        base[f"crop_{c}"] = (crop == F.lit(c)).cast("int")
    unknown = [f for f in feature_names if f not in base]
    if unknown:
        raise ValueError(f"unknown serving features: {unknown}")
    keys = [c for c in df.columns if c in ("city", "region", "date", "ts", "reading_id")]
    if history is None:
        return df.select(*keys, *[base[f].cast("double").alias(f) for f in feature_names])
    from agrospark.operators.asof import asof_join
    base = df.withColumns({f"_b_{f}": base[f].cast("double") for f in feature_names}).select(*keys, *[c for c in dict.fromkeys([*on, as_of or date_col]) if c not in keys], *[f"_b_{f}" for f in feature_names])
    got = asof_join(base, history, on, as_of or date_col, "date", feature_names, prefix="_h_")
    return got.select(*keys, "as_of", *[F.coalesce(F.col(f"_h_{f}").cast("double"), F.col(f"_b_{f}")).alias(f) for f in feature_names])


# ----------------------------------------------------------------------------- H19 baseline

def seasonal_baseline(cities: DataFrame, date_col: str = "date", city: str = "city",
                      crop: str | None = None) -> DataFrame:
    """Deterministic default conditions per city and date: season (wet May-Oct), base temperature /
    humidity + city adjustment (humidity clamped 20..100), seasonal NDVI / soil-moisture means
    (clamped 0.1..1), growth stage from the crop calendar, solar = max(10, 20 + 5 sin(2 pi m/12)).
    Random draws of the platform are replaced by their expected values."""
    spark = cities.sparkSession
    m = F.month(F.col(date_col))
    season = F.when(m.isin(list(EMPIRICAL_WET_MONTHS)), F.lit("Wet")).otherwise(F.lit("Dry"))
    adj = dim(spark, "city_adjust").withColumnRenamed("city", "_adj_city")
    params = dim(spark, "season_params").withColumnRenamed("season", "_p_season")
    d = cities.withColumn("season", season)
    d = d.join(adj, F.col(city) == F.col("_adj_city"), "left").join(params, F.col("season") == F.col("_p_season"),
                                                                     "left")
    dry = F.col("season") == F.lit("Dry")
    d = d.withColumns({
        "temperature": F.when(dry, F.lit(BASELINE_TEMP["Dry"])).otherwise(F.lit(BASELINE_TEMP["Wet"]))
        + F.coalesce(F.col("d_temp"), F.lit(0)).cast("double"),
        "humidity": F.greatest(F.lit(20.0), F.least(F.lit(100.0), F.when(dry, F.lit(BASELINE_HUMIDITY["Dry"]))
                                                    .otherwise(F.lit(BASELINE_HUMIDITY["Wet"]))
                                                    + F.coalesce(F.col("d_humidity"), F.lit(0)).cast("double"))),
        "pressure": F.lit(BASELINE_PRESSURE),
        "wind_speed": F.lit(BASELINE_WIND + 1.0),    # 2.5 + mean of an exponential(1) draw
        "ndvi": F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.col("ndvi_mean"))),
        "soil_moisture": F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.col("ssm_mean"))),
        "solar_radiation": F.greatest(F.lit(10.0), F.lit(20.0) + F.lit(5.0) * F.sin(F.lit(2.0 * math.pi) * m
                                                                                    / F.lit(12.0))),
        "precipitation_7d": F.when(dry, F.lit(0.0)).otherwise(F.lit(10.0)),
        "leaf_wetness": F.when(dry, F.lit(2.0)).otherwise(F.lit(12.0)),
    }).withColumn("evi", F.col("ndvi") * F.lit(0.8))
    if crop is None:
        d = d.withColumn("crop_type", F.lit("mil"))
        crop = "crop_type"
    from agrospark.operators.indices import growth_stage
    out = growth_stage(d, date_col, crop)
    return out.drop("_adj_city", "d_temp", "d_humidity", "_p_season", "ndvi_mean", "ndvi_std", "ssm_mean", "ssm_std")


# ----------------------------------------------------------------------------- H21

def equal_width_bins(df: DataFrame, col: str, n: int = 4, out: str = "bin") -> DataFrame:
    """Equal-width classes 0..n-1 over [min, max], right-closed (min goes to class 0): class =
    number of interior edges min + k*(max-min)/n (k = 1..n-1) strictly below the value."""
    mm = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    j = df.crossJoin(F.broadcast(mm))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(float(n))
    cls = None
    for k in range(1, n):
        t = F.when(F.col(col) > F.col("_mn") + F.lit(float(k)) * width, F.lit(1)).otherwise(F.lit(0))
        cls = t if cls is None else cls + t
    return j.withColumn(out, F.when(F.col(col).isNotNull(), cls)).drop("_mn", "_mx")



def irrigation_page_plan(df: DataFrame, col: str = "irrigation_need") -> DataFrame:
    """The prediction page's banding: one threshold at 5, plus its derived ETc / ET0 shares."""
    x = F.col(col)
    high = x > F.lit(PAGE_THRESHOLD)
    return df.withColumns({
        "page_frequency": F.when(x.isNotNull(), F.when(high, F.lit(PAGE_HIGH[0])).otherwise(F.lit(PAGE_LOW[0]))),
        "page_duration": F.when(x.isNotNull(), F.when(high, F.lit(PAGE_HIGH[1])).otherwise(F.lit(PAGE_LOW[1]))),
        "page_etc": x * F.lit(PAGE_ETC_FACTOR),
        "page_et0": x * F.lit(PAGE_ET0_FACTOR),
    })


def irrigation_advice(df: DataFrame, col: str = "irrigation_need") -> DataFrame:
    """The advice panel's banding at 3 / 6: need level and a three-line plan."""
    x = F.col(col)
    level, plan = None, None
    for lo, name, lines in ADVICE_BANDS:
        cond = x > F.lit(lo)
        level = F.when(cond, F.lit(name)) if level is None else level.when(cond, F.lit(name))
        plan = F.when(cond, _arr(lines)) if plan is None else plan.when(cond, _arr(lines))
    return df.withColumns({"need_level": level.when(x.isNotNull(), F.lit(ADVICE_LOW[0])),
                           "plan": plan.when(x.isNotNull(), _arr(ADVICE_LOW[1]))})
