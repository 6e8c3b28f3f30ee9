"""Small dimension tables (broadcast-safe: their row counts are fixed, not data-dependent).

FIXED VALUES. Everything below must equal the platform being re-implemented for results to
match: city coordinates, region boxes, crop coefficients, crop calendar, disease rules,
seasonal norms, season parameters and city adjustments. They are stated plainly, in natural
order. The SQL rendering (``values_sql``) lets the DuckDB oracle use the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- FIXED VALUES (begin)

# weather-station cities: ville, lat, lon
CITIES = [
    ("Dakar", 14.6934, -17.4479),
    ("Thiès", 14.7915, -16.9256),
    ("Kaolack", 14.1388, -16.0764),
    ("Saint-Louis", 16.028, -16.5049),
    ("Ziguinchor", 12.5635, -16.2725),
    ("Tambacounda", 13.7693, -13.6683),
    ("Louga", 15.6119, -16.2233),
    ("Fatick", 14.334, -16.4042),
    ("Kolda", 12.8936, -14.9397),
    ("Kaffrine", 14.102, -15.5484),
    ("Matam", 15.6566, -13.2559),
    ("Diourbel", 14.6546, -16.2278),
    ("Podor", 16.6527, -14.9587),
    ("Richard-Toll", 16.4663, -15.6884),
    ("Bakel", 14.905, -12.4568),
]

# forecast/alert cities (provider order = alert order): city, lat, lon
PROVIDER_CITIES = [
    ("Dakar", 14.7167, -17.4677),
    ("Thiès", 14.7886, -16.9246),
    ("Saint-Louis", 16.0469, -16.4897),
    ("Kaolack", 14.1593, -16.0728),
    ("Ziguinchor", 12.5681, -16.2719),
    ("Tambacounda", 13.7671, -13.6681),
]

# satellite regions: region, lat, lon, buffer (degrees)
REGIONS = [
    ("Dakar", 14.7167, -17.4677, 0.2),
    ("Diourbel", 14.6558, -16.2334, 0.3),
    ("Fatick", 14.3396, -16.4114, 0.3),
    ("Kaffrine", 14.1050, -15.5500, 0.3),
    ("Kaolack", 14.1469, -16.0726, 0.3),
    ("Kédougou", 12.5556, -12.1744, 0.4),
    ("Kolda", 12.8833, -14.9500, 0.4),
    ("Louga", 15.6144, -16.2286, 0.4),
    ("Matam", 15.6600, -13.2550, 0.4),
    ("Saint-Louis", 16.0179, -16.4896, 0.3),
    ("Sédhiou", 12.7089, -15.5561, 0.3),
    ("Tambacounda", 13.7707, -13.6673, 0.5),
    ("Thiès", 14.7910, -16.9250, 0.3),
    ("Ziguinchor", 12.5833, -16.2719, 0.3),
]

# crop coefficients: crop, kc_initial, kc_mid, kc_end, growing_days
CROP_KC = [
    ("mil", 0.3, 1.0, 0.4, 120),
    ("sorgho", 0.3, 1.15, 0.4, 130),
    ("mais", 0.3, 1.2, 0.6, 125),
    ("riz", 1.05, 1.2, 0.9, 150),
    ("arachide", 0.4, 1.15, 0.6, 130),
    ("coton", 0.35, 1.15, 0.7, 180),
]
CROPS = [c[0] for c in CROP_KC]

# crop calendar: crop, planting_month, harvest_month
CROP_CALENDAR = [
    ("mil", 6, 10),
    ("sorgho", 6, 11),
    ("mais", 5, 9),
    ("riz", 7, 12),
    ("arachide", 6, 11),
    ("coton", 5, 12),
]

# disease rules: crop, disease, temp_min, temp_max, humidity_min, risk_season
DISEASE_RULES = [
    ("mil", "mildiou", 20.0, 30.0, 80.0, "Wet"),
    ("mil", "charbon", 25.0, 35.0, 60.0, "Wet"),
    ("mil", "rouille", 15.0, 25.0, 70.0, "Wet"),
    ("sorgho", "anthracnose", 22.0, 32.0, 75.0, "Wet"),
    ("sorgho", "charbon_grain", 20.0, 30.0, 65.0, "Wet"),
    ("sorgho", "helminthosporiose", 25.0, 35.0, 80.0, "Wet"),
    ("mais", "helminthosporiose", 20.0, 30.0, 85.0, "Wet"),
    ("mais", "rouille", 16.0, 25.0, 75.0, "Wet"),
    ("mais", "charbon", 25.0, 32.0, 70.0, "Wet"),
    ("riz", "pyriculariose", 25.0, 30.0, 90.0, "Wet"),
    ("riz", "helminthosporiose", 28.0, 35.0, 85.0, "Wet"),
    ("riz", "bacteriose", 25.0, 35.0, 80.0, "Wet"),
    ("arachide", "cercosporiose", 25.0, 30.0, 80.0, "Wet"),
    ("arachide", "rouille", 22.0, 28.0, 75.0, "Wet"),
    ("arachide", "rosette", 20.0, 30.0, 60.0, "Dry"),
    ("coton", "fusariose", 25.0, 35.0, 70.0, "Wet"),
    ("coton", "bacteriose", 28.0, 35.0, 80.0, "Wet"),
    ("coton", "alternariose", 20.0, 30.0, 75.0, "Wet"),
]

# seasonal norms per provider city. Two regimes per measure:
# temperature (min, max): Dec-Mar vs other months; humidity (min, max): Jun-Sep vs other months;
# precipitation mean: Nov-May vs other months.
# city, (t_min, t_max) Dec-Mar, (t_min, t_max) else, (h_min, h_max) Jun-Sep, (h_min, h_max) else, p Nov-May, p else
NORM_REGIMES = [
    ("Dakar", (18, 35), (22, 32), (40, 80), (30, 70), 0.1, 8.5),
    ("Thiès", (16, 38), (20, 35), (35, 85), (25, 65), 0.05, 12.0),
    ("Saint-Louis", (15, 40), (22, 38), (30, 75), (20, 60), 0.02, 6.5),
    ("Kaolack", (17, 42), (23, 39), (35, 85), (25, 70), 0.08, 15.2),
    ("Ziguinchor", (20, 38), (24, 35), (45, 90), (35, 75), 0.2, 25.8),
    ("Tambacounda", (15, 45), (25, 42), (25, 80), (15, 60), 0.03, 18.5),
]
NORM_COOL_MONTHS = (12, 1, 2, 3)
NORM_HUMID_MONTHS = (6, 7, 8, 9)
NORM_DRY_RAIN_MONTHS = (11, 12, 1, 2, 3, 4, 5)
NORM_WET_MONTHS = (6, 7, 8, 9, 10)          # season label of the norms table
NORM_DEFAULT_CITY = "Dakar"

# empirical seasonal parameters: season, ndvi_mean, ndvi_std, ssm_mean, ssm_std
SEASON_PARAMS = [
    ("Dry", 0.3, 0.1, 0.25, 0.08),
    ("Wet", 0.7, 0.15, 0.65, 0.12),
]

# default-weather city adjustments: city, d_temp, d_humidity
CITY_ADJUST = [
    ("Saint-Louis", 3, -10),
    ("Tambacounda", 4, -15),
    ("Ziguinchor", -1, 5),
    ("Dakar", 0, 0),
    ("Thiès", 1, -5),
    ("Kaolack", 2, -8),
]

# 4-season calendar of the panel: month -> season
SEASON4 = [
    (12, "Dry"), (1, "Dry"), (2, "Dry"),
    (3, "Transition"), (4, "Transition"), (5, "Transition"),
    (6, "Rainy"), (7, "Rainy"), (8, "Rainy"), (9, "Rainy"),
    (10, "Post-Rainy"), (11, "Post-Rainy"),
]

# ---------------------------------------------------------------- FIXED VALUES (end)


def seasonal_norm_rows():
    """6 cities x 12 months, generated from the two-regime rule above (72 rows)."""
    rows = []
    for city, tcool, tother, hhum, hother, pdry, pwet in NORM_REGIMES:
        for m in range(1, 13):
            t = tcool if m in NORM_COOL_MONTHS else tother
            h = hhum if m in NORM_HUMID_MONTHS else hother
            p = pdry if m in NORM_DRY_RAIN_MONTHS else pwet
            season = "Wet" if m in NORM_WET_MONTHS else "Dry"
            rows.append((city, m, float(t[0]), float(t[1]), float(h[0]), float(h[1]), float(p), season))
    return rows


_SCHEMAS = {
    "cities": ("ville string, lat double, lon double", CITIES),
    "provider_cities": ("city string, lat double, lon double, city_rank int",
                        [(c, la, lo, i) for i, (c, la, lo) in enumerate(PROVIDER_CITIES)]),
    "regions": ("region string, lat double, lon double, buffer double", REGIONS),
    "crop_kc": ("crop string, kc_initial double, kc_mid double, kc_end double, growing_days int", CROP_KC),
    "crop_calendar": ("crop string, planting_month int, harvest_month int", CROP_CALENDAR),
    "disease_rules": ("crop string, disease string, temp_min double, temp_max double, humidity_min double, "
                      "risk_season string, rule_rank int",
                      [r + (i,) for i, r in enumerate(DISEASE_RULES)]),
    "seasonal_norms": ("city string, month int, temp_min double, temp_max double, hum_min double, hum_max double, "
                       "precip_avg double, season string", None),
    "season_params": ("season string, ndvi_mean double, ndvi_std double, ssm_mean double, ssm_std double",
                      SEASON_PARAMS),
    "city_adjust": ("city string, d_temp int, d_humidity int", CITY_ADJUST),
    "season4": ("month int, season string", SEASON4),
}


def rows_of(name: str):
    schema, rows = _SCHEMAS[name]
    return seasonal_norm_rows() if rows is None else rows


def dim(spark: SparkSession, name: str) -> DataFrame:
    """A fixed dimension as a DataFrame, wrapped in a broadcast hint (row count is a constant)."""
    schema, _ = _SCHEMAS[name]
    return F.broadcast(spark.createDataFrame(rows_of(name), schema))


def _sql_lit(v):
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(int(v))


def values_sql(name: str, alias: str | None = None) -> str:
    """The same dimension as an inline ``(VALUES ...) AS alias(cols)`` for the DuckDB oracle."""
    schema, _ = _SCHEMAS[name]
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows_of(name))
    return f"(VALUES {body}) AS {alias or name}({', '.join(cols)})"
