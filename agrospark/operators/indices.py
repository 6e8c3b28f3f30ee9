"""Composite indices, labels and agronomic columns.

Global statistics and quantiles are one-row frames attached with a broadcast cross join; all
per-row logic is native column expressions (codegen), no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.dims import CROPS, dim
from agrospark.functions.agro import et0 as et0_expr, irrigation_efficiency, kc_stage, soil_water_deficit
from agrospark.functions.numeric import flag, score_cut, snap
from agrospark.operators.stats import index_stats, qname, threshold_quantiles, with_stats, zscore

DROUGHT_EDGES = (0.2, 0.4, 0.6)
DISEASE_EDGES = (0.3, 0.6, 0.8)


def drought_indices(df: DataFrame) -> DataFrame:
    """water_stress_index, meteorological_drought_index (z-scores, sample std) and
    agricultural_drought_index = (1 - ssm/max ssm)(1 - ndvi_normalized)."""
    cols = ["temp_day_celsius", "ndvi", "temperature_2m", "total_precipitation_sum", "ssm"]
    st = index_stats(df, cols).select(*[F.col(f"{c}_{k}").alias(f"_s_{c}_{k}") for c in cols
                                        for k in ("mean", "std", "max")])
    j = with_stats(df, st)

    def z(c):
        return zscore(F.col(c), F.col(f"_s_{c}_mean"), F.col(f"_s_{c}_std"))

    out = j.withColumns({
        "water_stress_index": z("temp_day_celsius") - z("ndvi"),
        "meteorological_drought_index": z("temperature_2m") - z("total_precipitation_sum"),
        "agricultural_drought_index": (F.lit(1.0) - F.col("ssm") / F.col("_s_ssm_max"))
        * (F.lit(1.0) - F.col("ndvi_normalized")),
    })
    return out.select(*df.columns, "water_stress_index", "meteorological_drought_index", "agricultural_drought_index")


def _weighted(terms) -> Column:
    """Left-to-right sum of weight * flag, in doubles (keeps the platform's float rounding)."""
    acc = None
    for cond, w in terms:
        t = F.when(F.coalesce(cond, F.lit(False)), F.lit(float(w))).otherwise(F.lit(0.0))
        acc = t if acc is None else acc + t
    return acc


#: what the drought label compares with, over all rows
DROUGHT_SPEC = {"precip_sum_30": [0.2], "temperature_2m": [0.8], "ssm": [0.2], "ndvi": [0.2]}


def drought_inputs(df: DataFrame, precip="total_precipitation_sum", part="region", order="date", block_rows: int | None = None) -> DataFrame:
    """Adds ``precip_sum_30``: the 30-row sum, snapped (grid 2^-30) so ties with its own quantile do not depend on summation order."""
    from agrospark.operators.windows import rolling_sums
    d = rolling_sums(df, precip, (30,), "_psum", part, order, block_rows=block_rows)
    return d.withColumn("precip_sum_30", snap(F.col("_psum_30"), 9)).drop("_psum_30")


def drought_label(df: DataFrame, precip="total_precipitation_sum", part="region", order="date",
                  method: str = "rank", block_rows: int | None = None, thresholds: DataFrame | None = None) -> DataFrame:
    """Drought class 0..3 from .3[30-row precip sum < q20] + .2[temp > q80] + .3[ssm < q20] + .2[ndvi < q20].
    ``thresholds``: the one row of quantiles, where it is kept up to date elsewhere (``summaries.SummaryStore`` of DROUGHT_SPEC)."""
    d = drought_inputs(df, precip, part, order, block_rows)
    q = threshold_quantiles(d, DROUGHT_SPEC, method=method) if thresholds is None else thresholds
    j = with_stats(d, q)
    score = _weighted([
        (F.col("precip_sum_30") < F.col(qname("precip_sum_30", 0.2)), 0.3),
        (F.col("temperature_2m") > F.col(qname("temperature_2m", 0.8)), 0.2),
        (F.col("ssm") < F.col(qname("ssm", 0.2)), 0.3),
        (F.col("ndvi") < F.col(qname("ndvi", 0.2)), 0.2),
    ])
    return j.withColumns({"drought_score": score}).withColumn("drought_class", score_cut(F.col("drought_score"),
                                                                                          DROUGHT_EDGES)) \
        .select(*df.columns, "precip_sum_30", "drought_score", "drought_class")


def disease_label(df: DataFrame, method: str = "rank", stored: bool = False) -> DataFrame:
    """Disease risk 0..3 from .4[ssm > q70] + .3[20 <= temp <= 32] + .2[precip > q60] + .1[solar < q40].
    ``stored``: ``df`` is a table, so its columns are read again rather than copied."""
    spec = {"ssm": [0.7], "total_precipitation_sum": [0.6], "surface_solar_radiation_downwards_sum": [0.4]}
    j = with_stats(df, threshold_quantiles(df, spec, method=method, stored=stored))
    score = _weighted([
        (F.col("ssm") > F.col(qname("ssm", 0.7)), 0.4),
        (F.col("temperature_2m").between(F.lit(20.0), F.lit(32.0)), 0.3),
        (F.col("total_precipitation_sum") > F.col(qname("total_precipitation_sum", 0.6)), 0.2),
        (F.col("surface_solar_radiation_downwards_sum") < F.col(qname("surface_solar_radiation_downwards_sum", 0.4)),
         0.1),
    ])
    return j.withColumn("disease_score", score).withColumn("disease_class", score_cut(F.col("disease_score"),
                                                                                      DISEASE_EDGES)) \
        .select(*df.columns, "disease_score", "disease_class")


def irrigation_need(df: DataFrame, precip="total_precipitation_sum") -> DataFrame:
    """clip(max(0, etc - 0.8*precip + 10*deficit) / efficiency, 0, 15), null-propagating."""
    raw = F.col("etc") - F.col(precip) * F.lit(0.8) + F.col("soil_water_deficit") * F.lit(10.0)
    pos = F.when(raw.isNotNull(), F.greatest(F.lit(0.0), raw))
    v = pos / F.col("irrigation_efficiency")
    return df.withColumn("irrigation_need", F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(15.0))))


# ----------------------------------------------------------------------------- agronomic columns

def et0(df: DataFrame, temp_max="temp_max", temp_min="temp_min", humidity=None, wind="wind_speed",
        solar="surface_solar_radiation_downwards_sum", out="et0") -> DataFrame:
    """ET0 per row; humidity defaults to ssm*100 and solar J -> MJ (the platform's inputs)."""
    h = F.col(humidity) if humidity else F.col("ssm") * F.lit(100.0)
    return df.withColumn(out, et0_expr(F.col(temp_max), F.col(temp_min), h, F.col(wind),
                                       F.col(solar) / F.lit(1000000.0)))


def assign_crop(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Deterministic crop and growth stage from an integer key (stable under repartitioning,
    unlike a seeded random draw). Default key: days since epoch * 31 + code of the region's last char."""
    if key is None:
        key = F.unix_date(F.col("date")).cast("long") * F.lit(31) + F.ascii(F.substring(F.col("region"), -1, 1))
    crops = F.array(*[F.lit(c) for c in CROPS])
    return df.withColumns({
        "crop_type": F.element_at(crops, (F.pmod(key, F.lit(len(CROPS))) + F.lit(1)).cast("int")),
        "growth_stage": (F.lit(1) + F.pmod(key * F.lit(7), F.lit(179))).cast("int"),
    })


def crop_onehot(df: DataFrame, crop_col: str = "crop_type") -> DataFrame:
    return df.withColumns({f"crop_{c}": (F.col(crop_col) == F.lit(c)).cast("int") for c in CROPS})


def crop_et(df: DataFrame, et0_col="et0", crop_col="crop_type", stage_col="growth_stage",
            default_crop: str = "mil", out: str = "etc") -> DataFrame:
    """ETc = ET0 * Kc(stage); Kc from the fixed crop table (broadcast); unknown crop -> default."""
    kc = dim(df.sparkSession, "crop_kc").withColumnRenamed("crop", "_kc_crop")
    key = F.when(F.col(crop_col).isin(CROPS), F.col(crop_col)).otherwise(F.lit(default_crop))
    j = df.withColumn("_crop_key", key).join(kc, F.col("_crop_key") == F.col("_kc_crop"), "left")
    k = kc_stage(F.col(stage_col), F.col("kc_initial"), F.col("kc_mid"), F.col("kc_end"), F.col("growing_days"))
    return j.withColumn(out, F.col(et0_col) * k).select(*df.columns, out)


def water_features(df: DataFrame, field_capacity: float = 0.4) -> DataFrame:
    return df.withColumns({
        "soil_water_deficit": soil_water_deficit(F.col("ssm"), field_capacity),
        "vegetation_stress": F.lit(1.0) - F.col("ndvi_normalized"),
        "irrigation_efficiency": irrigation_efficiency(F.col("wind_speed"), F.col("temp_range")),
    })


def growth_stage(df: DataFrame, date_col: str = "date", crop_col: str = "crop_type",
                 default_crop: str = "mil", out: str = "growth_stage") -> DataFrame:
    """Days since planting from the crop calendar: months since planting (wrapping the year) * 30
    + day of month, clamped to 1..180."""
    cal = dim(df.sparkSession, "crop_calendar").withColumnRenamed("crop", "_cal_crop")
    key = F.when(F.col(crop_col).isin(CROPS), F.col(crop_col)).otherwise(F.lit(default_crop))
    j = df.withColumn("_crop_key", key).join(cal, F.col("_crop_key") == F.col("_cal_crop"), "left")
    m = F.month(F.col(date_col))
    since = F.when(m >= F.col("planting_month"), m - F.col("planting_month")) \
        .otherwise(F.lit(12) - F.col("planting_month") + m)
    v = F.least(F.lit(180), F.greatest(F.lit(1), since * F.lit(30) + F.dayofmonth(F.col(date_col))))
    return j.withColumn(out, v.cast("int")).select(*df.columns, out) if out not in df.columns else \
        j.withColumn("_gs", v.cast("int")).drop(out).withColumnRenamed("_gs", out).select(*df.columns)


def flags_int(cond: Column) -> Column:
    return flag(cond)
