"""Aggregate reports and evaluation metrics.

Every report is one or two aggregation passes (map-side combined); per-class and per-model
metrics come from a confusion-count table whose size is classes^2 x models, never from
collecting predictions on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrospark.operators.stats import qname, threshold_quantiles


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


# ----------------------------------------------------------------------------- F4, F5, F6, F7

def profile_fao(df: DataFrame, quantiles: str = "rank") -> DataFrame:
    """One row: record count, distinct elements/items, year range, value describe()."""
    base = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("element").alias("unique_elements"),
        F.count_distinct("item").alias("unique_items"),
        F.min("year").alias("year_min"), F.max("year").alias("year_max"),
        F.count("value").alias("value_count"), F.avg("value").alias("value_mean"),
        F.stddev_samp("value").alias("value_std"), F.min("value").alias("value_min"),
        F.max("value").alias("value_max"))
    q = threshold_quantiles(df, {"value": [0.25, 0.5, 0.75]}, method=quantiles)
    return base.crossJoin(F.broadcast(q)).withColumnsRenamed(
        {qname("value", 0.25): "value_25", qname("value", 0.5): "value_50", qname("value", 0.75): "value_75"})


def top_items(df: DataFrame, col: str = "item", k: int = 5) -> DataFrame:
    """Value counts, top k (ties broken by the value itself)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col)).limit(k)


def class_distribution(df: DataFrame, label: str, by=None) -> DataFrame:
    return df.groupBy(*_by(by), label).agg(F.count(F.lit(1)).alias("n"))


def target_summary(df: DataFrame, col: str, by=None) -> DataFrame:
    return df.groupBy(*_by(by)).agg(F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"),
                                    F.count(col).alias("n"))


# ----------------------------------------------------------------------------- F8

def city_risk_summary(df: DataFrame, by=None, city: str = "city", rain: str = "predicted_mm",
                      severity: str = "severity", need: str = "irrigation_need",
                      rain_limit: float = 10.0, severity_limit: int = 2, need_limit: float = 6.0) -> DataFrame:
    """Cities over each threshold (sorted, distinct) and their counts, per group.
    A city list is bounded by the number of cities, not by the rows."""
    def cities(cond):
        return F.sort_array(F.collect_set(F.when(F.coalesce(cond, F.lit(False)), F.col(city))))
    g = df.groupBy(*_by(by)).agg(
        F.count_distinct(city).alias("total_cities"),
        cities(F.col(rain) > F.lit(rain_limit)).alias("high_rainfall_cities"),
        cities(F.col(severity) >= F.lit(severity_limit)).alias("drought_risk_cities"),
        cities(F.col(need) > F.lit(need_limit)).alias("high_irrigation_need_cities"))
    return g.withColumns({"n_high_rainfall": F.size("high_rainfall_cities"),
                          "n_drought_risk": F.size("drought_risk_cities"),
                          "n_high_irrigation_need": F.size("high_irrigation_need_cities")})


# ----------------------------------------------------------------------------- F10, F11

def clean_audit(raw: DataFrame, required=("date", "temperature", "humidite"),
                bounds=None) -> DataFrame:
    """Row accounting of the weather cleaning in one row: raw rows, duplicates removed, rows
    dropped as incomplete, rows dropped by the range filter, rows kept. Two aggregations."""
    from agrospark.operators.clean import METEO_NUMERIC, coerce_numeric
    bounds = bounds or {"humidite": (0.0, 100.0), "temperature": (-80.0, 60.0)}
    n_raw = raw.agg(F.count(F.lit(1)).alias("n_raw"))
    d = raw.dropDuplicates()
    complete = None
    for c in required:
        k = F.col(c).isNotNull()
        complete = k if complete is None else complete & k
    typed = coerce_numeric(d.withColumn("_complete", complete), METEO_NUMERIC)
    ok = None
    for c, (lo, hi) in bounds.items():
        k = F.coalesce(F.col(c).between(F.lit(lo), F.lit(hi)), F.lit(False))
        ok = k if ok is None else ok & k
    agg = typed.agg(F.count(F.lit(1)).alias("n_dedup"),
                    F.count_if(~F.col("_complete")).alias("n_incomplete"),
                    F.count_if(F.col("_complete") & ~ok).alias("n_out_of_range"),
                    F.count_if(F.col("_complete") & ok).alias("n_kept"))
    return n_raw.crossJoin(agg).select("n_raw", (F.col("n_raw") - F.col("n_dedup")).alias("n_duplicates"),
                                       "n_incomplete", "n_out_of_range", "n_kept")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Completeness per column from one aggregation pass, returned as rows (column, n, non-null)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
    return one.selectExpr("_n as n_rows", f"stack({len(cols)}, {stack}) as (column_name, n_non_null)") \
        .withColumn("completeness", F.col("n_non_null") / F.col("n_rows"))


# ----------------------------------------------------------------------------- J8-J12

def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by="model") -> DataFrame:
    """MSE, RMSE, R^2 (= 1 - MSE / population variance of y), MAE, MAPE (denominator max(y, 1e-8))."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*_by(by)).agg(
        F.avg(e * e).alias("mse"), F.var_pop(y).alias("_var"), F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(e / F.greatest(F.col(y), F.lit(1e-8)))) * F.lit(100.0)).alias("mape"),
        F.count(F.lit(1)).alias("n"))
    return g.select(*_by(by), "mse", F.sqrt("mse").alias("rmse"),
                    F.when(F.col("_var") != 0, F.lit(1.0) - F.col("mse") / F.col("_var")).alias("r2"),
                    "mae", "mape", "n")


def confusion_matrix(df: DataFrame, y: str = "y", yhat: str = "yhat", by="model") -> DataFrame:
    return df.groupBy(*_by(by), F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, y: str = "y", yhat: str = "yhat", by="model") -> DataFrame:
    """Per class: support, predicted count, true positives, precision, recall, F1 (0 when undefined)."""
    b = _by(by)
    cm = confusion_matrix(df, y, yhat, by)
    as_true = cm.groupBy(*b, F.col("y").alias("label")).agg(F.sum("n").alias("support"),
                                                            F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n"))
                                                                  .otherwise(F.lit(0))).alias("tp"))
    as_pred = cm.groupBy(*b, F.col("yhat").alias("label")).agg(F.sum("n").alias("predicted"))
    r = as_true.join(as_pred, b + ["label"], "full").na.fill(0, ["support", "tp", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rc = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    r = r.withColumns({"precision": p, "recall": rc})
    f1 = F.when(F.col("precision") + F.col("recall") > 0, F.lit(2.0) * F.col("precision") * F.col("recall")
                / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return r.withColumn("f1", f1)


def classification_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by="model") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 (zero_division = 0)."""
    b = _by(by)
    rep = class_report(df, y, yhat, by)
    w = Window.partitionBy(*b) if b else Window.partitionBy(F.lit(1))
    rep = rep.withColumn("_n", F.sum("support").over(w))
    return rep.groupBy(*b).agg(
        (F.sum("tp") / F.first("_n")).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / F.first("_n")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.first("_n")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.first("_n")).alias("f1"),
        F.first("_n").alias("n"))


def residual_histogram(df: DataFrame, y: str = "y", yhat: str = "yhat", bins: int = 30, by="model") -> DataFrame:
    """Equal-width histogram of residuals y - yhat per group (last bin closed), bins with rows only."""
    b = _by(by)
    r = df.select(*b, (F.col(y) - F.col(yhat)).alias("residual"))
    mm = r.groupBy(*b).agg(F.min("residual").alias("_lo"), F.max("residual").alias("_hi"))
    # per-group bounds: joined back (AQE broadcasts it at run time when small); one row if ungrouped
    j = r.join(mm, b) if b else r.crossJoin(F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("residual") - F.col("_lo")) / width).cast("int")))
    return j.withColumn("bin", idx).groupBy(*b, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi")) \
        .withColumns({"bin_start": F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))}) \
        .drop("lo", "hi")


def best_model(metrics: DataFrame, metric: str, family: str | None = None, model: str = "model") -> DataFrame:
    """Model with the highest ``metric`` (per family if given); ties -> smallest model name."""
    b = _by(family)
    top = metrics.groupBy(*b).agg(F.max(metric).alias("_best"))
    j = metrics.join(top, b) if b else metrics.crossJoin(F.broadcast(top))   # no family: one row
    return j.filter(F.col(metric) == F.col("_best")).groupBy(*b).agg(F.min(model).alias(model),
                                                                      F.first("_best").alias(metric))
