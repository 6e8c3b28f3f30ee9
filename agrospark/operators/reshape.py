"""Reshape, set and join operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trend_wide(df: DataFrame, cities: Sequence[str], value: str = "precipitation", day: str = "day",
               city: str = "city") -> DataFrame:
    """One row per day, one column per city (pivot with an explicit value list: no extra pass to
    discover the pivot values)."""
    return df.groupBy(day).pivot(city, list(cities)).agg(F.avg(value))


def trend_long(wide: DataFrame, day: str = "day", city: str = "city", value: str = "value") -> DataFrame:
    cols = [c for c in wide.columns if c != day]
    return wide.unpivot([day], cols, city, value)


def water_need_compare(df: DataFrame, keys=("region", "date"),
                       metrics=(("ET0", "et0"), ("ETc", "etc"), ("Besoin irrigation", "irrigation_need"))) -> DataFrame:
    """Long rows (metric, value) for the ET0 / ETc / need comparison."""
    return df.unpivot(list(keys), [c for _, c in metrics], "metric_col", "value") \
        .withColumn("metric", F.element_at(F.create_map(*[x for n, c in metrics for x in (F.lit(c), F.lit(n))]),
                                           F.col("metric_col"))).drop("metric_col")


def city_region_overlap(cities: DataFrame, regions: DataFrame, city: str = "city", region: str = "region") -> DataFrame:
    """Cities flagged by whether a satellite region of the same name exists (semi/anti join in one
    left join against the distinct region names)."""
    r = regions.select(F.col(region).alias("_r")).distinct()
    return cities.join(r, F.col(city) == F.col("_r"), "left").withColumn("in_regions", F.col("_r").isNotNull()) \
        .drop("_r")


def panel_with_weather(panel: DataFrame, meteo: DataFrame, region: str = "region", city: str = "ville",
                       ts: str = "date", measures=("temperature", "humidite", "pluie")) -> DataFrame:
    """Panel left-joined with daily station means on (region = city, day). The station side is
    pre-aggregated per (city, day) before the join, so the join key is unique on that side."""
    daily = meteo.withColumn("_day", F.to_date(F.col(ts))).groupBy(F.col(city).alias("_city"), "_day") \
        .agg(*[F.avg(m).alias(f"station_{m}") for m in measures])
    j = panel.join(daily, (F.col(region) == F.col("_city")) & (F.col("date") == F.col("_day")), "left")
    return j.drop("_city", "_day")


def merge_append(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Idempotent append: new rows whose key is not already present (left anti join), plus existing."""
    return existing.unionByName(new.join(existing.select(*keys), list(keys), "left_anti"))


def training_frame(df: DataFrame, features: Sequence[str], label: str, keys=("region", "date")) -> DataFrame:
    """Features and label in one frame; rows with any missing feature or label are dropped."""
    return df.select(*keys, *features, label).dropna(how="any", subset=list(features) + [label])
