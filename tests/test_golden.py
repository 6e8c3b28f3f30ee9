"""Hand-checked mini frames for every quirk of the platform's semantics (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agrospark.functions.agro import et0
from agrospark.functions.numeric import score_cut
from agrospark.functions.rolling import strict_avg
from agrospark.operators import fill as D
from agrospark.operators import indices as H
from agrospark.operators import windows as G
from agrospark.operators.stats import threshold_quantiles


def series(spark, values, region="a", name="x"):
    d0 = dt.date(2020, 1, 1)
    rows = [(region, d0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"region string, date date, {name} double")


def col_of(df, name="x", region=None):
    if region is not None:
        df = df.filter(F.col("region") == region)
    return [r[name] for r in df.orderBy("region", "date").collect()]


def test_interpolate_positional_with_ends(spark):
    out = D.interpolate_linear(series(spark, [None, 1, None, None, 4, None]), ["x"])
    assert col_of(out) == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_interpolate_all_null_series_stays_null(spark):
    out = D.interpolate_linear(series(spark, [None, None, None]), ["x"])
    assert col_of(out) == [None, None, None]


def test_fallback_fill_takes_next_region_first_value(spark):
    df = series(spark, [None, None], "a").unionByName(series(spark, [1, 2, 3, 4], "b")) \
        .unionByName(series(spark, [None, None], "c"))
    out = D.fallback_fill(df, ["x"])
    assert col_of(out, region="a") == [1.0, 1.0]
    assert col_of(out, region="b") == [1.0, 2.0, 3.0, 4.0]
    assert col_of(out, region="c") == [None, None]          # an all-null last region stays null


def test_fill_table_order_carries_previous_region(spark):
    df = series(spark, [1, 2], "a").unionByName(series(spark, [None, 5, None], "b"))
    out = D.fill_table_order(df, ["x"])
    assert col_of(out, region="b") == [2.0, 5.0, 5.0]        # warm-up row takes region a's last value
    out_r = D.fill_table_order(df, ["x"], scope="region")
    assert col_of(out_r, region="b") == [5.0, 5.0, 5.0]


def test_strict_moving_average(spark):
    df = series(spark, [1, 2, None, 4, 5])
    w = Window.partitionBy("region").orderBy("date")
    out = df.withColumn("ma", strict_avg(F.col("x"), w, 2))
    assert col_of(out, "ma") == [None, 1.5, None, None, 4.5]


def test_consecutive_dry_days(spark):
    # dry = value < 0.1; flags 1,1,0,0,1,1,1
    df = series(spark, [0, 0, 5, 5, 0, 0.05, 0], name="total_precipitation_sum")
    out = G.consecutive_dry_days(df)
    assert col_of(out, "consecutive_dry_days") == [1, 2, 0, 0, 1, 2, 3]


def test_null_precipitation_counts_as_wet(spark):
    df = series(spark, [0, None, 0], name="total_precipitation_sum")
    assert col_of(G.consecutive_dry_days(df), "consecutive_dry_days") == [1, 0, 1]


@pytest.mark.parametrize("method", ["rank", "agg"])
def test_quantile_linear_interpolation(spark, method):
    df = series(spark, [1, 2, 3, 10, None])
    q = threshold_quantiles(df, {"x": [0.2]}, method=method).first()[0]
    assert q == pytest.approx(1.6)
    std = df.agg(F.stddev_samp("x")).first()[0]
    assert std == pytest.approx(4.08248290463863)


def test_score_cuts_keep_float_addition(spark):
    df = spark.createDataFrame([(1,)], "k int")
    d = df.select(
        score_cut(F.lit(0.3), H.DISEASE_EDGES).alias("a"),
        score_cut(F.lit(0.2) + F.lit(0.1), H.DISEASE_EDGES).alias("b"),
        score_cut(F.lit(0.4) + F.lit(0.2), H.DISEASE_EDGES).alias("c"),
        score_cut(F.lit(0.4) + F.lit(0.3) + F.lit(0.1), H.DISEASE_EDGES).alias("d"),
        score_cut(F.lit(0.2), H.DROUGHT_EDGES).alias("e"),
        score_cut(F.lit(0.3), H.DROUGHT_EDGES).alias("f"),
        score_cut(F.lit(0.2) + F.lit(0.2), H.DROUGHT_EDGES).alias("g"),
        score_cut(F.lit(0.3) + F.lit(0.3), H.DROUGHT_EDGES).alias("h"),
        score_cut(F.lit(0.2) + F.lit(0.3) + F.lit(0.2), H.DROUGHT_EDGES).alias("i"),
    ).first()
    assert list(d) == [0, 1, 2, 2, 0, 1, 1, 2, 3]


def test_et0_missing_input_is_zero(spark):
    df = spark.createDataFrame([(30.0, 20.0, None, 2.0, 20.0)], "tmax double, tmin double, h double, w double, s double")
    v = df.select(et0(F.col("tmax"), F.col("tmin"), F.col("h"), F.col("w"), F.col("s"))).first()[0]
    assert v == 0.0


def test_crop_et_stages_extrapolate(spark):
    rows = [(1.0, "mil", s) for s in (30, 60, 90, 120, 150)] + [(1.0, "unknown", 30)]
    df = spark.createDataFrame(rows, "et0 double, crop_type string, growth_stage int")
    out = [r["etc"] for r in H.crop_et(df).orderBy("crop_type", "growth_stage").collect()]
    assert out[:5] == pytest.approx([0.3, 0.65, 1.0, 0.4, -0.2])
    assert out[5] == pytest.approx(0.3)                      # unknown crop falls back to mil


def test_irrigation_need_clipped(spark):
    df = spark.createDataFrame([(10.0, 0.0, 0.4, 0.3), (0.0, 50.0, 0.0, 1.0), (None, 1.0, 0.1, 0.5)],
                               "etc double, total_precipitation_sum double, soil_water_deficit double, "
                               "irrigation_efficiency double")
    out = [r["irrigation_need"] for r in H.irrigation_need(df).collect()]
    assert out[0] == 15.0 and out[1] == 0.0 and out[2] is None


def test_merge_by_rank_priority_and_ties(spark):
    from agrospark.operators.clean import dedup_first_in_series, merge_by_rank
    d = dt.date(2020, 1, 1)
    rows = [  # region, date, lat, lon, rank, a, b
        ("r", d, 1.0, 2.0, 2, 5.0, None),
        ("r", d, 1.0, 2.0, 1, None, 7.0),
        ("r", d, 1.0, 2.0, 1, 3.0, 9.0),     # same source twice: the smaller value wins
        ("r", d, 1.0, 2.0, 1, 4.0, None),
        ("r", d, 0.5, 2.0, 3, None, 1.0),    # another location of the same day
        (None, d, 1.0, 2.0, 1, 100.0, 100.0),
    ]
    df = spark.createDataFrame(rows, "region string, date date, lat double, lon double, rank int, a double, b double")
    m = merge_by_rank(df, ["region", "date", "lat", "lon"], "rank", ["a", "b"], ["S1", "S2", "S3"], "src")
    got = {(r["lat"]): (r["a"], r["b"], r["src"]) for r in m.collect()}
    assert got == {1.0: (3.0, 7.0, "S1"), 0.5: (None, 1.0, "S3")}
    one = dedup_first_in_series(m, "region", "date", ("lat", "lon")).collect()
    assert len(one) == 1 and one[0]["lat"] == 0.5          # smallest (lat, lon) row kept, nulls and all


def test_ridge_mapping_matches_closed_form(spark):
    """alpha -> regParam = alpha * sigma_y / n reproduces sklearn's Ridge on standardised inputs."""
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = x @ np.array([1.5, -2.0]) + rng.normal(scale=0.5, size=200) + 3.0
    alpha = 5.0
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)       # Ridge with intercept
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    reg = alpha * float(np.std(y)) / len(y)
    m = LinearRegression(featuresCol="f", labelCol="y", regParam=reg, elasticNetParam=0.0, standardization=False,
                         solver="normal").fit(v)
    assert list(m.coefficients) == pytest.approx(list(w), rel=1e-6)
