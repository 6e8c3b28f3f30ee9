"""Properties: partition-count invariance, exact quantiles under heavy skew, plan shape,
streaming equals batch, deterministic split."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from agrospark.operators import fill as D
from agrospark.operators.stats import threshold_quantiles


def _random_panel(spark, regions=5, days=60, seed=1):
    rnd = random.Random(seed)
    rows = []
    for r in range(regions):
        for d in range(days):
            v = None if rnd.random() < 0.3 else round(rnd.uniform(0, 10), 2)
            rows.append((f"R{r}", dt.date(2020, 1, 1) + dt.timedelta(days=d), v))
    return spark.createDataFrame(rows, "region string, date date, x double")


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_fills_independent_of_partitioning(spark):
    df = _random_panel(spark)
    a = D.fill_table_order(D.interpolate_linear(df.repartition(1), ["x"]), ["x"])
    b = D.fill_table_order(D.interpolate_linear(df.repartition(7, "date"), ["x"]), ["x"])
    assert _sorted(a) == _sorted(b)


def test_interpolation_keeps_known_values_and_rows(spark):
    df = _random_panel(spark)
    out = D.interpolate_linear(df, ["x"])
    assert out.count() == df.count()
    j = df.alias("a").join(out.alias("b"), ["region", "date"]).filter(F.col("a.x").isNotNull())
    assert j.filter(F.col("a.x") != F.col("b.x")).count() == 0


def test_rank_quantiles_exact_under_skew(spark):
    rnd = random.Random(7)
    vals = [5.0] * 3000 + [rnd.uniform(0, 100) for _ in range(6000)]   # one value holds a third of the rows
    df = spark.createDataFrame([(v, v * 2) for v in vals], "a double, b double")
    spec = {"a": [0.1, 0.2, 0.5, 0.9], "b": [0.33]}
    r = threshold_quantiles(df, spec, method="rank", slices=13).first().asDict()
    e = threshold_quantiles(df, spec, method="agg").first().asDict()
    for k in e:
        assert r[k] == pytest.approx(e[k], rel=1e-12)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_plans_have_no_python_udf(spark):
    from agrospark.operators.indices import drought_label
    from agrospark.plans.features import drought_features
    df = _random_panel(spark).select("region", "date", F.col("x").alias("total_precipitation_sum"),
                                     F.col("x").alias("temperature_2m"), F.col("x").alias("ssm"),
                                     F.col("x").alias("ndvi"))
    plan = _plan(drought_label(df))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("files,per_batch", [(1, 1), (5, 1), (5, 2)])
def test_streaming_dry_days_equals_batch(spark, tmp_path, files, per_batch):
    """Every day that the watermark has passed has the batch result, however the input is cut and up to the delay late;
    days still open wait in state."""
    from agrospark.operators.windows import consecutive_dry_days
    from agrospark.streaming.jobs import run_to_table, stream_dry_days
    df = _random_panel(spark).withColumnRenamed("x", "total_precipitation_sum")
    src = str(tmp_path / "in")
    lo, hi = df.agg(F.min(F.unix_date("date")), F.max(F.unix_date("date"))).first()
    at = F.unix_date("date") - lo + F.pmod(F.xxhash64("region", "date"), F.lit(8))           # up to a week late
    part = F.least(F.lit(files - 1), F.floor(at * files / (hi - lo + 1)))
    for i in range(files):
        df.filter(part == i).coalesce(1).write.mode("append").parquet(src)
    sdf = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(src)
    out = str(tmp_path / "out")
    run_to_table(stream_dry_days(sdf, delay="10 days"), out, str(tmp_path / "ck"))
    got = _sorted(spark.read.parquet(out).select("region", "date", "consecutive_dry_days"))
    want = consecutive_dry_days(df).filter(F.unix_date("date") < hi - 10)
    assert got and got == _sorted(want.select("region", "date", "consecutive_dry_days"))


def test_split_is_deterministic(spark):
    from agrospark.operators.ml import train_test_split
    df = _random_panel(spark)
    a = _sorted(train_test_split(df.repartition(3)).select("region", "date", "is_test"))
    b = _sorted(train_test_split(df.repartition(5)).select("region", "date", "is_test"))
    assert a == b
    share = sum(1 for r in a if r[2]) / len(a)
    assert 0.1 < share < 0.3


@pytest.mark.parametrize("block_rows", [3, 7, 64])
def test_blocked_windows_equal_series_windows(spark, block_rows):
    from agrospark.operators import windows as G
    df = _random_panel(spark, regions=4, days=90, seed=3).withColumnRenamed("x", "p")
    spec = {"m": "p"}
    a = G.moving_averages(df, spec, (2, 3), block_rows=None)
    b = G.moving_averages(df, spec, (2, 3), block_rows=block_rows)
    assert _sorted(a) == _sorted(b)
    a = G.rolling_sums(df, "p", (3,), block_rows=None)
    b = G.rolling_sums(df, "p", (3,), block_rows=block_rows)
    assert _sorted(a) == _sorted(b)
    a = G.lags(df, "p", (1, 3), block_rows=None)
    b = G.lags(df, "p", (1, 3), block_rows=block_rows)
    assert _sorted(a) == _sorted(b)
    a = G.rain_target(df, "p", block_rows=None)
    b = G.rain_target(df, "p", block_rows=block_rows)
    assert _sorted(a) == _sorted(b)
    a = G.consecutive_dry_days(df, "p", 5.0, block_rows=None)
    b = G.consecutive_dry_days(df, "p", 5.0, block_rows=block_rows)
    assert _sorted(a) == _sorted(b)


@pytest.mark.parametrize("block_rows", [2, 5, 50])
def test_blocked_interpolation_equals_series_interpolation(spark, block_rows):
    rnd = random.Random(11)
    rows = []
    for r in range(3):
        for d in range(40):
            v = None if rnd.random() < 0.6 else float(rnd.randint(0, 100))
            rows.append((f"R{r}", dt.date(2021, 3, 1) + dt.timedelta(days=d), v))
    rows += [("R9", dt.date(2021, 3, 1) + dt.timedelta(days=d), None) for d in range(10)]   # all-null series
    df = spark.createDataFrame(rows, "region string, date date, x double")
    a = D.interpolate_linear(df, ["x"])
    b = D.interpolate_linear(df, ["x"], block_rows=block_rows)
    assert _sorted(a) == _sorted(b)


def test_session_block_switch_keeps_feature_frames(spark):
    """agrospark.window.blockRows turns every per-series window into the blocked evaluation;
    the composite drought frame and label must not change."""
    from agrospark.operators.indices import drought_label
    from agrospark.plans.features import drought_features
    rnd = random.Random(5)
    rows = []
    for r in range(3):
        for d in range(80):
            def v(lo, hi, p=0.15):
                return None if rnd.random() < p else round(rnd.uniform(lo, hi), 2)
            rows.append((f"R{r}", dt.date(2020, 1, 1) + dt.timedelta(days=d), 1 + (d // 30) % 12, "Dry",
                         v(20, 35), v(0, 5), v(1e7, 2e7), v(290, 310), v(280, 300), v(10, 30), v(5, 25),
                         v(1000, 5000), v(1000, 6000), v(0.1, 0.6), v(0.1, 0.5), v(0.05, 0.5)))
    cols = ("region string, date date, month int, season string, temperature_2m double, "
            "total_precipitation_sum double, surface_solar_radiation_downwards_sum double, lst_day_1km double, "
            "lst_night_1km double, temp_day_celsius double, temp_night_celsius double, evi double, ndvi double, "
            "ndvi_normalized double, evi_normalized double, ssm double")
    df = spark.createDataFrame(rows, cols)

    import math

    def rows_of(frame):
        return {(r["region"], r["date"]): r for r in frame.collect()}

    def same(a, b):
        # global means/stds are float sums whose order follows the partitioning (the blocked plan
        # partitions differently): doubles agree to 1e-12 relative, everything else exactly
        assert a.keys() == b.keys()
        for k in a:
            for x, y in zip(a[k], b[k]):
                if isinstance(x, float) and isinstance(y, float):
                    assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12), (k, x, y)
                else:
                    assert x == y, (k, x, y)
    plain_f, plain_l = rows_of(drought_features(df)), rows_of(drought_label(df).drop("precip_sum_30"))
    spark.conf.set("agrospark.window.blockRows", "7")
    try:
        same(rows_of(drought_features(df)), plain_f)
        same(rows_of(drought_label(df).drop("precip_sum_30")), plain_l)
    finally:
        spark.conf.unset("agrospark.window.blockRows")


@pytest.mark.parametrize("block_rows", [1, 4, 1000])
def test_distributed_neighbour_carries(spark, block_rows):
    """Cross-region carries of the table-order fills, distributed over region blocks, equal the
    single-window version (many regions, runs of all-null regions, gaps at both table ends)."""
    rnd = random.Random(9)
    rows = []
    for r in range(60):
        empty = rnd.random() < 0.3
        for d in range(6):
            v = None if (empty or rnd.random() < 0.5) else float(rnd.randint(0, 50))
            rows.append((f"R{r:03d}", dt.date(2022, 5, 1) + dt.timedelta(days=d), v, None if r < 3 else v))
    df = spark.createDataFrame(rows, "region string, date date, x double, y double")
    a = _sorted(D.fill_table_order(df, ["x", "y"]))
    b = _sorted(D.fill_table_order(df, ["x", "y"], block_rows=block_rows))
    assert a == b
    a = _sorted(D.fallback_fill(df, ["x", "y"]))
    b = _sorted(D.fallback_fill(df, ["x", "y"], block_rows=block_rows))
    assert a == b
