"""The paths for many or hot series give the plain result, however the rows are dealt out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrospark.operators import blocked as B
from agrospark.operators import fill as D
from agrospark.operators import stats as ST
from agrospark.operators import windows as G


@pytest.fixture()
def dealt(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.exchange.reuse")}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def _regions(spark, n):
    x = F.xxhash64("region", "d")
    return (spark.range(2 * n).select(F.concat(F.lit("R"), F.lpad((F.col("id") % n).cast("string"), 7, "0")).alias("region"), (F.col("id") / n).cast("int").alias("d"))
            .select("region", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("date"),
                    *[F.when(F.pmod(x, F.lit(m)) == 0, (F.pmod(x, F.lit(1000))).cast("double")).alias(f"v{m}") for m in (2, 97, 5003)]))


def _digest(df):
    """Multiset fingerprint of the rows."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
    return df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(F.lit(i), *cols).cast("decimal(38,0)")) for i in (1, 2)]).first()


@pytest.mark.parametrize("dealt", [3, 8, 31], indirect=True)
def test_table_order_fills_of_100000_regions(spark, dealt):
    df = _regions(spark, 100_000).cache()
    cols = ["v2", "v97", "v5003"]
    assert _digest(D.fill_table_order(df, cols, block_rows=0)) == _digest(D.fill_table_order(df, cols, block_rows=100))
    assert _digest(D.fallback_fill(df, cols, block_rows=0)) == _digest(D.fallback_fill(df, cols, block_rows=1000))
    df.unpersist()


@pytest.mark.parametrize("dealt", [3, 8, 31], indirect=True)
def test_quantiles_of_a_million_rows(spark, dealt):
    n = 1_000_000
    df = spark.range(n).select(F.xxhash64("id").cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).cast("double").alias("ties"),
                               F.lit(None).cast("double").alias("none"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id")).alias("nan"))
    spec = {"a": [0.2, 0.8, 0.0, 1.0], "ties": [0.25, 0.5], "none": [0.5], "nan": [0.1]}
    got = ST.threshold_quantiles(df, spec).first().asDict()
    clean = df.withColumn("nan", F.when(~F.isnan("nan"), F.col("nan")))
    want = ST.threshold_quantiles(clean, spec, method="agg").first().asDict()
    assert got.keys() == want.keys() and got["none_q50"] is None
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in got if want[k] is not None)


def test_quantiles_bracket_again_and_widen(spark):
    df = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("a"))
    spec = {"a": [0.01, 0.333, 0.5, 0.99]}
    want = ST.threshold_quantiles(df, spec, method="agg").first()
    assert tuple(ST.exact_quantiles(df, spec, limit=10, accuracy=50).first()) == pytest.approx(tuple(want), rel=1e-12)
    assert ST.exact_quantiles(df.limit(0), spec).first().asDict() == {ST.qname("a", q): None for q in spec["a"]}


def test_blocks_keep_rows_without_region_or_date(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    rows = [("A", day(i), float(i % 4)) for i in range(70)] + [(None, day(i), None if i % 3 else float(i)) for i in range(40)] + [("B", None, 5.0), ("B", day(1), None), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "region string, date date, total_precipitation_sum double")
    for f in (lambda b: G.lags(df, block_rows=b), lambda b: G.rain_target(df, block_rows=b), lambda b: G.rolling_sums(df, periods=(7,), block_rows=b),
              lambda b: G.moving_averages(df, {"p": "total_precipitation_sum"}, (3,), block_rows=b), lambda b: G.consecutive_dry_days(df, block_rows=b),
              lambda b: D.interpolate_linear(df, ["total_precipitation_sum"], block_rows=b), lambda b: D.ffill_bfill(df, ["total_precipitation_sum"], block_rows=b),
              lambda b: D.fill_table_order(df, ["total_precipitation_sum"], block_rows=b)):
        plain = f(0)
        assert plain.count() == len(rows) and _digest(plain) == _digest(f(10))


def test_hot_series_switches_to_blocks(spark, monkeypatch):
    df = spark.range(100).select(F.lit("hot").alias("region"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    monkeypatch.setattr(B, "_CHOICE", {})
    assert B.resolve(df, None) == 0 and B.resolve(df, 7) == 7
    monkeypatch.setattr(B, "_CHOICE", {})
    monkeypatch.setattr(B, "HOT_SERIES_ROWS", 50)
    assert B.resolve(df, None) == B.BLOCK_ROWS and B.resolve(df, 0) == 0
