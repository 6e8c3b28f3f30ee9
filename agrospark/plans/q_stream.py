"""Registered queries: streaming jobs driven to completion over a landing folder (L1-L4).

The landing folder is written from the adapters (whole tables); the stream reads it with the
file source and an explicit schema, the sink is parquet under the shared checkpoint folder, and
the query returns the sink as a batch DataFrame. Streaming results equal the batch results.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from agrospark.dims import values_sql
from agrospark.functions.numeric import snap
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_panel import panel
from agrospark.plans.q_sources import _scratch
from agrospark.plans.registry import ORACLE, register
from agrospark.sources import adapters as A
from agrospark.streaming import jobs as L


def _land(spark, df, name, files: int = 4):
    path = _scratch(spark, f"landing-{name}")
    df.repartition(files).write.mode("overwrite").parquet(path)
    return path, df.schema


def _run_slices(spark, name, build, df, at, slices: int = 6, late=None, **sink):
    """Land ``df`` in ``slices`` steps in the order of the long column expression ``at`` (``late`` rows come last) and let the same query take up each
    step from its checkpoint, as a daily run does. A step is one micro-batch of as many files as its rows have partitions."""
    path, out, ck = _scratch(spark, f"landing-{name}"), _scratch(spark, f"sink-{name}"), _scratch(spark, f"ckpt-{name}")
    lo, hi = df.agg(F.min(at), F.max(at)).first()
    part = F.coalesce(F.least(F.lit(slices - 1), F.floor((at - F.lit(lo)) * F.lit(slices) / F.lit(hi - lo + 1))), F.lit(0))
    for step in [df.filter(part == i) for i in range(slices)] + ([late] if late is not None else []):
        step.write.mode("append").parquet(path)
        L.run_to_table(build(spark.readStream.schema(df.schema).parquet(path)), out, ck, **sink)
    return spark.read.parquet(out)


def _run(spark, name, build, stream_input, mode="append", files: int = 2):
    src, schema = stream_input
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
    out, ck = _scratch(spark, f"sink-{name}"), _scratch(spark, f"ckpt-{name}")
    L.run_to_table(build(sdf), out, ck, mode)
    return spark.read.parquet(out)


@register("stream_clean_weather", ORACLE["clean_weather"])
def q_stream_clean_weather(spark, sf):
    return _run(spark, "clean", lambda s: L.stream_clean_weather(s, "30 days"),
                _land(spark, A.meteo_raw(spark, sf), "meteo"))


@register("stream_alerts", ORACLE["alerts_all"])
def q_stream_alerts(spark, sf):
    return _run(spark, "alerts", L.stream_alerts, _land(spark, A.readings(spark, sf), "readings"))


_DAILY_SQL = f"""with r as ({A.READINGS_SQL}),
w as (select time_bucket(INTERVAL 1 DAY, ts) as window_start, city, count(*) as n, avg(temperature) as avg_temperature,
  avg(precipitation) as avg_precipitation from r group by 1, 2)
select window_start, window_start + INTERVAL 1 DAY as window_end, city, n,
  floor(avg_temperature * cast(1048576.0 as double) + 0.5) / cast(1048576.0 as double) as avg_temperature,
  floor(avg_precipitation * cast(1048576.0 as double) + 0.5) / cast(1048576.0 as double) as avg_precipitation
from w where window_start + INTERVAL 1 DAY <= (select max(ts) from r) - INTERVAL 1 HOUR"""


def _micros():
    return F.unix_micros(F.col("ts").cast("timestamp"))


def _daily(spark, readings, name, late=None):
    d = _run_slices(spark, name, lambda s: L.stream_daily_stats(s, "1 hour"), readings, _micros(), late=late)
    return d.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "city", "n",
                    snap(F.col("avg_temperature")).alias("avg_temperature"),
                    snap(F.col("avg_precipitation")).alias("avg_precipitation"))


@register("stream_daily_stats", _DAILY_SQL)
def q_stream_daily_stats(spark, sf):
    """Readings land in event-time order, so every closed window is whole however many files a step has."""
    return _daily(spark, A.readings(spark, sf), "rd")


@register("stream_daily_stats_late", _DAILY_SQL)
def q_stream_daily_stats_late(spark, sf):
    """The late-row rule: readings that come again after the watermark has passed them change nothing."""
    r = A.readings(spark, sf)
    cut = r.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.expr("a + (b - a) / 2")).first()[0]
    return _daily(spark, r, "rd-late", late=r.filter(F.col("ts") < F.lit(cut)))


@register("stream_dry_days", f"""{panel_ctes()},
a as (select region, date, row_number() over (partition by region order by date) as _pos,
        coalesce(total_precipitation_sum < cast(0.1 as double), false) as _dry from panel),
b as (select *, max(case when not _dry then _pos end) over (partition by region order by date rows between unbounded
        preceding and current row) as _lw from a)
select region, date, cast(case when _dry then _pos - coalesce(_lw, 0) else 0 end as integer) as consecutive_dry_days
from b where date < (select max(date) from panel) - INTERVAL 30 DAY""")
def q_stream_dry_days(spark, sf):
    """The panel in six steps that overlap: each row lands up to 20 days late, by a hash. Days that the watermark
    (30 days behind the last date) has passed are out."""
    p = panel(spark, sf).select("region", "date", "total_precipitation_sum")
    jitter = F.unix_date("date").cast("long") + F.pmod(F.xxhash64("region", "date"), F.lit(21))
    return _run_slices(spark, "dry", L.stream_dry_days, p, jitter)


@register("stream_top_alerts", f"""with a as ({ORACLE["alerts_all"]}),
m as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from ({A.READINGS_SQL}) r),
b as (select a.*, pc.city_rank, cast(least(5, floor((epoch_us(ts) - lo) * 6 / (hi - lo + 1))) as bigint) as batch_id
  from a join {values_sql('provider_cities', 'pc')} on a.city = pc.city, m)
select * from b qualify row_number() over (partition by batch_id order by city_rank, rule_rank, ts, reading_id) <= 3""")
def q_stream_top_alerts(spark, sf):
    """Per micro-batch (one event-time slice each) the first three alerts in (city, rule) order via a foreachBatch sink."""
    got = _run_slices(spark, "top", L.stream_alerts, A.readings(spark, sf), _micros(), foreach_batch=L.top_alerts_per_batch(3))
    return got.withColumn("batch_id", F.col("batch_id").cast("long"))
