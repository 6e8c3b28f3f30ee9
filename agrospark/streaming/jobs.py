"""Structured Streaming re-expressions of the batch pipelines (L1-L4).

The platform polls on a schedule; a Spark user would run these as streaming queries over a
landing folder (file source) with checkpointed state, so a restarted driver resumes exactly
where it stopped. Each builder takes a streaming DataFrame and returns one; ``run_to_table``
drives a query to completion with ``trigger(availableNow=True)`` into a parquet folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrospark.dims import PROVIDER_CITIES
from agrospark.operators import clean as C
from agrospark.operators import rules as R


# ----------------------------------------------------------------------------- L1

def stream_clean_weather(sdf: DataFrame, delay: str = "1 day", ts: str = "date") -> DataFrame:
    """Dedup within the watermark, drop incomplete rows, coerce, range-filter. Rows without an
    event time are dropped first (they could never be deduplicated by time, and the batch
    pipeline drops them anyway). Repeats are recognised within ``delay`` of event time: a row more than that
    behind the largest time seen is late and dropped, and state for older rows is released."""
    ntz = isinstance(sdf.schema[ts].dataType, T.TimestampNTZType)
    s = sdf.filter(F.col(ts).isNotNull())
    if ntz:   # watermarks need a zoned timestamp; the session zone (UTC) makes the cast lossless
        s = s.withColumn(ts, F.col(ts).cast("timestamp"))
    s = s.withWatermark(ts, delay).dropDuplicatesWithinWatermark()
    s = C.drop_incomplete(s, ["date", "temperature", "humidite"])
    s = C.coerce_numeric(s, C.METEO_NUMERIC)
    s = C.plausible_range(s)
    return s.withColumn(ts, F.col(ts).cast("timestamp_ntz")) if ntz else s


# ----------------------------------------------------------------------------- L2

def stream_alerts(sdf: DataFrame) -> DataFrame:
    """Stateless alert rules: stream-static join with the fixed norms table (broadcast)."""
    return R.alert_rows(R.seasonal_norms(sdf))


def top_alerts_per_batch(limit: int = 3):
    """foreachBatch body: the first ``limit`` alerts of each micro-batch in (city, rule) order."""
    def body(batch: DataFrame, batch_id: int, path: str):
        cities = batch.sparkSession.createDataFrame([(c, i) for i, (c, _, _) in enumerate(PROVIDER_CITIES)],
                                                    "city string, city_rank int")
        (batch.join(F.broadcast(cities), "city").orderBy("city_rank", "rule_rank", "ts", "reading_id").limit(limit)
         .withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path))
    return body


# ----------------------------------------------------------------------------- L3

def stream_daily_stats(sdf: DataFrame, delay: str = "1 hour", ts: str = "ts", city: str = "city",
                       measures: Sequence[str] = ("temperature", "precipitation")) -> DataFrame:
    """Tumbling 1-day windows per city; append mode emits a window once the watermark passes it."""
    if isinstance(sdf.schema[ts].dataType, T.TimestampNTZType):
        sdf = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    s = sdf.withWatermark(ts, delay).groupBy(F.window(F.col(ts), "1 day").alias("w"), F.col(city)).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in measures])
    return s.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), city, "n",
                    *[f"avg_{m}" for m in measures])


# ----------------------------------------------------------------------------- L4

DRY_STATE = "last int, run int, days array<int>, rain array<double>"
DRY_OUT = "region string, date date, consecutive_dry_days int"
_DAY_MS = 86_400_000


def _dry_days_fn(threshold: float):
    def fn(key, pdfs, state):
        import datetime as dt
        import math

        import pandas as pd
        last, run, days, rain = state.get if state.exists else (None, 0, [], [])
        waiting = dict(zip(days, rain))
        for pdf in pdfs:
            for d, p in zip(pdf["day"], pdf["rain"]):
                d, p = int(d), math.inf if p is None or pd.isna(p) else float(p)     # a missing value counts as wet
                if last is None or d > last:
                    waiting[d] = min(p, waiting.get(d, p))                           # a repeated day counts once
        mark = state.getCurrentWatermarkMs()
        out = []
        for d in sorted(waiting):
            if d * _DAY_MS >= mark:
                break
            run = run + 1 if waiting.pop(d) < threshold else 0
            last = d
            out.append((key[0], dt.date(1970, 1, 1) + dt.timedelta(d), run))
        state.update((last, run, list(waiting), [float(x) for x in waiting.values()]))
        if waiting:
            state.setTimeoutTimestamp(max(min(waiting) * _DAY_MS, mark + 1))
        yield pd.DataFrame(out, columns=["region", "date", "consecutive_dry_days"])
    return fn


def stream_dry_days(sdf: DataFrame, threshold: float = 0.1, delay: str = "30 days") -> DataFrame:
    """Dry-run length as keyed state: the days of a region wait in its state until the watermark (largest date seen
    minus ``delay``) has passed them, then count in date order. The result does not depend on how the input is cut
    into files or batches, as long as no row is more than ``delay`` late; later rows are dropped by the watermark.
    State holds the days within ``delay`` per region, never the history."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    s = sdf.select("region", F.unix_date("date").alias("day"), F.col("total_precipitation_sum").alias("rain"),
                   F.timestamp_millis(F.unix_date("date").cast("long") * F.lit(_DAY_MS)).alias("ts")).filter("day is not null")
    return s.withWatermark("ts", delay).groupBy("region").applyInPandasWithState(
        _dry_days_fn(threshold), DRY_OUT, DRY_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# ----------------------------------------------------------------------------- driver helper

def run_to_table(sdf: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                 foreach_batch=None, timeout_s: int = 600) -> None:
    """Run a streaming query until the available input is consumed (availableNow), writing parquet.
    The checkpoint folder holds offsets and state; rerunning with it resumes, it does not redo."""
    w = sdf.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(lambda b, i: foreach_batch(b, i, path)).start()
    else:
        q = w.format("parquet").option("path", path).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"streaming query did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
