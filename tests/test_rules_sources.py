"""Golden cases for the rule layer and the payload parsers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from agrospark.dims import dim
from agrospark.operators import rules as R
from agrospark.sources import json_feeds as J


def test_onecall_edge_cases(spark):
    payloads = [
        ("A", json.dumps({"current": {"dt": 0, "temp": 20, "humidity": 50, "pressure": 1000, "wind_speed": 1,
                                      "weather": []},                       # no rain, empty weather
                          "hourly": [],                                      # empty hourly
                          "daily": [{"dt": 86400, "temp": {"day": 25.5}, "humidity": 40, "pressure": 1001,
                                     "wind_speed": 2, "rain": 3.5, "weather": [{"description": "pluie"}]}]})),
        ("B", json.dumps({"hourly": [{"dt": 3600, "temp": 18.0, "humidity": 60, "pressure": 999,
                                      "wind_speed": 3, "rain": {"1h": 0.7}, "weather": [{"description": "x"}]}]})),
    ]
    df = spark.createDataFrame(payloads, "ville string, payload string")
    rows = {(r["ville"], r["type"]): r for r in J.parse_onecall(df).collect()}
    assert set(rows) == {("A", "current"), ("A", "daily"), ("B", "hourly")}      # B has no current
    assert rows[("A", "current")]["pluie"] == 0.0 and rows[("A", "current")]["description"] is None
    assert rows[("A", "current")]["temperature"] == 20.0                          # integer JSON value
    assert rows[("A", "daily")]["temperature"] == 25.5 and rows[("A", "daily")]["pluie"] == 3.5
    assert rows[("B", "hourly")]["pluie"] == 0.7
    assert rows[("A", "current")]["date"] == dt.datetime(1970, 1, 1, 0, 0)


def test_parse_current_defaults(spark):
    df = spark.createDataFrame([("D", json.dumps({"main": {"temp": 30, "humidity": 40, "pressure": 1010},
                                                  "clouds": {"all": 5}, "weather": [{"description": "clair"}]}))],
                               "city string, payload string")
    r = J.parse_current(df, wind_default=2.0).first()
    assert (r["wind_speed"], r["wind_direction"], r["visibility"]) == (2.0, 0.0, 10.0)


def test_disease_rule_levels(spark):
    cond = spark.createDataFrame([("c1", 27.0, 85.0, "Wet"), ("c2", 27.0, 10.0, "Wet"), ("c3", 40.0, 99.0, "Wet")],
                                 "city string, temperature double, humidity double, season string")
    out = {(r["city"], r["crop"]): r for r in R.disease_rules(cond).collect()}
    # riz: pyriculariose (25-30, >=90) medium only; helminthosporiose (28-35) temp fails; bacteriose (25-35, >=80) high
    assert out[("c1", "riz")]["risk_level"] == 2 and out[("c1", "riz")]["diseases"] == ["bacteriose"]
    # humidity too low everywhere, season matches -> medium for rules whose temperature range fits
    assert out[("c2", "mil")]["risk_level"] == 1 and out[("c2", "mil")]["diseases"] == ["charbon", "mildiou"]
    assert out[("c3", "mil")]["risk_level"] == 0 and out[("c3", "mil")]["diseases"] == []
    assert out[("c1", "mil")]["n_diseases"] == 3


def test_daily_alerts_order_and_limit(spark):
    ts = dt.datetime(2024, 1, 15, 12, 0)
    rows = [(1, "Tambacounda", ts, 1, 60.0, 5.0, 20.0), (2, "Dakar", ts, 1, 50.0, 50.0, 11.0),
            (3, "Thiès", ts, 1, 10.0, 5.0, 0.0), (4, "Dakar", ts - dt.timedelta(days=1), 1, 99.0, 1.0, 99.0)]
    df = spark.createDataFrame(rows, "reading_id long, city string, ts timestamp_ntz, month int, temperature double, "
                                     "humidity double, wind_speed double")
    got = [(r["city"], r["type"]) for r in R.daily_alerts(df, limit=3).collect()]
    # Dakar's current reading is id 2 (the older one is ignored): temp 50 > 35+3, wind 11 > 10;
    # then Thiès (humidity 5 < 25-10) before Tambacounda in city order; the limit keeps three
    assert got == [("Dakar", "Température"), ("Dakar", "Vent"), ("Thiès", "Sécheresse")]


@pytest.mark.parametrize("rain,sev,dis,band", [(20.0, 3, 3, "CRITIQUE"), (0.5, 2, 1, "MODÉRÉ"),
                                               (3.0, 2, 1, "ÉLEVÉ"), (3.0, 0, 0, "FAIBLE")])
def test_global_risk_bands(spark, rain, sev, dis, band):
    df = spark.createDataFrame([(rain, sev, dis)], "predicted_mm double, severity int, disease_class int")
    r = R.global_risk(df).first()
    assert r["global_risk"] == band


def test_score_all_cities_with_a_model(spark):
    """The model path: serving features from readings -> fitted pipeline -> severity from the model."""
    import random
    from agrospark.operators import ml as M
    from agrospark.plans.features import DROUGHT_FEATURES
    from agrospark.plans.scoring import score_all_cities
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        vals = [rnd.uniform(0, 1) for _ in DROUGHT_FEATURES]
        rows.append(tuple([f"R{i % 4}", dt.date(2020, 1, 1) + dt.timedelta(days=i)] + vals + [i % 3]))
    schema = "region string, date date, " + ", ".join(f"{c} double" for c in DROUGHT_FEATURES) + ", y int"
    df = spark.createDataFrame(rows, schema)
    fm = M.train_model(df, DROUGHT_FEATURES, "y", "drought", numTrees=3, maxDepth=3)
    readings = spark.createDataFrame(
        [(1, "Dakar", dt.datetime(2024, 1, 5, 8), 25.0, 60.0, 1010.0, 3.0, 0.0),
         (2, "Kaolack", dt.datetime(2024, 1, 5, 9), 31.0, 40.0, 1008.0, 4.0, 1.0)],
        "reading_id long, city string, ts timestamp_ntz, temperature double, humidity double, pressure double, "
        "wind_speed double, precipitation double")
    out = {r["city"]: r for r in score_all_cities(readings, {"drought": fm}).collect()}
    assert set(out) == {"Dakar", "Kaolack"}
    assert all(out[c]["severity"] in (0, 1, 2) for c in out)            # from the model's classes
    assert all(out[c]["frequency"] is not None for c in out)


def test_forecasts_of_one_split_are_parsed_on_every_core(spark, tmp_path):
    """Few and small event rows come in one split; their payloads are made and read by all tasks, the entries without a lambda (it read props for each)."""
    from agrospark.plans.q_sources import q_parse_forecast
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 7, "view" if i % 3 else None, None if i % 5 == 0 else i / 4,
             None if i % 4 == 0 else f'{{"k": {i % 90}}}') for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    df = q_parse_forecast(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["event_id"], r["pos"]): r for r in df.collect()}
    assert len(got) == df.count() == 8 * len(rows)
    for i, ts, _, kind, value, props in rows:
        for pos in range(8):
            r = got[i, pos]
            assert r["datetime"] == ts + dt.timedelta(hours=3 * pos) and r["weather_description"] == kind
            assert r["temperature"] == (None if value is None else value / 10 + pos * 0.5) and r["humidity"] == (None if props is None else i % 90)
            assert r["precipitation"] == (0.0 if pos % 2 or value is None else value / 50)
            assert (r["pressure"], r["wind_speed"], r["cloudiness"]) == (1000.0 + i % 30, (i % 150) / 10, i % 100)
