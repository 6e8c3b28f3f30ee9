"""Broken payloads are named and kept; good ones reach the parsers."""

import pytest

from agrospark.sources import quarantine as Q

CASES = {
    "current": [(None, "empty"), (" \t", "empty"), ("{", "malformed"), ('{"main": 1', "malformed"), ("[]", "not an object"), ("3", "not an object"), ("null", "not an object"),
                ("{}", "missing main.temp"), ('{"main": 5}', "missing main.temp"), ('{"main": {"temp": null, "humidity": 2, "pressure": 3}}', "missing main.temp"),
                ('{"main": {"temp": 1, "pressure": 3}}', "missing main.humidity"), ('{"main": {"temp": "1.5", "humidity": 2, "pressure": 3}}', "not a number: main.temp"),
                ('{"main": {"temp": 1, "humidity": 2, "pressure": 3}, "visibility": "far"}', "not a number: visibility"),
                ('{"main": {"temp": 1.5, "humidity": 2, "pressure": 3e2}, "visibility": null, "more": [1]}', None),
                ('{"main": {"temp": 1.5, "temp": 2}}', "malformed")],
    "onecall": [("{}", None), ('{"current": {"dt": 1, "temp": "x"}}', "not a number: current.temp"), ('{"hourly": {"dt": 1}}', "not an array: hourly"),
                ('{"hourly": [{"dt": 1, "temp": 2}, {"temp": 2}]}', "entry of hourly: dt"), ('{"daily": [{"dt": 1, "temp": {"day": 3}}], "hourly": []}', None),
                ('{"daily": [{"dt": 1, "temp": 3}]}', "entry of daily: temp.day")],
    "forecast": [("{}", "missing list"), ('{"list": []}', None), ('{"list": 4}', "not an array: list"), ('{"list": [null]}', "entry of list: dt"),
                 ('{"list": [{"dt": 1, "main": {"temp": 4}}]}', None)],
    "geocode": [("{}", "not an array"), ("[]", None), ('[{"lat": 1, "lon": 2}]', None), ('[{"lat": 1}]', "entry of root: lon")],
}


@pytest.mark.parametrize("feed", CASES)
def test_reasons(spark, feed):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES[feed])] + [], "ville int, payload string")
    got = {r["ville"]: r["reason"] for r in Q.checked(df, feed).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES[feed])}
    assert Q.checked(df.limit(0), feed).count() == 0


def test_split_adds_up(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES["current"] * 2)], "city int, payload string")
    good, bad = Q.split(df, "current")
    assert good.count() + bad.count() == df.count() and good.count() == 2 and bad.columns == ["city", "payload", "reason"]
    assert good.first()["temperature"] == 1.5 and good.first()["visibility"] == 10.0
