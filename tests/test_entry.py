"""Driver contract and a small oracle run (sf0.001) for a sample of queries."""

import math

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["clean_weather", "build_panel", "drought_label", "drought_features", "irrigation_need", "disease_rules",
          "daily_alerts", "panel_with_weather", "null_profile", "dedup_key", "serving_features", "stream_dry_days", "stream_daily_stats_late", "classification_metrics", "parse_onecall", "zonal_mean", "global_risk", "trend_wide"]


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    drows = sorted((tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert srows == drows
    assert srows, "an empty answer checks nothing"
    assert all(any(r[i] is not None for r in srows) for i in range(len(cols))), "a column is null throughout"
