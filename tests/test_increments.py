"""Loads in steps equal one run over everything: the panel store, the summaries; the as-of join and the exact split."""

import datetime as dt
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from agrospark.operators import ml as M
from agrospark.operators.asof import asof_join
from agrospark.operators.clean import PANEL_COLUMNS, PANEL_NUMERIC
from agrospark.operators.stats import threshold_quantiles
from agrospark.operators.summaries import SummaryStore
from agrospark.plans.incremental import BLOCK, MEASURES, PanelStore
from agrospark.plans.panel import build_panel

D0 = dt.date(2023, 1, 1)
SCHEMA = "region string, date date, latitude double, longitude double, source_rank int, " + ", ".join(f"{c} double" for c in MEASURES)


def _raw(rng, n=500):
    """Sparse rows of six regions over two and a half years; one region knows one measure only, one has a single row."""
    rows = []
    for _ in range(n):
        r = rng.choice("ABCDE")
        known = ["ndvi"] if r == "C" else rng.sample(MEASURES, 3)
        rows.append((r, D0 + dt.timedelta(days=int(rng.random() ** 2 * 900)), rng.choice([1.0, 2.0]), 3.0, rng.randint(1, 5), *[round(rng.random() * 9, 3) if c in known else None for c in MEASURES]))
    rows += [("F", D0 + dt.timedelta(days=400), 1.0, 1.0, 2, *[None] * len(MEASURES)), (None, D0, 1.0, 1.0, 1, *[5.0] * len(MEASURES))]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*PANEL_COLUMNS).collect()), key=repr)


def test_panel_store(spark, tmp_path):
    rng = random.Random(2)
    raw = _raw(rng)
    raw.sort(key=lambda r: r[1])
    parts = [raw[:300], raw[300:480], raw[480:]]
    late = [parts[0].pop(rng.randrange(len(parts[0]))) for _ in range(5)]              # late rows of old months
    parts[1] += late + parts[1][:3]                                                    # and rows that come twice
    s = PanelStore(spark, f"file://{tmp_path}/store")
    done = []
    for p in parts:
        before = now if done else {}
        done += p
        report = s.append(_frame(spark, p))
        now = _by_block(s.panel())
        assert len(done) < len(raw) or _rows(s.panel()) == _rows(build_panel(_frame(spark, done)))
        wrote = {(r["region"], r["block"]) for r in s.blocks().filter(F.col("panel_generation") == s.generation()).select(*BLOCK).collect()}
        assert {b for b in now if now[b] != before.get(b)} <= wrote
        assert report["rows"] == sum(map(len, now.values())) and report["rows_rewritten"] == sum(len(now[b]) for b in wrote)
    assert report["blocks_changed"] + report["blocks_carried"] < report["blocks"]       # the last load leaves blocks alone
    # the whole table again: nothing to do; rows taken away and changed: only their blocks
    full = _frame(spark, done)
    assert s.refresh(full)["rows_rewritten"] == 0
    gone = [r for r in done if not (r[0] == "B" and r[1].month == 3)]
    changed = [(*r[:5], *[7.5 if x is not None else None for x in r[5:]]) if r[0] == "D" and r[1] > D0 + dt.timedelta(days=700) else r for r in gone]
    report = s.refresh(_frame(spark, changed))
    assert _rows(s.panel()) == _rows(build_panel(_frame(spark, changed))) and 0 < report["rows_rewritten"] < report["rows"]
    # a load that broke off before its log row is invisible, and is run again
    g = s.generation()
    for layer in ("panel", "blocks", "ranked"):
        spark.read.parquet(f"{s.path}/{layer}/generation={g}").write.parquet(f"{s.path}/{layer}/generation={g + 1}")
    assert s.generation() == g
    more = _raw(random.Random(9), 20)
    s.append(_frame(spark, more))
    want = _rows(build_panel(_frame(spark, changed + more)))
    assert _rows(s.panel()) == want
    s.compact()
    assert _rows(s.panel()) == want and s.log().count() == s.generation()


def _by_block(panel):
    out = {}
    for r in panel.collect():
        out.setdefault((r["region"], r["date"].replace(day=1)), []).append(tuple(r))
    return {k: sorted(v, key=repr) for k, v in out.items()}


def test_panel_store_empty(spark, tmp_path):
    s = PanelStore(spark, f"file://{tmp_path}/store")
    assert s.append(_frame(spark, []))["rows"] == 0 and s.panel().count() == 0
    raw = _raw(random.Random(4), 40)
    s.append(_frame(spark, raw))
    assert _rows(s.panel()) == _rows(build_panel(_frame(spark, raw)))
    assert s.refresh(_frame(spark, []))["blocks"] == 0 and s.panel().count() == 0


def test_summaries(spark, tmp_path):
    rng = random.Random(1)
    spec = {"x": [0.0, 0.2, 0.5, 1.0], "y": [0.8], "z": [0.5], "none": [0.5]}
    rows = [(rng.gauss(0, 1), float(rng.randint(0, 4)) if rng.random() < 0.9 else None, float("nan") if i % 7 == 0 else rng.random(), None) for i in range(3000)]
    frame = lambda r: spark.createDataFrame(r, "x double, y double, z double, none double").repartition(5)
    s = SummaryStore(spark, f"file://{tmp_path}/s", spec, margin=0.06)
    for a, b in ((0, 1000), (1000, 1001), (1001, 3000), (3000, 3000)):
        s.append(frame(rows[a:b]))
        want = threshold_quantiles(frame(rows[:b]), spec).first().asDict()
        assert s.drifted() == [] and s.quantiles().first().asDict() == pytest.approx(want, nan_ok=True)
    m = {r["column"]: r for r in s.moments().collect()}
    st = frame(rows).agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"), F.max("y").alias("y")).first()
    assert m["x"]["mean"] == pytest.approx(st["m"]) and m["x"]["std"] == pytest.approx(st["s"]) and m["y"]["hi"] == st["y"] and "none" not in m
    # drift: the rank leaves the bracket, which is seen, not answered wrongly
    far = [(50.0 + rng.random(), 9.0, 5.0, None) for _ in range(4000)]
    s.append(frame(far))
    assert "x_q50" in s.drifted() and s.quantiles().first()["x_q50"] is None
    s.rebracket(frame(rows + far))
    s.append(frame(rows[:50]))
    want = threshold_quantiles(frame(rows + far + rows[:50]), spec).first().asDict()
    assert s.drifted() == [] and s.quantiles().first().asDict() == pytest.approx(want, nan_ok=True)
    assert s.loads() == [1, 2, 3, 4, 5, 6]


def test_asof(spark):
    rng = random.Random(3)
    series = ["a", "b", None, "only left"]
    right = {(s, D0 + dt.timedelta(days=rng.randrange(500))): rng.random() for s in series[:3] for _ in range(40)}
    left = [(i, rng.choice(series), None if i % 50 == 0 else D0 + dt.timedelta(days=rng.randrange(-50, 900))) for i in range(600)]
    r = spark.createDataFrame([(s, d, v) for (s, d), v in right.items()], "region string, date date, v double").repartition(4)
    x = spark.createDataFrame(left, "id int, region string, day date").repartition(6)
    days = {s: sorted(d for t, d in right if t == s) for s in series}

    def want(i, s, d, age):
        k = bisect_right(days[s], d) if d else 0
        m = days[s][k - 1] if k else None
        m = m if m and (age is None or (d - m).days <= age) else None
        return (i, s, d, m, right.get((s, m)))

    for age, block in ((None, 31), (20, 31), (None, 1), (None, 10_000)):
        got = asof_join(x, r, ["region"], "day", "date", ["v"], prefix="h_", max_age=age, block_days=block)
        assert sorted((tuple(t) for t in got.select("id", "region", "day", "as_of", "h_v").collect()), key=repr) == sorted((want(*t, age) for t in left), key=repr)
    assert asof_join(x, r.limit(0), ["region"], "day", "date", ["v"]).filter("v is not null").count() == 0


def test_stratified_split(spark):
    rng = random.Random(6)
    rows = [(f"R{i % 13:02d}", D0 + dt.timedelta(days=i), rng.choices([0, 1, 2, None], [70, 25, 4, 1])[0]) for i in range(4000)] + [("R00", D0, 3), ("Z", D0, 5), ("Z", D0 + dt.timedelta(days=1), 5)]
    df = spark.createDataFrame(rows, "region string, date date, c int")
    a = M.stratified_split(df.repartition(3), "c")
    got = {r["c"]: (r["n"], r["t"]) for r in a.groupBy("c").agg(F.count("*").alias("n"), F.count(F.when(F.col("is_test"), 1)).alias("t")).collect()}
    assert all(t == int(0.2 * n + 0.5) for n, t in got.values()) and len(got) == 6 and a.count() == len(rows)
    b = M.stratified_split(df.repartition(7, "date"), "c")
    key = ["region", "date", "c", "is_test"]
    assert sorted(map(tuple, a.select(*key).collect()), key=repr) == sorted(map(tuple, b.select(*key).collect()), key=repr)
    # rows of one hash: the tie columns decide
    t = M.stratified_split(df, "c", key=F.lit(1).cast("long"))
    assert t.filter("is_test and c = 0").count() == got[0][1]
    assert M.stratified_split(df.limit(0), "c").count() == 0
