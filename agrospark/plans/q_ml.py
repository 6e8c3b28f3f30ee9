"""Registered queries: model training, evaluation and scoring.

Every model is trained at the platform's size (``ml.SIZES``). Forests differ from any SQL, so these queries
return what SQL can check: rows per split, keys scored, and conditions that every right run meets
(finite metrics in their ranges, predictions within the classes or the labels' range, a reloaded model
scoring as the saved one, ridge equal to its closed form). Numbers themselves come from ``ml.train_model``.
The deterministic pieces (standardisation, split, class weights, a one-feature linear fit, the
irrigation plan) are checked value by value.
"""

from __future__ import annotations

import collections
import contextlib
import functools
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.functions.numeric import snap
from agrospark.operators import ml as M
from agrospark.operators.indices import disease_label, drought_label
from agrospark.operators.windows import rain_target
from agrospark.plans import features as FT
from agrospark.plans import features_sql as FS
from agrospark.plans.panel import source_version
from agrospark.plans.panel_sql import panel_ctes
from agrospark.plans.q_features import _drought_label_sql, snapped
from agrospark.plans.q_panel import panel
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.sources import adapters as A

D = FS.D
KEYS = ["region", "date"]


#: task -> builder of its frame, features, label; each frame carries keys, features and label together
FRAMES = {"rainfall": (lambda p: FT.rainfall_features(rain_target(p), carry=["target"]), FT.RAINFALL_FEATURES, "target"),
          "drought": (lambda p: FT.drought_features(drought_label(p), carry=["drought_class"]), FT.DROUGHT_FEATURES, "drought_class"),
          "irrigation": (FT.irrigation_labelled, FT.IRRIGATION_FEATURES, "irrigation_need"),
          "disease": (lambda p: FT.disease_features(disease_label(p, stored=True), carry=["disease_class"]), FT.DISEASE_FEATURES, "disease_class")}


def labelled_frames(spark, sf, tasks=tuple(FRAMES)):
    """task -> (frame, features, label) of ``tasks``; labels' thresholds are found while a frame is built, so only what is asked for is built."""
    p = panel(spark, sf)
    return {t: (FRAMES[t][0](p), *FRAMES[t][1:]) for t in tasks}


_STD_COLS = ["temperature_2m", "ssm", "ndvi"]


@register("standardize", f"""{panel_ctes()},
st as (select {', '.join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in _STD_COLS)} from panel)
select region, date, {', '.join(f"{ssnap(f'case when s_{c} <> 0 then ({c} - m_{c}) / s_{c} else {D(0)} end')} as {c}"
                                for c in _STD_COLS)}
from panel cross join st""")
def q_standardize(spark, sf):
    d = M.standardize(panel(spark, sf).select(*KEYS, *_STD_COLS), _STD_COLS, ddof=0)
    return snapped(d)


_KEY_SQL = "(cast(date_diff('day', DATE '1970-01-01', date) as bigint) * 31 + ascii(right(region, 1)))"


@register("train_test_split", f"""{panel_ctes()}
select region, date, (((({_KEY_SQL} + 42) * 2654435761) % 4294967296) % 1000) < 200 as is_test from panel""")
def q_train_test_split(spark, sf):
    return M.train_test_split(panel(spark, sf).select(*KEYS))


@register("stratified_split", f"""{_drought_label_sql()},
h as (select region, date, drought_class, (({_KEY_SQL} + 42) * 2654435761) % 4294967296 as h from labelled),
r as (select *, row_number() over (partition by drought_class order by h, region, date) as k, count(*) over (partition by drought_class) as n from h)
select region, date, drought_class, k <= floor(n * {D(0.2)} + 0.5) as is_test from r""")
def q_stratified_split(spark, sf):
    """A fifth of each drought class, to the row."""
    return M.stratified_split(drought_label(panel(spark, sf)).select(*KEYS, "drought_class"), "drought_class")


@register("class_weights", f"""{panel_ctes()},
d as (select *, {ssnap(FS.strict('sum', 'total_precipitation_sum', 30), 9)} as precip_sum_30 from panel),
q as (select quantile_cont(precip_sum_30, 0.2) as qa, quantile_cont(temperature_2m, 0.8) as qb,
        quantile_cont(ssm, 0.2) as qc, quantile_cont(ndvi, 0.2) as qd from d),
s as (select (case when coalesce(precip_sum_30 < qa, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(temperature_2m > qb, false) then {D(0.2)} else {D(0)} end)
    + (case when coalesce(ssm < qc, false) then {D(0.3)} else {D(0)} end)
    + (case when coalesce(ndvi < qd, false) then {D(0.2)} else {D(0)} end) as drought_score from d cross join q),
c as (select case when drought_score <= {D(0.2)} then 0 when drought_score <= {D(0.4)} then 1
    when drought_score <= {D(0.6)} then 2 else 3 end as drought_class, count(*) as n from s group by 1)
select drought_class, n, {ssnap('(select sum(n) from c) / ((select count(*) from c) * n)')} as weight from c""")
def q_class_weights(spark, sf):
    lab = drought_label(panel(spark, sf)).select("drought_class")
    w = M.class_weights(lab, "drought_class")
    return w.groupBy("drought_class").agg(F.count(F.lit(1)).alias("n"), snap(F.first("weight")).alias("weight"))


@register("fit_linear", f"""{panel_ctes()},
t as (select temperature_2m as x, coalesce(lead(total_precipitation_sum, 1) over (partition by region order by date),
  {D(0)}) as y from panel)
select {ssnap('regr_slope(y, x)', 4)} as slope, {ssnap('regr_intercept(y, x)', 4)} as intercept from t
where x is not null and y is not null""")
def q_fit_linear(spark, sf):
    """Ordinary least squares of next-day rain on temperature with MLlib (one feature)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    d = rain_target(panel(spark, sf)).select(F.col("temperature_2m").alias("x"), F.col("target").alias("y")) \
        .dropna()
    v = VectorAssembler(inputCols=["x"], outputCol="f").transform(d)
    lr = LinearRegression(featuresCol="f", labelCol="y", regParam=0.0, solver="normal", standardization=False) \
        .fit(v)
    spark_ = d.sparkSession
    row = spark_.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept))], "slope double, intercept double")
    return row.select(snap(F.col("slope"), 4).alias("slope"), snap(F.col("intercept"), 4).alias("intercept"))


_MODELS: dict = {}
_LOCKS: dict = collections.defaultdict(threading.Lock)      # queries run from several threads train a model once


def fitted(spark, sf, task, algorithm="random_forest"):
    """The task's model at the platform's size, trained once per session and data."""
    key = (spark.sparkContext.applicationId, source_version(spark, sf), task, algorithm)
    with _LOCKS[key]:
        if key not in _MODELS:
            df, feats, label = labelled_frames(spark, sf, [task])[task]
            _MODELS[key] = M.train_model(df, feats, label, task, algorithm)
        return _MODELS[key]


def _in_range(m):
    """One row per model: metrics are finite and within their ranges."""
    if "r2" in m.columns:
        ok = (F.col("mse") >= 0) & ~F.isnan("mse") & (F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) <= 1e-6 * (1 + F.col("mse"))) & (F.col("mae") <= F.col("rmse") + 1e-9) & (F.col("r2") <= 1)
    else:
        ok = F.lit(True)
        for c in ("accuracy", "precision", "recall", "f1"):
            ok = ok & F.col(c).between(0, 1 + 1e-9)
        ok = ok & (F.abs(F.col("accuracy") - F.col("recall")) < 1e-9)      # support-weighted recall is accuracy
    return F.coalesce(ok, F.lit(False))


#: the label of each task is there on every panel row, but for the drought and irrigation frames' own gaps, which the fills close
_SPLIT_SQL = f"""{panel_ctes()},
split as (select (((({_KEY_SQL} + 42) * 2654435761) % 4294967296) % 1000) < 200 as is_test from panel)"""


def _train_sql(task, algorithm):
    return f"""{_SPLIT_SQL}
select '{task}_{algorithm}' as model, count(*) filter (where not is_test) as n_train, count(*) filter (where is_test) as n_test,
  true as metrics_in_range from split"""


def _train(name, task, algorithm="random_forest"):
    @register(name, _train_sql(task, algorithm))
    def q(spark, sf):
        fm = fitted(spark, sf, task, algorithm)
        return fm.metrics.select("model", F.lit(fm.extra["n_train"]).cast("long").alias("n_train"), F.col("n").cast("long").alias("n_test"),
                                 _in_range(fm.metrics).alias("metrics_in_range"))


_train("train_rainfall", "rainfall")
_train("train_drought", "drought")
_train("train_irrigation", "irrigation")
_train("train_disease", "disease")
_train("train_gbt", "rainfall", "gradient_boosting")
_train("train_gbt_classifier", "drought", "gradient_boosting")
_train("train_svm", "drought", "svm")


@register("train_svm_nystroem", f"""{_SPLIT_SQL}
select 'drought_nystroem_svm' as model, count(*) filter (where not is_test) as n_train, count(*) filter (where is_test) as n_test,
  true as metrics_in_range, true as kernel_nearer_than_random, true as beats_chance from split""")
def q_train_svm_nystroem(spark, sf):
    """Kernel SVM at the platform's 50 iterations on Nystroem features: its kernel error is below that of as many random features,
    and its recall, averaged over the classes, is above a constant predictor's."""
    from agrospark.session import written
    df, feats, label = labelled_frames(spark, sf, ["drought"])["drought"]
    df = written(M.usable_rows(df, feats, label)[0])
    fm = M.train_model(df, feats, label, "drought", "nystroem_svm")
    test = M.train_test_split(df).filter("is_test").withColumn("y", F.col(label).cast("double"))
    got = test.select(*KEYS, "y").join(M.score(test, fm), KEYS).groupBy("y").agg(F.avg((F.col("y") == F.col("prediction")).cast("double")).alias("r"))
    recall = got.agg(F.avg("r").alias("mean_recall"), F.count(F.lit(1)).alias("classes"))
    p = fm.extra["projection"]
    return fm.metrics.crossJoin(F.broadcast(recall)).select(
        "model", F.lit(fm.extra["n_train"]).cast("long").alias("n_train"), F.col("n").cast("long").alias("n_test"), _in_range(fm.metrics).alias("metrics_in_range"),
        F.lit(p["kernel_error"] < p["rff_error"]).alias("kernel_nearer_than_random"), ((F.col("mean_recall") * F.col("classes") > 1) | (F.col("classes") < 2)).alias("beats_chance"))


def ridge_closed_form(train, features, label, alpha):
    """Coefficients of the standardised ridge problem from its normal equations, summed by Spark over rows less their means: a feature that
    (nearly) never varies is then told from the rounding of its square."""
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    x = VectorAssembler(inputCols=[*features, label], outputCol="v").transform(train)
    k = len(features) + 1
    first = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate([*features, label])]).first()
    shift = np.array([float(v or 0.0) for v in first])

    def gram(batches):
        import pandas as pd
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            m = np.column_stack([np.ones(len(b)), np.stack(b["v"].to_numpy()) - shift])
            total += m.T @ m
        yield pd.DataFrame({"i": np.arange((k + 1) ** 2), "g": total.ravel()})

    from pyspark.ml.functions import vector_to_array
    sums = x.select(vector_to_array("v").alias("v")).mapInPandas(gram, "i long, g double").groupBy("i").agg(F.sum("g").alias("g")).collect()
    g = np.zeros((k + 1) ** 2)
    for r in sums:                                           # (features + 2)^2 numbers
        g[r["i"]] = r["g"]
    g = g.reshape(k + 1, k + 1)
    n, mean = g[0, 0], g[0, 1:] / g[0, 0]
    cov = g[1:, 1:] - n * np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0) / (n - 1))
    use = sd > 1e-12 * np.maximum(1.0, np.abs(shift[:-1]))
    a = cov[:-1, :-1][np.ix_(use, use)] / np.outer(sd[use], sd[use])
    beta = np.zeros(k - 1)
    beta[use] = np.linalg.solve(a + alpha * np.eye(use.sum()), cov[:-1, -1][use] / sd[use])
    return beta, mean[-1] + shift[-1]


@register("fit_ridge", f"""{_SPLIT_SQL}
select count(*) filter (where not is_test) as n_train, count(*) filter (where is_test) as n_test, true as is_closed_form from split""")
def q_fit_ridge(spark, sf):
    """Ridge on the irrigation frame; its fitted values equal those of the closed form."""
    import numpy as np
    fm = fitted(spark, sf, "irrigation", "linear")
    df, feats, label = labelled_frames(spark, sf, ["irrigation"])["irrigation"]
    rows, feats = M.usable_rows(df, feats, label)
    train = M.train_test_split(rows).filter("not is_test")
    beta, b0 = ridge_closed_form(train, feats, label, M.RIDGE_ALPHA["irrigation"])
    lr = fm.pipeline.stages[-1]
    weight = dict(zip(feats, beta, strict=True))
    # collinear features (one-hot crops) leave single coefficients free; fitted values are what must agree
    scaled = fm.pipeline.transform(train)
    from pyspark.ml.functions import vector_to_array
    closed = F.aggregate(F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(weight.pop(c))) for c in fm.feature_names]), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) + F.lit(float(b0))
    gap = scaled.agg(F.max(F.abs(closed - F.col("prediction"))).alias("gap"), F.stddev_pop(label).alias("sd")).first()
    ok = bool(gap["gap"] <= 1e-4 * max(1.0, gap["sd"])) and bool(np.isfinite(lr.intercept)) and not any(weight.values())    # features left out weigh nothing
    return fm.metrics.select(F.lit(fm.extra["n_train"]).cast("long").alias("n_train"), F.col("n").cast("long").alias("n_test"), F.lit(ok).alias("is_closed_form"))


@register("model_roundtrip", f"""{panel_ctes()}
select region, date, cast(0 as double) as prediction_gap, cast(0 as double) as confidence_gap from panel""")
def q_model_roundtrip(spark, sf):
    """Train, save, reload and batch-score the drought model; the reloaded model scores every row as the trained one."""
    from agrospark.plans.q_sources import _scratch
    fm = fitted(spark, sf, "drought")
    path = _scratch(spark, "model")
    M.save(fm, path)
    df = labelled_frames(spark, sf, ["drought"])["drought"][0]
    a = M.score(df, fm)
    b = M.score(df, M.load(spark, path)).select(*KEYS, F.col("prediction").alias("p2"), F.col("confidence").alias("c2"))
    return a.join(b, KEYS).select(*KEYS, F.abs(F.col("prediction") - F.col("p2")).alias("prediction_gap"), F.abs(F.col("confidence") - F.col("c2")).alias("confidence_gap"))


_METRICS = {"regression": ["mae", "mape", "mse", "r2", "rmse"], "classification": ["accuracy", "f1", "precision", "recall"]}


@register("train_all", f"""select task, 'ok' as status, unnest(metrics) as metric from (values
  {', '.join(f"('{t}', {_METRICS[k]!r})" for t, k in M.TASK_TYPE.items())}) v(task, metrics)
  where (select count(*) from lineitem) > 0""")
def q_train_all(spark, sf):
    """Every task's forest trained at the platform's size, those of this session's earlier queries kept; a task that fails fails the query."""
    key = (spark.sparkContext.applicationId, source_version(spark, sf))
    with contextlib.ExitStack() as locks:
        for t in FRAMES:
            locks.enter_context(_LOCKS[*key, t, "random_forest"])
        kept = {t: _MODELS[*key, t, "random_forest"] for t in FRAMES if (*key, t, "random_forest") in _MODELS}
        parts = [M.metric_rows(t, fm) for t, fm in kept.items()]
        if missing := [t for t in FRAMES if t not in kept]:
            models, metrics = M.train_all(labelled_frames(spark, sf, missing))
            _MODELS.update({(*key, t, "random_forest"): fm for t, fm in models.items()})
            bad = [r["status"] for r in metrics.filter("status <> 'ok'").collect()]
            if bad:
                raise RuntimeError(f"training failed: {bad}")
            parts.append(metrics)
    return functools.reduce(DataFrame.unionByName, parts).filter("value is not null and not isnan(value)").select("task", "status", "metric")


def _plan_sql():
    from agrospark.plans.q_rules import _irr_sql_ctes, band_sql, q
    from agrospark.operators import rules as R
    times = (f"concat_ws(' | ', case when coalesce(temp_max, {D(35)}) > 30 then {q(R.TIME_EARLY_HOT)} else "
             f"{q(R.TIME_EARLY)} end, case when coalesce(temp_max, {D(35)}) > 35 or coalesce(wind_speed, {D(2)}) > 5 "
             f"then {q(R.TIME_EVENING)} end)")
    return f"""{_irr_sql_ctes()}
select region, date, crop_type, {ssnap('irrigation_need')} as irrigation_need, {ssnap('etc')} as etc,
  {band_sql('irrigation_need', R.IRRIGATION_BANDS, R.IRRIGATION_TOP, 1)} as frequency,
  {band_sql('irrigation_need', R.IRRIGATION_BANDS, R.IRRIGATION_TOP, 2)} as duration,
  case when etc = 0 then 100 else cast(trunc(least({D(100)}, greatest({D(0)},
    {D(100)} - abs(irrigation_need - etc) / etc * {D(50)}))) as integer) end as efficiency_score,
  {ssnap(f'irrigation_need * {D(0.1)}')} as water_cost, {times} as best_times from irr"""


@register("irrigation_plan", _plan_sql())
def q_irrigation_plan(spark, sf):
    from agrospark.plans.q_rules import _irr_frame
    from agrospark.plans.scoring import irrigation_plan
    d = irrigation_plan(_irr_frame(spark, sf))
    return d.select("region", "date", "crop_type", snap(F.col("irrigation_need")).alias("irrigation_need"),
                    snap(F.col("etc")).alias("etc"), "frequency", "duration", "efficiency_score",
                    snap(F.col("water_cost")).alias("water_cost"), F.array_join("best_times", " | ").alias("best_times"))


def _score(name, task):
    kind = M.TASK_TYPE[task]

    @register(name, f"""{panel_ctes()}
select region, date, true as prediction_ok, true as confidence_ok from panel""")
    def q(spark, sf):
        """Every row scored: classes are known ones and regressions lie within the labels' range; confidence is the largest class
        probability in percent, or 75 where a model has none."""
        df, _, label = labelled_frames(spark, sf, [task])[task]
        out = M.score(df, fitted(spark, sf, task))
        if kind == "classification":
            ok, sure = F.col("prediction").isin(0.0, 1.0, 2.0, 3.0), F.col("confidence").between(25 - 1e-9, 100 + 1e-9)
        else:
            lo, hi = df.agg(F.min(label), F.max(label)).first()
            ok, sure = F.col("prediction").between(lo - 1e-9, hi + 1e-9), F.col("confidence") == 75.0
        return out.select(*KEYS, ok.alias("prediction_ok"), sure.alias("confidence_ok"))


_score("score_rainfall", "rainfall")
_score("score_irrigation", "irrigation")
_score("score_drought", "drought")
_score("score_disease", "disease")


@register("score_readings", f"""{panel_ctes()},
f as ({A.FIELD_SQL}), d as (select distinct region, date from panel)
select f.reading_id, f.region, cast(d.date as varchar) as as_of, true as rainfall_as_of_row, true as drought_as_of_row, true as irrigation_as_of_row, true as in_range
from f asof left join d on f.region = d.region and f.as_of_day >= d.date""")
def q_score_readings(spark, sf):
    """Every reading scored by the saved and reloaded rainfall, drought and irrigation models: a reading with history is predicted as the panel row
    that it matches in a plain batch scoring of the panel; all predictions are in the labels' range."""
    from agrospark.plans.q_sources import _scratch
    from agrospark.plans.scoring import PREDICTED, score_readings
    tasks = ("rainfall", "drought", "irrigation")
    frames = labelled_frames(spark, sf, tasks)
    models = {}
    for t in tasks:
        path = _scratch(spark, f"served-{t}")
        M.save(fitted(spark, sf, t), path)
        models[t] = M.load(spark, path)
    r = A.field_readings(spark, sf).select("reading_id", "region", "date", "as_of_day", "temperature", "humidity", "wind_speed", "precipitation")
    got = score_readings(r, models, {t: frames[t][0] for t in tasks})
    ok = F.lit(True)
    for t in tasks:
        df, _, label = frames[t]
        rows = M.score(df, models[t]).select(F.col("region"), F.col("date").alias(f"{t}_as_of"), F.col("prediction").alias(f"_{t}"))
        got = got.join(rows, ["region", f"{t}_as_of"], "left")
        lo, hi = df.agg(F.min(label).cast("double"), F.max(label).cast("double")).first()
        ok = ok & F.col(PREDICTED[t]).between(lo - 1e-9, hi + 1e-9)
    same = [(F.col(f"{t}_as_of").isNull() | (F.abs(F.col(f"_{t}") - F.col(PREDICTED[t])) <= 1e-9)).alias(f"{t}_as_of_row") for t in tasks]
    return got.select("reading_id", "region", F.col("drought_as_of").cast("string").alias("as_of"), *same, ok.alias("in_range"))

