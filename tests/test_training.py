"""How training is laid out: partitions by rows, tasks side by side, every model at the platform's size."""

import datetime as dt
import random
import threading
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from agrospark.operators import ml as M
from agrospark.plans import q_ml


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(240):
        a, b = rnd.gauss(0, 1), rnd.gauss(5, 3)
        rows.append((f"R{i % 4:02d}", dt.date(2024, 1, 1) + dt.timedelta(i // 4), a, b, 7.0, float(a * (b - 5) > 0)))
    return spark.createDataFrame(rows, "region string, date date, a double, b double, fixed double, y double").cache()


def test_partitions_follow_the_rows(frame):
    """A plan of many partitions, most of them empty, does not make each of them send statistics of every tree node."""
    wide = frame.repartition(40)
    assert M.training_layout(wide, 240).rdd.getNumPartitions() == 1
    dealt = M.training_layout(wide, 1_000_000)
    assert dealt.rdd.getNumPartitions() == 2 * frame.sparkSession.sparkContext.defaultParallelism
    assert sorted(dealt.collect()) == sorted(frame.collect())


def test_a_model_does_not_depend_on_how_its_rows_came(frame):
    one, many = (M.score(frame, M.train_model(frame.repartition(n), ["a", "b"], "y", "drought", numTrees=5, maxDepth=3)).orderBy("region", "date").collect() for n in (1, 7))
    assert one == many


SIZES = {("disease", "random_forest"): dict(numTrees=200, maxDepth=15, minInstancesPerNode=2), ("rainfall", "gradient_boosting"): dict(maxIter=100, maxDepth=6, stepSize=0.1),
         ("drought", "gradient_boosting"): dict(maxIter=100, maxDepth=6, stepSize=0.1), ("drought", "svm"): dict(maxIter=50)}


@pytest.mark.parametrize("task, algorithm", [*SIZES, ("drought", "random_forest"), ("irrigation", "random_forest")])
def test_a_query_trains_its_own_model_at_the_platforms_size(spark, monkeypatch, task, algorithm):
    calls = []
    monkeypatch.setattr(q_ml, "_MODELS", {})
    monkeypatch.setattr("agrospark.plans.panel.source_version", lambda *a: ("x",))
    monkeypatch.setattr(q_ml, "source_version", lambda *a: ("x",), raising=False)
    monkeypatch.setattr(q_ml, "panel", lambda *a: None)
    monkeypatch.setattr(q_ml, "labelled_frames", lambda spark, sf, tasks=("rainfall", "drought", "irrigation", "disease"): {t: (spark.range(0), ["id"], t) for t in tasks})

    def train(df, features, label, task, algorithm="random_forest", **overrides):
        calls.append((task, algorithm, overrides))
        return SimpleNamespace(metrics=spark.createDataFrame([(1.0,)], "mse double"))

    monkeypatch.setattr(M, "train_model", train)
    a, b = (q_ml.fitted(spark, "nowhere", task, algorithm) for _ in range(2))
    assert a is b and calls == [(task, algorithm, {})]
    est = M.make_estimator(task, algorithm)
    est = est.getClassifier() if hasattr(est, "getClassifier") else est
    for name, value in SIZES.get((task, algorithm), M.SIZES.get((task, algorithm))).items():
        assert est.getOrDefault(name) == value


def test_tasks_train_side_by_side_and_a_failing_one_is_reported(frame, monkeypatch):
    both = threading.Barrier(3, timeout=60)

    def train(df, features, label, task, algorithm="random_forest", **overrides):
        both.wait()
        if task == "irrigation":
            raise ValueError("no rows")
        return SimpleNamespace(metrics=df.sparkSession.createDataFrame([(task, 1.0, 9)], "model string, mse double, n long"))

    monkeypatch.setattr(M, "train_model", train)
    models, metrics = M.train_all({t: (frame, ["a"], "y") for t in ("rainfall", "irrigation", "drought")})
    assert list(models) == ["rainfall", "drought"]
    assert sorted(map(tuple, metrics.collect()), key=str) == [("drought", "ok", "mse", 1.0), ("irrigation", "error: no rows", None, None), ("rainfall", "ok", "mse", 1.0)]


def test_ridge_with_constant_and_collinear_features_is_its_closed_form(frame):
    """A feature that never varies made the normal equations singular, and the solver only came near their solution."""
    d = frame.withColumns({"a2": F.col("a") * 2, "noise": (F.lit(0.1) + F.col("b") * 1e-17), "y": F.col("a") * 3 + F.col("b")})
    feats = ["a", "a2", "b", "fixed", "noise"]
    fm = M.train_model(d, feats, "y", "irrigation", "linear")
    assert fm.feature_names == fm.extra["input_features"] == ["a", "a2", "b"]
    train = M.train_test_split(d).filter("not is_test")
    beta, b0 = q_ml.ridge_closed_form(train, feats, "y", M.RIDGE_ALPHA["irrigation"])
    assert beta[3] == beta[4] == 0
    got = fm.pipeline.transform(train).select(vector_to_array("features").alias("x"), "prediction").collect()
    assert max(abs(np.dot(r["x"], beta[:3]) + b0 - r["prediction"]) for r in got) < 1e-9
    nothing = M.train_model(frame, ["fixed"], "y", "irrigation", "linear")              # none varies: the mean is predicted
    assert nothing.feature_names == ["fixed"]
