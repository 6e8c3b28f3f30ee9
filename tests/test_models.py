"""Scoring a part of the rows gives the part of scoring all rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.operators import ml as M


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(240):
        a, b = rnd.gauss(0, 1), rnd.gauss(5, 3)
        rows.append((f"R{i % 4:02d}", dt.date(2024, 1, 1) + dt.timedelta(i // 4), a, b, 7.0, float(a * (b - 5) > 0)))
    return spark.createDataFrame(rows, "region string, date date, a double, b double, fixed double, y double").cache()


@pytest.mark.parametrize("algorithm", ["svm", "nystroem_svm", "random_forest"])
def test_scores_of_a_subset(spark, frame, tmp_path, algorithm):
    size = dict(maxIter=5) if "svm" in algorithm else dict(numTrees=5, maxDepth=3)
    m = M.train_model(frame, ["a", "b", "fixed"], "y", "drought", algorithm, seed=7, **size)
    everything = {(r["region"], r["date"]): r["prediction"] for r in M.score(frame, m).collect()}
    M.save(m, str(tmp_path / "m"))
    back = M.load(spark, str(tmp_path / "m"))
    part = M.score(frame.filter("region = 'R01' and a > 0"), back).collect()
    assert part and all(everything[r["region"], r["date"]] == r["prediction"] for r in part)


def test_class_weights_come_from_the_fitted_rows(frame):
    part = frame.filter("region = 'R00'")
    n = {r["y"]: r["count"] for r in part.groupBy("y").count().collect()}
    got = {r["y"]: r["weight"] for r in M.class_weights(frame, "y", fit=part).select("y", "weight").distinct().collect()}
    assert got == {k: pytest.approx(sum(n.values()) / (len(n) * v)) for k, v in n.items()}
    assert M.class_weights(frame, "y", fit=part.filter("y = 1")).filter(F.col("y") == 0).first()["weight"] == 0.0


def test_nystroem_features_are_exact_on_their_landmarks(spark, frame):
    rows = frame.limit(60).select("a", "b", "fixed")
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([(None, 4.0, 7.0)], "a double, b double, fixed double"))
    fit = M.fit_nystroem(rows, ["a", "b", "fixed"], n_landmarks=80)                  # every distinct row is a landmark
    pdf = rows.toPandas()
    phi = M.nystroem_transform(rows, fit).toPandas().to_numpy()
    z = M._scaled(pdf, fit)
    gap = np.sort((phi @ phi.T).ravel()) - np.sort(M.rbf(z, z, fit["gamma"]).ravel())
    assert abs(gap).max() < 1e-6 and fit["kernel_error"] < 1e-6 < fit["rff_error"]
    assert M.nystroem_transform(rows.limit(0), fit).count() == 0
    none = M.fit_nystroem(rows.limit(0), ["a", "b", "fixed"], n_landmarks=4)
    assert M.nystroem_transform(rows.limit(3), none).collect()[0]["nys_0"] == 0.0


def test_nystroem_error_falls_with_landmarks_and_does_not_depend_on_partitions(frame):
    errors = [M.fit_nystroem(frame, ["a", "b"], n_landmarks=n)["kernel_error"] for n in (4, 16, 64)]
    assert errors[0] > errors[1] > errors[2]
    a, b = (M.fit_nystroem(frame.repartition(n), ["a", "b"], n_landmarks=16) for n in (1, 7))
    assert np.allclose(a["landmarks"], b["landmarks"])


def test_nystroem_svm_against_an_exact_kernel_machine(frame):
    """Classes that no line separates: held-out accuracy within 0.05 of an exact kernel ridge classifier on the same rows."""
    m = M.train_model(frame, ["a", "b"], "y", "drought", "nystroem_svm", seed=7, n_landmarks=48)
    rows = M.train_test_split(frame, seed=7).toPandas()
    p = m.extra["projection"]
    z, y, test = M._scaled(rows, p), rows["y"].to_numpy() * 2 - 1, rows["is_test"].to_numpy()
    k = M.rbf(z, z[~test], p["gamma"])
    exact = np.sign(k @ np.linalg.solve(k[~test] + 0.1 * np.eye((~test).sum()), y[~test]))
    got = {(r["region"], r["date"]): r["prediction"] for r in M.score(frame, m).collect()}
    ours = np.array([got[r, d] for r, d in zip(rows["region"], rows["date"])]) * 2 - 1
    right = [(x[test] == y[test]).mean() for x in (exact, ours)]
    assert right[1] >= right[0] - 0.05 and right[1] > 0.8


def test_a_feature_without_values_takes_no_rows(spark, frame, tmp_path):
    """A strict mean that no row has: the model is the one without it, on all rows; a reloaded one scores the same."""
    blind = frame.withColumn("never", F.lit(None).cast("double")).withColumn("y", F.col("y").cast("int"))
    size = {"random_forest": dict(numTrees=3, maxDepth=3), "svm": dict(maxIter=3), "nystroem_svm": dict(maxIter=3, n_landmarks=8), "gradient_boosting": dict(maxIter=2)}
    for algorithm, few in size.items():
        with_it, without = (M.train_model(blind, feats, "y", "drought", algorithm, **few) for feats in (["a", "never", "b"], ["a", "b"]))
        n = with_it.extra["n_train"] + with_it.metrics.first()["n"]
        assert n == frame.count() and with_it.extra["input_features"] == ["a", "b"]
        M.save(with_it, str(tmp_path / algorithm))
        a, b = (M.score(blind, m).orderBy("region", "date").collect() for m in (M.load(spark, str(tmp_path / algorithm)), without))
        assert a == b
    ridge = M.train_model(blind, ["never", "a", "b"], "y", "irrigation", "linear")
    assert ridge.extra["n_train"] + ridge.metrics.first()["n"] == frame.count()
    some = blind.withColumn("a", F.when(F.col("b") > 5, F.col("a")))                 # known in some rows: the others go, as before
    rows, feats = M.usable_rows(some, ["a", "never", "b"], "y")
    assert feats == ["a", "b"] and rows.count() == frame.filter("b > 5").count()


@pytest.mark.parametrize("algorithm", ["random_forest", "gradient_boosting", "svm", "nystroem_svm"])
def test_one_class_only(frame, algorithm):
    size = {"random_forest": dict(numTrees=3, maxDepth=3), "gradient_boosting": dict(maxIter=2)}.get(algorithm, dict(maxIter=3))
    m = M.train_model(frame.withColumn("y", F.lit(0)), ["a", "b"], "y", "drought", algorithm, **size)
    assert m.metrics.first()["accuracy"] == 1.0
    assert {r["prediction"] for r in M.score(frame, m).collect()} == {0.0}


@pytest.mark.parametrize("algorithm", ["random_forest", "gradient_boosting"])
def test_constant_target(frame, algorithm):
    m = M.train_model(frame.withColumn("y", F.lit(0.0)), ["a", "b"], "y", "rainfall", algorithm, **{"numTrees" if algorithm == "random_forest" else "maxIter": 2})
    got = m.metrics.first()
    assert (got["mse"], got["r2"]) == (0.0, 1.0)


def test_node_memory_follows_the_session(spark):
    heap, cores = spark.sparkContext.getConf().get("spark.driver.memory"), spark.sparkContext.defaultParallelism
    assert heap.endswith("g") and M.node_memory(spark) == max(64, min(1024, int(heap[:-1]) * 1024 // (4 * cores)))


@pytest.mark.parametrize("algorithm", ["random_forest", "gradient_boosting"])
def test_training_in_a_thread_of_its_own(spark, frame, tmp_path, algorithm):
    """Threads of the caller have no active session."""
    from concurrent.futures import ThreadPoolExecutor

    def run():
        m = M.train_model(frame.withColumn("y", (F.col("b") > 5).cast("int")), ["a", "b"], "y", "drought", algorithm, maxDepth=2, **{"numTrees" if algorithm == "random_forest" else "maxIter": 2})
        M.save(m, str(tmp_path / "model"))
        return M.score(frame, M.load(spark, str(tmp_path / "model"))).count()

    with ThreadPoolExecutor(1) as pool:
        assert pool.submit(run).result() == frame.count()
