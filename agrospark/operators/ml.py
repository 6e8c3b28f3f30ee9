"""Model training, evaluation and batch scoring on Spark MLlib.

Design: features and label live in ONE DataFrame (never two frames aligned by position). A
fitted model is a ``PipelineModel`` (mean imputer -> assembler -> scaler -> estimator) plus the
feature list; training, scoring and metrics are distributed (trees are built level by level on
the executors; metrics come from aggregations, not from collected predictions).

Parity notes: the platform standardised with the population std and fitted imputer/scaler on
all rows before the split; here both are fitted on the training rows only (``leak=True``
restores the platform's behaviour for comparison). The kernel SVM has no MLlib twin and is
approximated by a feature map and a one-vs-rest linear SVM: random Fourier features (``svm``), or Nystroem features
of landmarks chosen in the data (``nystroem_svm``), whose kernel error is measured. The projection's scaler, gamma,
seed and landmarks are fitted on the training rows and kept in the model.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from agrospark.operators.reports import classification_metrics, regression_metrics
from agrospark.session import written

# model sizes of the platform (task, algorithm) -> parameters
SIZES = {
    ("rainfall", "random_forest"): dict(numTrees=100, maxDepth=10),
    ("rainfall", "gradient_boosting"): dict(maxIter=100, maxDepth=6, stepSize=0.1),
    ("drought", "random_forest"): dict(numTrees=100, maxDepth=10),
    ("drought", "gradient_boosting"): dict(maxIter=100, maxDepth=6, stepSize=0.1),
    ("irrigation", "random_forest"): dict(numTrees=150, maxDepth=12, minInstancesPerNode=2),
    ("irrigation", "gradient_boosting"): dict(maxIter=150, maxDepth=8, stepSize=0.1),
    ("disease", "random_forest"): dict(numTrees=200, maxDepth=15, minInstancesPerNode=2),
    ("disease", "gradient_boosting"): dict(maxIter=150, maxDepth=10, stepSize=0.1),
}
TASK_TYPE = {"rainfall": "regression", "irrigation": "regression", "drought": "classification",
             "disease": "classification"}
BALANCED = {"drought", "disease"}      # class_weight='balanced' there
RIDGE_ALPHA = {"irrigation": 1.0}      # the linear fallback is ridge for irrigation, OLS for rainfall
CLASSES_AT_ONCE = 4                    # one-vs-rest: rounds and iterations are many small jobs, so the classes' learners run side by side


@dataclass
class FittedModel:
    pipeline: PipelineModel
    feature_names: list[str]
    label: str
    task: str
    metrics: DataFrame | None = None
    extra: dict = field(default_factory=dict)


# ----------------------------------------------------------------------------- J1, J2, J7

def split_key(region: str = "region", date: str = "date") -> Column:
    """Integer key of a (region, date) row, the same one used for crop assignment."""
    return F.unix_date(F.col(date)).cast("long") * F.lit(31) + F.ascii(F.substring(F.col(region), -1, 1))


def train_test_split(df: DataFrame, key: Column | None = None, test: float = 0.2, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Deterministic split from a multiplicative hash of an integer key: stable under
    repartitioning and recomputation (``randomSplit`` is not, after a lost executor)."""
    key = key if key is not None else split_key()
    h = F.pmod((key + F.lit(seed)) * F.lit(2654435761), F.lit(4294967296))
    return df.withColumn(out, (F.pmod(h, F.lit(1000)) < F.lit(int(round(test * 1000)))))


def stratified_split(df: DataFrame, label: str, test: float = 0.2, seed: int = 42, key: Column | None = None, ties: Sequence[str] = ("region", "date"),
                     out: str = "is_test") -> DataFrame:
    """Exact split per class: of a class of n rows, the round(test * n) rows of smallest (hash of the key, ``ties``) are test rows.

    The cut is found by histograms of the hash: counts per class and upper half of its 32 bits name a bucket, counts inside it the hash
    at the cut, and only the rows of that very hash are ordered by ``ties``. No class is sorted, and nothing depends on how rows are dealt out. The classes'
    cuts are one row each. Rows without a label are a class of their own; rows equal in ``ties`` and key stay together.
    """
    from agrospark.operators.blocked import join_null_safe
    key = key if key is not None else split_key()
    h = F.pmod((key + F.lit(seed)) * F.lit(2654435761), F.lit(4294967296))
    tie = F.struct(*ties)
    rows = written(df.select(F.col(label).alias("_label"), h.alias("_h"), *[F.col(c) for c in ties]))
    upper, lower = F.shiftright("_h", 16), F.col("_h").bitwiseAND(65535)

    def cut(counts: DataFrame, quota: DataFrame, bucket: str) -> DataFrame:
        """Per class the bucket that holds the quota's last row, and what is left of the quota there."""
        upto = F.sum("_c").over(Window.partitionBy("_label").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0))
        c = join_null_safe(counts.withColumn("_to", upto), quota, ["_label"], "inner")
        return c.filter((F.col("_to") - F.col("_c") < F.col("_q")) & (F.col("_q") <= F.col("_to"))).select("_label", bucket, (F.col("_q") - F.col("_to") + F.col("_c")).alias("_q"))

    quota = rows.groupBy("_label").agg(F.floor(F.count(F.lit(1)) * F.lit(test) + F.lit(0.5)).alias("_q"))
    first = written(cut(rows.groupBy("_label", upper.alias("_u")).agg(F.count(F.lit(1)).alias("_c")), quota, "_u"))
    near = join_null_safe(rows.withColumn("_u", upper), first, ["_label", "_u"], "inner")
    second = cut(near.groupBy("_label", "_u", lower.alias("_v")).agg(F.count(F.lit(1)).alias("_c")), first.select("_label", "_q"), "_v")
    at = written(join_null_safe(first.drop("_q"), second, ["_label"], "inner").select("_label", (F.col("_u") * 65536 + F.col("_v")).alias("_h"), "_q"))
    same = join_null_safe(rows, at, ["_label", "_h"], "inner")
    last = same.withColumn("_k", F.row_number().over(Window.partitionBy("_label").orderBy(*ties))).filter(F.col("_k") <= F.col("_q"))
    last = written(last.groupBy("_label").agg(F.first("_h").alias("_t"), F.max(tie).alias("_last")))
    got = join_null_safe(df.withColumns({"_label": F.col(label), "_h": h}), last, ["_label"])
    inside = (F.col("_h") < F.col("_t")) | ((F.col("_h") == F.col("_t")) & (tie <= F.col("_last")))
    return got.withColumn(out, F.coalesce(inside, F.lit(False))).drop("_label", "_h", "_t", "_last")


def standardize(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None, ddof: int = 0,
                suffix: str = "") -> DataFrame:
    """(x - mean) / std with statistics from ``fit`` (default: df); ddof 0 = population std.
    The statistics are one row (broadcast)."""
    fit = fit if fit is not None else df
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    st = fit.agg(*[x for c in cols for x in (F.avg(c).alias(f"_m_{c}"), sd(c).alias(f"_s_{c}"))])
    j = df.crossJoin(F.broadcast(st))
    out = {f"{c}{suffix}": F.when(F.col(f"_s_{c}") != 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
           .otherwise(F.lit(0.0)) for c in cols}
    return j.withColumns(out).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def class_weights(df: DataFrame, label: str, out: str = "weight", fit: DataFrame | None = None) -> DataFrame:
    """Balanced weight n / (k * n_c) attached per row (class table: k rows), counted on ``fit`` (default: df).
    A class that ``fit`` lacks gets weight 0: it takes no part in training."""
    if fit is not None:                      # k numbers, kept as literals
        rows = fit.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
        total = sum(r["n"] for r in rows)
        table = F.create_map(*[F.lit(x) for r in rows for x in (r[label], total / (len(rows) * r["n"]))])
        return df.withColumn(out, F.coalesce(F.try_element_at(table, F.col(label)), F.lit(0.0)))
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(w, label, "left")


# ----------------------------------------------------------------------------- J6: random Fourier features

def rff_weights(d: int, n_components: int = 64, gamma: float | None = None, seed: int = 42):
    """W (n x d) ~ N(0, 2*gamma), b ~ U(0, 2pi); gamma defaults to 1/d (sklearn's 'scale' on
    standardised data). Fixed by the seed, so training and scoring project identically."""
    import numpy as np
    gamma = gamma if gamma is not None else 1.0 / d
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d)), rng.uniform(0.0, 2.0 * math.pi,
                                                                                           n_components)


def fit_projection(df: DataFrame, features: Sequence[str], n_components: int = 64, gamma: float | None = None, seed: int = 42) -> dict:
    """Everything a projection needs, fitted on ``df``: means and deviations (one row), gamma, size and seed. Stored with the model."""
    st = df.agg(*[x for i, c in enumerate(features) for x in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
    return {"features": list(features), "mean": [float(st[f"m{i}"] or 0.0) for i in range(len(features))],
            "std": [float(st[f"s{i}"] or 0.0) for i in range(len(features))],
            "n_components": n_components, "gamma": gamma if gamma is not None else 1.0 / len(features), "seed": seed}


def rff_transform(df: DataFrame, fitted: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Random Fourier features sqrt(2/D) cos(W z + b) of z = (x - mean) / std, approximating the RBF kernel. A
    missing value takes the training mean; a constant feature counts as 0. A dense matrix product per Arrow batch
    (mapInPandas): per-row work is a numpy GEMM, not a Python loop, and the projection would be too wide for a
    single generated expression."""
    import numpy as np
    from pyspark.sql import types as T
    feats, n = list(fitted["features"]), int(fitted["n_components"])
    W, b = rff_weights(len(feats), n, fitted["gamma"], int(fitted["seed"]))
    scale = math.sqrt(2.0 / n)
    mean, std = np.array(fitted["mean"]), np.array(fitted["std"])
    width = np.where(std > 0, std, 1.0)
    keep = [c for c in keep if c not in feats]
    out_names = [f"rff_{j}" for j in range(n)]
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(x, T.DoubleType()) for x in out_names])

    def proj(batches):
        import pandas as pd
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype="float64", na_value=np.nan)
            z = np.where(std > 0, (np.where(np.isnan(x), mean, x) - mean) / width, 0.0)
            yield pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(np.cos(z @ W.T + b) * scale, columns=out_names)], axis=1)

    return df.select(*keep, *feats).mapInPandas(proj, schema)


def _scaled(pdf, fitted: dict):
    """z = (x - mean) / std of a batch: a missing value takes the training mean, a constant feature counts as 0."""
    import numpy as np
    x = pdf[fitted["features"]].to_numpy(dtype="float64", na_value=np.nan)
    mean, std = np.array(fitted["mean"]), np.array(fitted["std"])
    return np.where(std > 0, (np.where(np.isnan(x), mean, x) - mean) / np.where(std > 0, std, 1.0), 0.0)


def rbf(a, b, gamma: float):
    """Kernel exp(-gamma |a_i - b_j|^2) of the rows of two matrices."""
    import numpy as np
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(d, 0.0))


def _rows_by_hash(df: DataFrame, features: Sequence[str], n: int, seed: int):
    """The ``n`` distinct feature rows with the smallest hash: a uniform sample that does not depend on how rows are dealt out."""
    h = F.xxhash64(F.lit(seed), *[F.col(c).cast("double") for c in features])
    return df.select(*[F.col(c).cast("double").alias(c) for c in features], h.alias("_h")).distinct().orderBy("_h", *features).limit(n).drop("_h").toPandas()


def fit_nystroem(df: DataFrame, features: Sequence[str], n_landmarks: int = 64, gamma: float | None = None, seed: int = 42, error_rows: int = 512) -> dict:
    """Nystroem map of the RBF kernel, fitted on ``df``: phi(x) = k(x, landmarks) K^(-1/2), K the landmarks' own kernel.

    Landmarks are ``n_landmarks`` distinct rows by hash (a bounded sample; directions in which K vanishes are left out, so
    repeated or collinear landmarks do no harm). ``df`` is read three times: pass a written table. ``kernel_error`` is the relative Frobenius error |phi phi' - k| / |k| over
    other ``error_rows`` rows by hash, ``rff_error`` that of as many random Fourier features there. Empty table: no landmark, features 0.
    """
    import numpy as np
    fitted = {**fit_projection(df, features, n_landmarks, gamma, seed), "kind": "nystroem"}
    land = _scaled(_rows_by_hash(df, features, n_landmarks, seed), fitted)
    value, vector = np.linalg.eigh(rbf(land, land, fitted["gamma"])) if len(land) else (np.zeros(0), np.zeros((0, 0)))
    use = value > 1e-10 * max(1.0, float(value.max(initial=0.0)))
    root = np.zeros((len(land), n_landmarks))
    root[:, :int(use.sum())] = vector[:, use] / np.sqrt(value[use])
    fitted |= {"landmarks": land.tolist(), "root": root.tolist()}
    z = _scaled(_rows_by_hash(df, features, error_rows, seed + 1), fitted)
    exact = rbf(z, z, fitted["gamma"])
    W, b = rff_weights(len(features), n_landmarks, fitted["gamma"], seed)

    def error(phi) -> float:
        return float(np.linalg.norm(phi @ phi.T - exact) / max(float(np.linalg.norm(exact)), 1e-300))
    return fitted | {"kernel_error": error(_nystroem(z, fitted)), "rff_error": error(np.cos(z @ W.T + b) * math.sqrt(2.0 / n_landmarks))}


def _nystroem(z, fitted: dict):
    import numpy as np
    land = np.array(fitted["landmarks"]).reshape(-1, z.shape[1])
    return rbf(z, land, fitted["gamma"]) @ np.array(fitted["root"]).reshape(len(land), fitted["n_components"])


def nystroem_transform(df: DataFrame, fitted: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``nys_0 ..`` of ``fit_nystroem``'s map beside ``keep``: two matrix products per Arrow batch."""
    from pyspark.sql import types as T
    feats = list(fitted["features"])
    keep = [c for c in keep if c not in feats]
    names = [f"nys_{j}" for j in range(fitted["n_components"])]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(x, T.DoubleType()) for x in names])

    def proj(batches):
        import pandas as pd
        for pdf in batches:
            yield pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(_nystroem(_scaled(pdf, fitted), fitted), columns=names)], axis=1)

    return df.select(*keep, *feats).mapInPandas(proj, schema)


def project(df: DataFrame, fitted: dict, keep: Sequence[str] = ()) -> DataFrame:
    """The feature map that a model was trained on."""
    return (nystroem_transform if fitted.get("kind") == "nystroem" else rff_transform)(df, fitted, keep)


# ----------------------------------------------------------------------------- J3-J5 estimators

def _session() -> SparkSession:
    """The running session; a thread that the caller started has no active one of its own."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def make_estimator(task: str, algorithm: str = "random_forest", label: str = "label", features: str = "features",
                   weight: str | None = None, seed: int = 42, **overrides):
    kind = TASK_TYPE[task]
    params = dict(SIZES.get((task, algorithm), {}))
    if algorithm in ("random_forest", "gradient_boosting"):
        params.setdefault("maxMemoryInMB", node_memory(_session()))
    params.update(overrides)
    common = dict(labelCol=label, featuresCol=features)
    if kind == "regression":
        if algorithm == "random_forest":
            return RandomForestRegressor(seed=seed, **common, **params)
        if algorithm == "gradient_boosting":
            return GBTRegressor(seed=seed, **common, **params)
        # sklearn Ridge(alpha) == MLlib regParam = alpha * sigma_y / n (population sigma of the
        # label, no feature standardisation inside the solver); train_model fills in sigma_y and n
        reg = params.pop("regParam", 0.0)
        params.pop("alpha", None)
        return LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False, **common, **params)
    if algorithm == "random_forest":
        rf = RandomForestClassifier(seed=seed, **common, **params)
        return rf.setWeightCol(weight) if weight else rf
    if algorithm == "gradient_boosting":
        gbt = GBTClassifier(seed=seed, labelCol="label", featuresCol="features", **params)
        ovr = OneVsRest(classifier=gbt, parallelism=CLASSES_AT_ONCE, **common)
        return ovr.setWeightCol(weight) if weight else ovr
    svc = LinearSVC(maxIter=params.pop("maxIter", 50), regParam=params.pop("regParam", 0.01))
    ovr = OneVsRest(classifier=svc, parallelism=CLASSES_AT_ONCE, **common)
    return ovr.setWeightCol(weight) if weight else ovr


def _pipeline(features: Sequence[str], estimator) -> Pipeline:
    imputed = [f"_imp_{c}" for c in features]
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        estimator,
    ])


def usable_rows(df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, list[str]]:
    """The rows to learn from and the features to learn them by. Rows with a missing label or feature go (as the platform dropped them), but
    a feature that no labelled row knows is left out instead: it tells nothing, and would take every row with it (a strict mean over 15 days
    where each fortnight misses a value, or a ratio to a deviation of 0)."""
    known = df.filter(F.col(label).isNotNull()).agg(
        *[F.count(F.nullif(F.col(c).cast("double"), F.lit(float("nan")))).alias(f"n{i}") for i, c in enumerate(features)]).first()
    feats = [c for i, c in enumerate(features) if known[f"n{i}"]]
    return df.dropna(how="any", subset=[*feats, label]), feats


def varying(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that vary in ``df`` beyond the rounding of their values; all of them if none does."""
    st = df.agg(*[x for i, c in enumerate(features) for x in (F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"))]).first()
    return [c for i, c in enumerate(features) if (st[f"s{i}"] or 0.0) > 1e-12 * max(1.0, abs(st[f"m{i}"] or 0.0))] or list(features)


def node_memory(spark: SparkSession) -> int:
    """MB of node statistics that a task may hold at once in growing a forest: each of an executor's tasks holds as much, and some more in
    combining it, so it is a quarter of the heap over the cores. Less means more passes over the rows, not smaller trees."""
    sc = spark.sparkContext
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    conf = sc.getConf()
    size = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g").lower().rstrip("b")
    unit = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    heap = int(size[:-1]) * unit[size[-1]] if size[-1] in unit else int(size)
    cores = int(conf.get("spark.executor.cores", "0")) or sc.defaultParallelism
    return int(min(1024, max(64, heap / (4 * cores))))


#: rows of a training partition, at least and at most
TASK_ROWS = (10_000, 250_000)


def training_layout(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (of ``rows`` rows) dealt out for learners that scan it many times. Every partition, empty ones too, sends its statistics of every tree
    node, so their number follows the rows, not the plan that made them: twice the cores, but between TASK_ROWS rows in each. Rows
    go by their hash and are sorted, so that bootstraps, and with them the models, do not depend on how the rows came."""
    low, high = TASK_ROWS
    each = min(high, max(low, math.ceil(rows / (2 * df.sparkSession.sparkContext.defaultParallelism))))
    return df.repartition(max(1, math.ceil(rows / each)), *df.columns).sortWithinPartitions(*df.columns)


def train_model(df: DataFrame, features: Sequence[str], label: str, task: str, algorithm: str = "random_forest",
                test: float = 0.2, seed: int = 42, key: Column | None = None, leak: bool = False, stratify: bool = False,
                **overrides) -> FittedModel:
    """Fit on the training rows, evaluate on the held-out rows (see ``usable_rows``; the model's ``input_features`` are the features
    used). ``stratify``: hold out exactly the share ``test`` of each class."""
    kind = TASK_TYPE[task]
    # counting, splitting and laying out read the frame again: its plan runs once
    data, feats = usable_rows(written(df), features, label)
    features = feats
    data = data.withColumn("label", F.col(label).cast("double"))
    data = stratified_split(data, "label", test, seed, key) if stratify else train_test_split(data, key, test, seed)
    keep = [c for c in ("region", "date") if c in data.columns]
    data = data.select(*keep, *feats, "label", "is_test")
    if stratify or algorithm == "nystroem_svm":          # the split's joins run once; fit and projection read the rows four times
        data = written(data)
    rows, data = data, training_layout(data, data.count())
    projection = None
    if algorithm in ("svm", "nystroem_svm") and kind == "classification":
        fit = fit_projection if algorithm == "svm" else fit_nystroem
        sizes = {k: overrides.pop(k) for k in ("n_landmarks", "n_components") if k in overrides}
        projection = fit(rows if leak else rows.filter(~F.col("is_test")), feats, seed=seed, **sizes)
        data = project(data, projection, keep=["region", "date", "label", "is_test"])
        feats = [f"{'rff' if algorithm == 'svm' else 'nys'}_{j}" for j in range(projection["n_components"])]
    # iterative learners scan the training rows many times: materialise the prepared frame once
    # (MEMORY_AND_DISK; if an executor is lost its blocks are recomputed from the deterministic plan)
    from pyspark import StorageLevel
    prepared = data = data.persist(StorageLevel.MEMORY_AND_DISK)
    weight = None
    if kind == "classification" and task in BALANCED and algorithm != "gradient_boosting":
        data = class_weights(data, "label", "weight", fit=data if leak else data.filter(~F.col("is_test")))
        weight = "weight"
    if kind == "regression" and algorithm not in ("random_forest", "gradient_boosting"):
        # a constant feature has weight 0, but makes the normal equations singular: the solver then only approaches their solution
        features = feats = varying(data if leak else data.filter(~F.col("is_test")), feats)
        alpha = overrides.pop("alpha", RIDGE_ALPHA.get(task, 0.0))
        if alpha:
            st = data.filter(~F.col("is_test")).agg(F.count(F.lit(1)).alias("n"),
                                                    F.stddev_pop("label").alias("sd")).first()
            overrides["regParam"] = float(alpha) * float(st["sd"] or 0.0) / max(int(st["n"]), 1)
    if kind == "classification" and algorithm == "random_forest" and not data.filter("label > 0").limit(1).count():
        # the learner counts classes by the largest label and takes two at least, or the number stated with the column
        data = data.withMetadata("label", {"ml_attr": {"type": "nominal", "num_vals": 2}})
    est = make_estimator(task, algorithm, "label", "features", weight, seed, **overrides)
    try:
        train = data.filter(~F.col("is_test"))
        pipe = _pipeline(feats, est)
        model = pipe.fit(data if leak else train)
        pred = model.transform(data.filter(F.col("is_test")))
        ev = pred.select(F.lit(f"{task}_{algorithm}").alias("model"), F.col("label").alias("y"),
                         F.col("prediction").alias("yhat"))
        m = regression_metrics(ev) if kind == "regression" else classification_metrics(ev)
        if kind == "regression":                         # of a constant target 1 if every prediction is exact, else 0 (sklearn's r2_score)
            m = m.withColumn("r2", F.coalesce("r2", (F.col("mse") == 0).cast("double")))
        # a handful of numbers: evaluate now, while the training rows are still cached
        metrics = data.sparkSession.createDataFrame(m.collect(), m.schema)
        n_train = train.count()
    finally:
        prepared.unpersist()
    return FittedModel(model, feats, label, task, metrics,
                       {"algorithm": algorithm, "input_features": features, "projection": projection, "n_train": n_train})


def score(df: DataFrame, model: FittedModel, key: Sequence[str] = ("region", "date")) -> DataFrame:
    """Batch scoring: prediction and, for probabilistic classifiers, confidence = max p * 100
    (75 when the model has no probabilities)."""
    data = df
    if model.extra.get("projection"):
        data = project(df, model.extra["projection"], keep=list(key))
    out = model.pipeline.transform(data)
    conf = F.array_max(vector_to_array("probability")) * F.lit(100.0) if "probability" in out.columns \
        else F.lit(75.0)
    keep = [c for c in key if c in out.columns]
    return out.select(*keep, "prediction", conf.alias("confidence"))


def save(model: FittedModel, path: str) -> None:
    """Pipeline via the ML writer; the feature list and the projection are stored beside it as a one-row parquet."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark = _session()
    spark.createDataFrame([(model.feature_names, model.label, model.task, model.extra.get("algorithm"),
                            model.extra.get("input_features"), json.dumps(model.extra.get("projection")))],
                          "features array<string>, label string, task string, algorithm string, "
                          "input_features array<string>, projection string").write.mode("overwrite").parquet(f"{path}/meta")


def load(spark, path: str) -> FittedModel:
    """Reload a saved model; refuses a path without a fitted pipeline."""
    pipe = PipelineModel.load(f"{path}/pipeline")
    meta = spark.read.parquet(f"{path}/meta").first()
    if meta is None:
        raise ValueError(f"no trained model at {path}")
    return FittedModel(pipe, list(meta["features"]), meta["label"], meta["task"], None,
                       {"algorithm": meta["algorithm"], "input_features": list(meta["input_features"] or []),
                        "projection": json.loads(meta["projection"])})


def metric_rows(task: str, model: FittedModel) -> DataFrame:
    """A trained task's metrics in long form (task, status, metric, value)."""
    m = model.metrics
    cols = [c for c in m.columns if c not in ("model", "n")]
    return m.select(F.lit(task).alias("task"), F.lit("ok").alias("status"),
                    F.explode(F.array(*[F.struct(F.lit(c).alias("metric"),
                                                 F.col(c).cast("double").alias("value"))
                                        for c in cols])).alias("m")).select("task", "status", "m.metric", "m.value")


def train_all(frames: dict[str, tuple[DataFrame, Sequence[str], str]], algorithm: str = "random_forest",
              **overrides) -> tuple[dict[str, FittedModel], DataFrame]:
    """Train the tasks side by side (growing a forest waits for the driver between its levels); a failing task is reported with its error and the
    others continue. Returns the fitted models and one metrics DataFrame (task, status, metric, value)."""
    from concurrent.futures import ThreadPoolExecutor

    def one(task):
        df, feats, label = frames[task]
        try:
            fm = train_model(df, feats, label, task, algorithm, **overrides)
            return fm, metric_rows(task, fm)
        except Exception as e:  # noqa: BLE001 - continue with the other tasks, as the platform did
            return None, df.sparkSession.createDataFrame([(task, f"error: {str(e)[:200]}", None, None)],
                                                         "task string, status string, metric string, value double")

    spark = next(iter(frames.values()))[0].sparkSession
    with ThreadPoolExecutor(len(frames)) as pool:
        done = dict(zip(frames, pool.map(inheritable_thread_target(spark)(one), frames), strict=True))
    return {t: fm for t, (fm, _) in done.items() if fm}, functools.reduce(DataFrame.unionByName, [m for _, m in done.values()])
