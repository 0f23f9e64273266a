"""Feature preparation, MLlib regressors, search and evaluation.

The model is one ``Pipeline``: mean ``Imputer`` (fitted on the training rows
only), ``OneHotEncoder`` for month and quarter, ``VectorAssembler``,
``StandardScaler`` and the regressor. Training data stays distributed;
cross-validation and random search are Spark jobs (``CrossValidator`` with
``parallelism``). The train/test split is a hash of the cycle id, so it is
stable under re-partitioning and executor loss (unlike ``randomSplit`` on a
recomputed input).
"""

from __future__ import annotations

import json
import os
import random
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pondlens.config import BASE_FEATURES, FCR_VALID, IQR_FACTOR, SEASONAL_FEATURES, WATER_FEATURE_MARKERS
from pondlens.functions.exprs import clip
from pondlens.operators.quantiles import quantile_values
from pondlens.sources.catalog import path_exists

# M2: target name -> column (the FCR model is trained on FCR, not body weight)
TARGETS = {"sr": "survival_rate", "abw": "average_weight", "fcr": "fcr"}
TARGET_LABELS = {"sr": "Survival Rate", "abw": "Average Body Weight", "fcr": "FCR"}
TRAIN_PERCENT = 80
SEED = 42
METADATA = "metadata"      # text file written beside the models

# fixed values: the reference's default model settings
DEFAULT_MODELS = {
    "rf": {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 2, "seed": SEED},
    "xgb": {"maxIter": 200, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 3,
            "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": SEED},
    "lgb": {"maxIter": 200, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8", "seed": SEED},
}


# ---------------------------------------------------------------- M1-M5 ----

def feature_columns(df: DataFrame) -> list[str]:
    """M1: base features, every column naming a water parameter, month, quarter."""
    water = [c for c in df.columns if any(m in c for m in WATER_FEATURE_MARKERS)]
    feats = BASE_FEATURES + water + SEASONAL_FEATURES
    seen, out = set(), []
    for f in feats:
        if f in df.columns and f not in seen:
            seen.add(f)
            out.append(f)
    return out


def split_bucket(col="id") -> F.Column:
    """Deterministic bucket 0-99 of a key (multiplicative mix, no overflow)."""
    k = F.pmod(F.col(col).cast("bigint"), F.lit(2147483648))
    h = F.pmod(k * F.lit(1103515245) + F.lit(12345), F.lit(2147483648))
    return F.pmod(F.floor(h / F.lit(65536)), F.lit(100))


def is_train(col="id") -> F.Column:
    return split_bucket(col) < TRAIN_PERCENT


def fold_of(col: str, folds: int) -> F.Column:
    """Cross-validation fold of a key: a hash, so folds stay the same whatever the partitioning."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.col(col)), F.lit(max(folds, 1))).cast("int")


def model_frame(main: DataFrame, target: str) -> DataFrame:
    """Id, features and ``label`` for rows with a target value."""
    col = TARGETS[target]
    feats = feature_columns(main)
    return (main.where(F.col(col).isNotNull())
            .select("id", *[F.col(f).cast("double").alias(f) for f in feats], F.col(col).cast("double").alias("label")))


def feature_means(frame: DataFrame) -> DataFrame:
    """M3: mean of every feature over the model rows (one aggregate)."""
    feats = [c for c in frame.columns if c not in ("id", "label")]
    wide = frame.agg(*[F.avg(f).alias(f) for f in feats])
    return wide.unpivot([], feats, "feature", "mean")


def one_hot_counts(frame: DataFrame) -> DataFrame:
    """M4: rows per one-hot slot of month and quarter."""
    parts = []
    for f in SEASONAL_FEATURES:
        if f in frame.columns:
            parts.append(frame.where(F.col(f).isNotNull()).groupBy(F.col(f).cast("bigint").alias("category"))
                         .agg(F.count(F.lit(1)).alias("n")).select(F.lit(f).alias("feature"), "category", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def split_counts(frame: DataFrame) -> DataFrame:
    """M5: train/test row counts of the 80/20 hash split."""
    return (frame.select(F.when(is_train(), F.lit("train")).otherwise(F.lit("test")).alias("split"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- M11 ------

def abw_fence_values(frame: DataFrame) -> tuple[float | None, float | None, float | None, float | None]:
    q = quantile_values(frame.where(is_train()), ["label"], [0.01, 0.99])
    a, b = q[("label", 0.01)], q[("label", 0.99)]
    if a is None or b is None:
        return a, b, None, None
    return a, b, a - IQR_FACTOR * (b - a), b + IQR_FACTOR * (b - a)


def abw_fences(frame: DataFrame) -> DataFrame:
    """Fences from the 1 % / 99 % training quantiles +- 1.5 x their range."""
    a, b, lo, hi = abw_fence_values(frame)
    return frame.where(is_train()).agg(F.count(F.lit(1)).alias("n_train")).select(
        "n_train", F.lit(a).cast("double").alias("q01"), F.lit(b).cast("double").alias("q99"),
        F.lit(lo).cast("double").alias("lower"), F.lit(hi).cast("double").alias("upper"))


def clip_bounds(frame: DataFrame, target: str) -> tuple[float | None, float | None]:
    """The target's clip range."""
    if target == "sr":
        return 0.0, 100.0
    if target == "fcr":
        return FCR_VALID
    _, _, lo, hi = abw_fence_values(frame)
    return lo, hi


# ---------------------------------------------------------------- M12 ------

def regression_metrics(pred: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """Rmse, mae, r2 (1 - SSres/SStot) of a scored test set, one aggregate.

    SStot is n times the population variance, which Spark merges stably.
    """
    y, p = F.col(label), F.col(prediction)
    return pred.agg(F.count(F.lit(1)).alias("n_test"), F.avg((p - y) * (p - y)).alias("mse"),
                    F.avg(F.abs(p - y)).alias("mae"), F.sum((y - p) * (y - p)).alias("ss_res"),
                    (F.var_pop(y) * F.count(y)).alias("ss_tot")).select(
        "n_test", F.sqrt("mse").alias("rmse"), "mae",
        (F.lit(1.0) - F.try_divide(F.col("ss_res"), F.nullif(F.col("ss_tot"), F.lit(0.0)))).alias("r2"))


def baseline_metrics(main: DataFrame) -> DataFrame:
    """M12 on the mean predictor: predict the training mean of the clipped target."""
    parts = []
    for t in TARGETS:
        frame = model_frame(main, t).select("id", "label")
        lo, hi = clip_bounds(frame, t)
        c = frame.select(is_train().alias("is_train"), clip("label", lo, hi).alias("label"))
        p0 = c.where("is_train").agg(F.avg("label").alias("p0")).first()["p0"]
        test = c.where(~F.col("is_train")).select("label", clip(F.lit(p0).cast("double"), lo, hi).alias("prediction"))
        parts.append(regression_metrics(test).select(F.lit(t).alias("target"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- M6-M10 ---

def make_regressor(algorithm: str, params: dict | None = None):
    params = dict(DEFAULT_MODELS[algorithm] if params is None else params)
    if algorithm == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol="label", **params)
    return GBTRegressor(featuresCol="features", labelCol="label", **params)


def build_pipeline(features: list[str], regressor) -> Pipeline:
    """M3/M4/M6 + regressor: impute (train mean), one-hot, assemble, scale, fit."""
    numeric = [f for f in features if f not in SEASONAL_FEATURES]
    seasonal = [f for f in features if f in SEASONAL_FEATURES]
    stages = []
    imp_out = [f"{f}__imp" for f in numeric]
    if numeric:
        stages.append(Imputer(strategy="mean", inputCols=numeric, outputCols=imp_out))
    oh_out = []
    if seasonal:
        seas_in = [f"{f}__idx" for f in seasonal]
        oh_out = [f"{f}__oh" for f in seasonal]
        stages.append(_SeasonalIndex(seasonal, seas_in))
        stages.append(OneHotEncoder(inputCols=seas_in, outputCols=oh_out, dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=imp_out + oh_out, outputCol="raw_features", handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    stages.append(regressor)
    return Pipeline(stages=stages)


def _SeasonalIndex(inputs, outputs):
    """Month/quarter to a fixed category index (13 / 5 slots incl. unknown)."""
    from pyspark.ml.feature import SQLTransformer
    sel = ", ".join(f"CAST(coalesce({i}, 0) AS DOUBLE) AS {o}" for i, o in zip(inputs, outputs))
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


def random_param_maps(algorithm: str, est, n_iter: int, seed: int = SEED) -> list:
    """Seeded random draws over the reference's search ranges."""
    rng = random.Random(seed)
    grid = []
    for _ in range(n_iter):
        if algorithm == "rf":
            depth = rng.choice([30] + list(range(5, 30)))
            pm = {est.numTrees: rng.randrange(100, 500), est.maxDepth: depth,
                  est.minInstancesPerNode: rng.randrange(1, 10)}
        else:
            pm = {est.maxIter: rng.randrange(100, 500), est.maxDepth: rng.randrange(3, 10),
                  est.stepSize: rng.uniform(0.01, 0.31), est.subsamplingRate: rng.uniform(0.6, 1.0),
                  est.featureSubsetStrategy: str(round(rng.uniform(0.6, 1.0), 3))}
            if algorithm == "xgb":
                pm[est.minInstancesPerNode] = rng.randrange(1, 7)
        grid.append(pm)
    return grid


@dataclass
class TrainResult:
    target: str
    algorithm: str
    model: PipelineModel
    rmse: float
    mae: float
    r2: float
    cv_mean: float | None
    cv_std: float | None
    features: list = field(default_factory=list)
    error: str | None = None      # why the algorithm failed (it then has no model)


def train_target(main: DataFrame, target: str, algorithms=("rf", "xgb", "lgb"), n_iter: int = 20,
                 folds: int = 5, params: dict | None = None, parallelism: int = 4) -> list[TrainResult]:
    """M7-M14 for one target: search, refit, evaluate on the clipped test set.

    ``folds < 2`` fits the given parameters directly (no cross-validation).
    The model frame is persisted once and reused by every fit of the search.
    """
    frame = model_frame(main, target)
    feats = [c for c in frame.columns if c not in ("id", "label")]
    lo, hi = clip_bounds(frame, target)
    data = frame.select("id", *feats, clip("label", lo, hi).alias("label"),
                        is_train().alias("__train"), fold_of("id", folds).alias("__fold")).persist(StorageLevel.MEMORY_AND_DISK)
    train = data.where("__train").drop("__train")
    test = data.where(~F.col("__train")).drop("__train")
    results = []
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="r2")
    try:
        for alg in algorithms:
            try:
                reg = make_regressor(alg, (params or {}).get(alg))
                pipe = build_pipeline(feats, reg)
                cv_mean = cv_std = None
                if folds >= 2:
                    grid = random_param_maps(alg, reg, n_iter) if n_iter > 0 else ParamGridBuilder().build()
                    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=evaluator,
                                        numFolds=folds, foldCol="__fold", parallelism=parallelism)
                    cvm = cv.fit(train)
                    best = cvm.bestModel
                    best_i = max(range(len(cvm.avgMetrics)), key=lambda i: cvm.avgMetrics[i])
                    cv_mean = float(cvm.avgMetrics[best_i])
                    cv_std = float(cvm.stdMetrics[best_i]) if cvm.stdMetrics else None
                else:
                    best = pipe.fit(train)
                pred = best.transform(test).withColumn("prediction", clip("prediction", lo, hi))
                m = regression_metrics(pred).first()
                results.append(TrainResult(target, alg, best, _f(m["rmse"]), _f(m["mae"]), _f(m["r2"]),
                                           cv_mean, cv_std, feats))
            except Exception as exc:  # M14: an algorithm that fails is left out of the choice, and reported
                results.append(TrainResult(target, alg, None, None, None, None, None, None, feats,
                                           f"{type(exc).__name__}: {exc}"[:500]))
    finally:
        data.unpersist()
    return results


def _f(x):
    return None if x is None else float(x)


def best_result(results: list[TrainResult]) -> TrainResult | None:
    """Best by cross-validated mean R2, of the algorithms that did not fail."""
    fitted = [r for r in results if r.error is None]
    ok = [r for r in fitted if r.cv_mean is not None]
    return max(ok, key=lambda r: r.cv_mean) if ok else (fitted[0] if fitted else None)


def summary_frame(spark, results: list[TrainResult]) -> DataFrame:
    """Target x algorithm x metrics."""
    rows = [(TARGET_LABELS[r.target], r.algorithm.upper(), _f(r.r2), _f(r.rmse), _f(r.mae), _f(r.cv_mean),
             _f(r.cv_std), r.error) for r in results]
    return spark.createDataFrame(rows, "model_type string, algorithm string, r2 double, rmse double, mae double, "
                                       "cv_mean double, cv_std double, error string")


def importance_frame(spark, result: TrainResult) -> DataFrame:
    """Feature importance of a tree model, mapped back to feature names
    (the one-hot slots of month and quarter are summed into one entry)."""
    from pyspark.ml.feature import OneHotEncoderModel
    reg = result.model.stages[-1]
    imp = reg.featureImportances.toArray().tolist()
    numeric = [f for f in result.features if f not in SEASONAL_FEATURES]
    seasonal = [f for f in result.features if f in SEASONAL_FEATURES]
    names = list(numeric)
    for st in result.model.stages:
        if isinstance(st, OneHotEncoderModel):
            extra = (1 if st.getHandleInvalid() == "keep" else 0) - (1 if st.getDropLast() else 0)
            for f, size in zip(seasonal, st.categorySizes):
                names += [f] * (size + extra)
    agg: dict[str, float] = {}
    for n, v in zip(names, imp):
        agg[n] = agg.get(n, 0.0) + float(v)
    return spark.createDataFrame(sorted(agg.items(), key=lambda kv: (-kv[1], kv[0])),
                                 "feature string, importance double")


# fixed values: the reference's search, which the registered queries run
REFERENCE = {"algorithms": ("rf", "xgb", "lgb"), "n_iter": 20, "folds": 5, "params": None}


def model_summary(main: DataFrame, settings: dict | None = None, workers: int = 9) -> DataFrame:
    """M16 over every target x algorithm; the independent trainings are
    submitted concurrently (Spark runs their jobs side by side)."""
    from concurrent.futures import ThreadPoolExecutor
    s = settings or REFERENCE
    tasks = [(t, a) for t in TARGETS for a in s["algorithms"]]
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        futs = [pool.submit(train_target, main, t, (a,), s["n_iter"], s["folds"], s["params"]) for t, a in tasks]
        res = [r for f in futs for r in f.result()]
    return summary_frame(main.sparkSession, res)


def trained(main: DataFrame) -> dict[str, list[TrainResult]]:
    """Every target by every algorithm at the reference's settings; Spark runs their jobs side by side."""
    from concurrent.futures import ThreadPoolExecutor
    s = REFERENCE
    tasks = [(t, a) for t in TARGETS for a in s["algorithms"]]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futs = [pool.submit(train_target, main, t, (a,), s["n_iter"], s["folds"], s["params"]) for t, a in tasks]
        res = [r for f in futs for r in f.result()]
    for r in res:
        if r.error:
            raise RuntimeError(f"{r.target}/{r.algorithm}: {r.error}")
    return {t: [r for r in res if r.target == t] for t in TARGETS}


def best_models(main: DataFrame) -> dict[str, TrainResult]:
    """The best algorithm of each target by cross-validation."""
    return {t: best_result(rs) for t, rs in trained(main).items()}


def prediction_errors(main: DataFrame, result: TrainResult) -> DataFrame:
    """Prediction - actual (unclipped actual) on the test rows of one fitted model."""
    frame = model_frame(main, result.target)
    lo, hi = clip_bounds(frame, result.target)
    pred = result.model.transform(frame.where(~is_train())).withColumn("prediction", clip("prediction", lo, hi))
    return pred.select(F.lit(result.target).alias("target"), F.lit(result.algorithm).alias("algorithm"), "id",
                       F.col("label").alias("actual"), "prediction", (F.col("prediction") - F.col("label")).alias("error"))


def all_prediction_errors(main: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [prediction_errors(main, r) for rs in trained(main).values() for r in rs])


def all_feature_importance(main: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        importance_frame(main.sparkSession, r).withColumn("target", F.lit(r.target)) for r in best_models(main).values()])


# ---------------------------------------------------------------- S6/S7/M18

def save_models(results: dict[str, TrainResult], out_dir: str) -> str:
    """One PipelineModel folder per target plus importance and metadata."""
    import datetime as _dt
    meta = {"export_time": _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S"),
            "targets": list(results), "features": {}}
    for t, r in results.items():
        r.model.write().overwrite().save(os.path.join(out_dir, f"{t}_model"))
        meta["features"][t] = len(r.features)
        meta.setdefault("feature_names", {})[t] = r.features
        meta.setdefault("algorithm", {})[t] = r.algorithm
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(out_dir, METADATA))
    return out_dir


def load_metadata(spark: SparkSession, model_dir: str) -> dict:
    """What ``save_models`` recorded, from any file system Spark reaches."""
    return json.loads(spark.read.text(os.path.join(model_dir, METADATA)).first()["value"])


def load_models(model_dir: str) -> dict[str, PipelineModel]:
    """Load whatever target models exist; only a missing folder is skipped."""
    spark = SparkSession.getActiveSession()
    paths = {t: os.path.join(model_dir, f"{t}_model") for t in TARGETS}
    return {t: PipelineModel.load(p) for t, p in paths.items() if path_exists(spark, p)}
