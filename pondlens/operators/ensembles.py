"""Training, search, export and scoring of the SR / ABW / FCR models as node tables.

``train`` fits the three algorithms of every target with ``trees``: at the
reference's own settings, or after its random search of ``n_iter`` draws times
``folds`` folds. The models go to a new folder by time and become visible by a
marker that is written last, so a lost driver never leaves half an export to
load. Everything after - errors, importances, scoring, information - reads the
export. An algorithm that fails is reported and left out of the choice; an
export that lacks one gives no errors, importances, metadata or scores.

Labels are clipped as in ``models``; missing features take the mean of the
training rows; month and quarter are one column for each value. Trees only
compare values, so scaling (M6, ``scaled_features``) changes no split.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pondlens.config import SEASONAL_FEATURES, WATER_PARAMS
from pondlens.functions.exprs import clip
from pondlens.operators import models as M
from pondlens.operators import trees as T
from pondlens.sources.catalog import path_exists

#: The reference's settings. Its sampling of rows has no effect on "lgb" without a bagging frequency.
DEFAULTS = {
    "rf": T.Settings("forest", trees=200, min_split=5, min_leaf=2),
    "xgb": T.Settings("boost", trees=200, rate=0.05, max_depth=6, min_weight=3, subsample=0.8, colsample=0.8, gamma=0.1, l2=1.0),
    "lgb": T.Settings("boost", trees=200, rate=0.05, max_depth=6, leaves=31, min_leaf=20, min_weight=1e-3, colsample=0.8),
}
SEASONS = {"start_month": 12, "start_quarter": 4}
MARKER = "complete"
ALGORITHMS = {"rf": "RandomForestRegressor", "xgb": "XGBRegressor", "lgb": "LGBMRegressor"}


def draw_settings(algorithm: str, n_iter: int, seed: int = M.SEED) -> list[T.Settings]:
    """Seeded draws from the reference's search ranges (fixed values)."""
    rng, out = random.Random(seed), []
    for _ in range(n_iter):
        trees = rng.randrange(100, 500)
        if algorithm == "rf":
            out.append(T.Settings("forest", trees=trees, max_depth=rng.choice([None, *range(5, 30)]),
                                  min_split=rng.randrange(2, 20), min_leaf=rng.randrange(1, 10)))
            continue
        s = T.Settings("boost", trees=trees, max_depth=rng.randrange(3, 10), rate=rng.uniform(0.01, 0.31),
                       subsample=rng.uniform(0.6, 1.0), colsample=rng.uniform(0.6, 1.0))
        if algorithm == "xgb":
            out.append(replace(s, min_weight=rng.randrange(1, 7), l2=1.0))
        else:
            out.append(replace(s, leaves=rng.randrange(20, 100), subsample=1.0, min_leaf=20, min_weight=1e-3))
    return out


# ---------------------------------------------------------------- the training matrix

def feature_columns(features: list[str], means: dict[str, float]) -> dict[str, F.Column]:
    """M3/M4: each model column from a frame that has ``features``."""
    out = {f: F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(means.get(f, 0.0))) for f in features if f not in SEASONAL_FEATURES}
    for f in features:
        for v in range(1, SEASONS[f] + 1) if f in SEASONS else ():
            out[f"{f}_{v}"] = F.coalesce((F.col(f"`{f}`") == v).cast("double"), F.lit(0.0))
    return out


def scaler(main: DataFrame) -> dict[str, tuple[float, float]]:
    """M6: mean and standard deviation of each numeric feature over the training rows (one aggregate)."""
    feats = [f for f in M.feature_columns(main) if f not in SEASONAL_FEATURES]
    aggs = [a for i, f in enumerate(feats) for a in (F.avg(F.col(f"`{f}`").cast("double")).alias(f"m{i}"),
                                                     F.stddev_pop(F.col(f"`{f}`").cast("double")).alias(f"s{i}"))]
    got = main.where(M.is_train()).agg(F.lit(0).alias("_"), *aggs).first()
    return {f: (got[f"m{i}"], got[f"s{i}"]) for i, f in enumerate(feats)}


def scaled_features(main: DataFrame) -> DataFrame:
    """M6: id and the numeric features, missing ones at the mean, scaled by the training rows (a constant one is only centred)."""
    cols = []
    for f, (m, s) in scaler(main).items():
        x = F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(m).cast("double")) - F.lit(m).cast("double")
        cols.append((x / F.lit(s) if s else x).alias(f))
    return main.select("id", *cols)


def scaled_ranges(main: DataFrame) -> DataFrame:
    """Per feature: rows, the scaler's mean and std, and the range of the scaled values."""
    found, scaled = scaler(main), scaled_features(main)
    wide = scaled.agg(F.count(F.lit(1)).alias("n"), *[F.struct(F.min(f).alias("col1"), F.max(f).alias("col2")).alias(f) for f in found])
    rows = [F.struct(F.lit(f).alias("feature"), F.col("n"), F.lit(m).cast("double").alias("mean"), F.lit(s).cast("double").alias("std"),
                     F.col(f"`{f}`.col1").alias("lowest"), F.col(f"`{f}`.col2").alias("highest")) for f, (m, s) in found.items()]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def matrix(main: DataFrame, folds: int) -> tuple[T.Matrix, dict]:
    """The binned matrix of all targets, and what scoring needs: features, means, label bounds."""
    features = M.feature_columns(main)
    numeric = [f for f in features if f not in SEASONAL_FEATURES]
    got = main.where(M.is_train()).agg(F.lit(0).alias("_"), *[F.avg(F.col(f"`{f}`").cast("double")).alias(f"m{i}") for i, f in enumerate(numeric)]).first()
    means = {f: got[f"m{i}"] if got[f"m{i}"] is not None else 0.0 for i, f in enumerate(numeric)}
    bounds = {t: M.clip_bounds(M.model_frame(main, t), t) for t in M.TARGETS}
    columns = feature_columns(features, means)
    labels = [clip(F.col(c).cast("double"), *bounds[t]).alias(f"y_{t}") for t, c in M.TARGETS.items()]
    frame = main.select(F.col("id").cast("long").alias("id"), M.is_train().alias("train"), M.fold_of("id", folds).alias("fold"), *labels,
                        *[c.alias(n) for n, c in columns.items()])
    m = T.bin_table(frame, list(columns), list(M.TARGETS))
    m.rows = T.stored(m.rows, "binned")
    return m, {"features": features, "means": means, "bounds": bounds}


# ---------------------------------------------------------------- fitting

def r2_by_fit(predictions: DataFrame) -> dict[int, float | None]:
    """R2 of each fit's held-out rows (one number a fit)."""
    y, p = F.col("y"), F.col("prediction")
    got = predictions.groupBy("fit").agg(
        (F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0)))).alias("r2")).collect()
    return {r["fit"]: r["r2"] for r in got}


def cross_validated(m: T.Matrix, label: str, settings: list[T.Settings], folds: int) -> list[tuple[float | None, float | None]]:
    """Mean and standard deviation of R2 over the folds, for each of the settings; all fits run as one job."""
    fits = [T.Fit(k * folds + f, label, s, f) for k, s in enumerate(settings) for f in range(folds)]
    r2 = r2_by_fit(T.held_out_predictions(m, fits))
    out = []
    for k in range(len(settings)):
        got = [r2.get(k * folds + f) for f in range(folds)]
        got = [x for x in got if x is not None]
        out.append((float(np.mean(got)), float(np.std(got))) if got else (None, None))
    return out


@dataclass
class Trained:
    """One target by one algorithm; ``error`` says why there is no model."""
    target: str
    algorithm: str
    fit: int
    settings: T.Settings
    base: float = 0.0
    cv_mean: float | None = None
    cv_std: float | None = None
    rmse: float | None = None
    mae: float | None = None
    r2: float | None = None
    error: str | None = None


def _train_one(m: T.Matrix, info: dict, target: str, algorithm: str, fit: int, settings: list[T.Settings], folds: int,
               folder: str) -> Trained:
    """One target by one algorithm; a failure is raised, ``train`` reports it."""
    scores = cross_validated(m, target, settings, folds)
    best = max(range(len(settings)), key=lambda k: -np.inf if scores[k][0] is None else scores[k][0])
    out = Trained(target, algorithm, fit, settings[best], cv_mean=scores[best][0], cv_std=scores[best][1])
    one = [T.Fit(fit, target, settings[best])]
    out.base = T.base_values(m, one)[fit]
    path = os.path.join(folder, "nodes", f"{target}_{algorithm}")
    T.fit_nodes(m, one).write.parquet(path)
    nodes = m.rows.sparkSession.read.parquet(path)
    y = F.col(f"y_{target}")
    rows = m.rows.where(~F.col("train") & y.isNotNull())
    scored = T.predict(rows, nodes, out.base, T.values_of_bins(m)).select(
        y.alias("label"), clip("prediction", *info["bounds"][target]).alias("prediction"))
    got = M.regression_metrics(scored).first()
    out.rmse, out.mae, out.r2 = got["rmse"], got["mae"], got["r2"]
    return out


def train(main: DataFrame, out_dir: str, n_iter: int = 0, folds: int = 5, settings: dict | None = None, workers: int = 4) -> str:
    """Fit every target by every algorithm and export; returns the export's folder.

    ``n_iter`` = 0 fits ``settings`` (default: the reference's own), else the
    best of ``n_iter`` draws by cross-validation.
    """
    spark = main.sparkSession
    m, info = matrix(main, folds)
    folder = os.path.join(out_dir, dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f"))
    tasks = []
    for t in M.TARGETS:
        for a, s in (settings or DEFAULTS).items():
            tasks.append((t, a, len(tasks), draw_settings(a, n_iter) if n_iter else [s]))

    def one(task: tuple) -> Trained:
        try:
            return _train_one(m, info, *task, folds, folder)
        except Exception as exc:  # M14: what fails is reported; only ``summary`` and ``model_info`` take an export that is not whole
            target, algorithm, fit, drawn = task
            return Trained(target, algorithm, fit, drawn[0], error=f"{type(exc).__name__}: {exc}"[:500])

    with ThreadPoolExecutor(workers) as pool:
        done = list(pool.map(one, tasks))
    meta = {"export_time": os.path.basename(folder), "search": {"n_iter": n_iter, "folds": folds, "fits": sum(len(x[3]) for x in tasks) * folds},
            "model_columns": m.features, **info, "results": [{**asdict(r), "settings": asdict(r.settings)} for r in done]}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(os.path.join(folder, M.METADATA))
    # the export counts from here on
    spark.createDataFrame([(os.path.basename(folder),)], "value string").coalesce(1).write.text(os.path.join(folder, MARKER))
    return folder


# ---------------------------------------------------------------- the export

def exports(spark: SparkSession, out_dir: str) -> list[str]:
    """Complete exports in a folder, oldest first; unfinished ones are passed over."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = sorted(str(s.getPath().getName()) for s in fs.listStatus(root) if s.isDirectory())
    return [p for p in (os.path.join(out_dir, n) for n in names) if path_exists(spark, os.path.join(p, MARKER, "_SUCCESS"))]


class Export:
    """What ``train`` wrote."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.meta = json.loads(spark.read.text(os.path.join(folder, M.METADATA)).first()["value"])
        self.results = [Trained(**{**r, "settings": T.Settings(**r["settings"])}) for r in self.meta["results"]]

    @classmethod
    def latest(cls, spark: SparkSession, out_dir: str) -> "Export | None":
        found = exports(spark, out_dir)
        return cls(spark, found[-1]) if found else None

    def fitted(self) -> list[Trained]:
        return [r for r in self.results if r.error is None]

    def whole(self) -> "Export":
        """This export, if every algorithm of it has a model; what the others give would look like the whole result."""
        failed = [f"{r.target} by {r.algorithm}: {r.error}" for r in self.results if r.error is not None]
        if failed:
            raise RuntimeError(f"{len(failed)} of {len(self.results)} models failed; " + "; ".join(failed))
        return self

    def best(self) -> dict[str, Trained]:
        """Each target's best model by cross-validated mean R2."""
        out: dict[str, Trained] = {}
        for r in self.fitted():
            if r.target not in out or (r.cv_mean is not None and r.cv_mean > (out[r.target].cv_mean or -np.inf)):
                out[r.target] = r
        return out

    def nodes(self, r: Trained) -> DataFrame:
        return self.spark.read.schema(T.NODE_SCHEMA).parquet(os.path.join(self.folder, "nodes", f"{r.target}_{r.algorithm}"))

    def bounds(self, target: str) -> tuple:
        return tuple(self.meta["bounds"][target])

    def apply(self, rows: DataFrame, r: Trained, name: str) -> DataFrame:
        """B2: ``rows`` (with the trained features, or without: their means) and the model's prediction."""
        have = {f: F.col(f"`{f}`") for f in rows.columns}
        given = {f: have.get(f, have.get(f[:-5]) if f.endswith("_mean") and f[:-5] in WATER_PARAMS else None) for f in self.meta["features"]}
        wide = rows.select(F.struct("*").alias("__row"), *[(F.lit(None) if c is None else c).cast("double").alias(f) for f, c in given.items()])
        columns = feature_columns(self.meta["features"], self.meta["means"])
        wide = wide.select("__row", *[columns[c].alias(f"x{i}") for i, c in enumerate(self.meta["model_columns"])])
        n = len(self.meta["model_columns"])

        def values(b) -> np.ndarray:
            return np.stack([b[f"x{i}"].to_numpy(zero_copy_only=False) for i in range(n)], axis=1)

        scored = T.predict(wide, self.nodes(r), r.base, values, "__p")
        return scored.select("__row.*", F.col("__p").alias(name))


def summary(e: Export) -> DataFrame:
    """Target x algorithm x metrics, with the settings chosen."""
    rows = [(M.TARGET_LABELS[r.target], r.algorithm.upper(), r.r2, r.rmse, r.mae, r.cv_mean, r.cv_std,
             json.dumps(asdict(r.settings)), r.error) for r in e.results]
    return e.spark.createDataFrame(rows, "model_type string, algorithm string, r2 double, rmse double, mae double, "
                                         "cv_mean double, cv_std double, settings string, error string")


def export_metadata(e: Export) -> DataFrame:
    """What the export says about itself, per target."""
    rows = [(t, r.algorithm, len(e.meta["features"]), ",".join(e.meta["features"]), *e.bounds(t)) for t, r in e.whole().best().items()]
    return e.spark.createDataFrame(rows, "target string, algorithm string, n_features int, feature_names string, lower double, upper double")


def prediction_errors(e: Export, main: DataFrame) -> DataFrame:
    """Prediction - actual (unclipped actual) on the test rows of every model."""
    parts = []
    for r in e.whole().fitted():
        rows = M.model_frame(main, r.target).where(~M.is_train())
        p = e.apply(rows, r, "prediction").withColumn("prediction", clip("prediction", *e.bounds(r.target)))
        parts.append(p.select(F.lit(r.target).alias("target"), F.lit(r.algorithm).alias("algorithm"), "id", F.col("label").alias("actual"),
                              "prediction", (F.col("prediction") - F.col("label")).alias("error")))
    return _union(parts)


def feature_importance(e: Export) -> DataFrame:
    """Each feature's share of the gain in its target's best model (the columns of month and quarter are one feature)."""
    columns = e.meta["model_columns"]
    names = [next((s for s in SEASONS if c.startswith(f"{s}_")), c) for c in columns]
    lookup = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1)
    parts = []
    for t, r in e.whole().best().items():
        gain = e.nodes(r).where("feature >= 0").groupBy(lookup.alias("feature")).agg(F.sum("gain").alias("gain"))
        total = e.nodes(r).agg(F.sum("gain").alias("total"))
        parts.append(gain.join(F.broadcast(total)).select("feature", F.try_divide("gain", "total").alias("importance"), F.lit(t).alias("target")))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score(e: Export, records: DataFrame) -> DataFrame:
    """Every record by the best model of each target; NULL for an invalid row."""
    from pondlens.operators import scoring as SC
    out, best = SC.with_validation(records), e.whole().best()
    for t, col in M.TARGETS.items():
        keep = out.columns
        out = e.apply(out, best[t], "__score")
        out = out.select(*keep, F.when(F.col(SC.VALID_FLAG[t]), clip("__score", *SC.CLIPS[t])).alias(col))
    return out


def model_info(e: Export) -> DataFrame:
    """Model type, feature count and status per target."""
    best = e.best()
    names = e.meta["features"]
    rows = [(t, ALGORITHMS[best[t].algorithm], len(names), ",".join(names), "loaded") if t in best else (t, None, 0, "", "missing")
            for t in M.TARGETS]
    return e.spark.createDataFrame(rows, "target string, model_type string, n_features int, feature_names string, status string")
