"""Automatic bins and density curves against scalar versions."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pondlens.operators import analysis as AN

RNG = np.random.default_rng(7)
SAMPLES = {"normal": RNG.normal(5, 2, 3000), "skewed": RNG.lognormal(0, 1.2, 3000), "steps": np.repeat([1.0, 2.0, 4.0], 1000),
           "flat": np.full(3000, 3.0)}


@pytest.fixture(scope="module")
def table(spark):
    rows = [[float(SAMPLES[k][i]) for k in SAMPLES] + [None] for i in range(3000)]
    rows += [[None] * len(SAMPLES) + [None], [math.nan] * len(SAMPLES) + [None]]
    df = spark.createDataFrame(rows, ", ".join(f"{k} double" for k in SAMPLES) + ", none double")
    return df, {k: F.col(k) for k in [*SAMPLES, "none"]}


def test_auto_bins_match_numpy(table):
    got = {}
    for r in AN.auto_histograms(*table).orderBy("metric", "bin").collect():
        got.setdefault(r.metric, []).append((r.bin_lo, r.bin_hi, r["count"]))
    assert set(got) == set(SAMPLES)
    for k, x in SAMPLES.items():
        if k == "flat":
            assert got[k] == [(2.5, 3.5, 3000)]
            continue
        counts, edges = np.histogram(x, bins=len(got[k]))
        assert [c for _, _, c in got[k]] == counts.tolist()
        assert np.allclose([lo for lo, _, _ in got[k]], edges[:-1])
        q1, q3 = np.quantile(x, [0.25, 0.75])
        width = np.ptp(x) / (math.log2(len(x)) + 1)
        if q3 > q1:
            width = min(width, max(2 * (q3 - q1) / len(x) ** (1 / 3), np.ptp(x) / math.sqrt(len(x)) / 2))
        assert len(got[k]) == math.ceil(np.ptp(x) / width)


def test_density_is_the_kernel_sum(table):
    got = {}
    for r in AN.densities(*table).orderBy("metric", "point").collect():
        got.setdefault(r.metric, []).append((r.x, r.density))
    assert set(got) == {"normal", "skewed", "steps"}
    for k, curve in got.items():
        x, grid = SAMPLES[k], np.array([a for a, _ in curve])
        assert len(grid) == AN.DENSITY_POINTS and grid[0] == x.min() and math.isclose(grid[-1], x.max())
        width = x.std(ddof=1) * len(x) ** -0.2
        exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / width) ** 2).sum(1) / (len(x) * width * math.sqrt(2 * math.pi))
        assert np.abs(np.array([d for _, d in curve]) - exact).max() < 0.002 * exact.max()


def test_errors_of_each_model(spark):
    df = spark.createDataFrame([("sr", "rf", 1.0), ("sr", "rf", 3.0), ("sr", "xgb", 2.0), ("fcr", "rf", None)],
                               "target string, algorithm string, error double")
    got = AN.auto_histograms(df, AN.error_metrics(df)).groupBy("metric").agg(F.sum("count").alias("n")).collect()
    assert {(r.metric, r.n) for r in got} == {("sr_rf", 2), ("sr_xgb", 1)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    assert AN.auto_histograms(df, {"a": F.col("a")}).count() == 0 and AN.densities(df, {"a": F.col("a")}).count() == 0
