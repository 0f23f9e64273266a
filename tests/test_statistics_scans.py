"""Statistics by plain aggregates, and shuffles whose parts do not grow with the input."""

import numpy as np
from pyspark.sql import functions as F

from pondlens.operators import clean as C
from pondlens.operators import quantiles as Q
from pondlens.session import SHUFFLE_PARTITIONS


def _quantile(vals, q):
    return float(np.quantile(np.array(vals, dtype=float), q, method="linear"))


def test_column_quantiles_need_no_sketch(spark, monkeypatch):
    """Slots of an octave, and ranges in which nearly all values lie in one slot (times of a day)."""
    rng = np.random.default_rng(5)
    times = 1.5e15 + rng.integers(0, 86_400_000_000, 4000).astype(float)
    wide = rng.normal(0, 1, 4000) * 10.0 ** rng.integers(-300, 300, 4000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(times, wide)], "a double, b double")
    monkeypatch.setattr(Q.F, "kll_sketch_agg_double", lambda *x: (_ for _ in ()).throw(AssertionError("sketch")))
    written, step = [], Q._narrowed
    monkeypatch.setattr(Q, "_narrowed", lambda small, *x: (written.append(small.groupBy().sum("c").first()[0]), step(small, *x))[1])
    monkeypatch.setattr(Q, "INSIDE_ROWS", 10)
    got = Q.column_quantiles([(df, {"a": F.col("a"), "b": F.col("b")})], [0.25, 0.5])
    for q in (0.25, 0.5):
        assert got[("a", q)] == _quantile(times, q) and got[("b", q)] == _quantile(wide, q)
    assert 0 < written[0] <= 4 * 0.05 * len(times)       # at most four ranges a column, of five per cent


def test_cleaning_scans_a_table_once_for_its_plain_statistics(spark, monkeypatch):
    rows = [(1, 2.0, None, "2020-01-01"), (2, 0.0, 5.0, None), (3, -4.0, 7.0, "2020-01-03")]
    cycles = spark.createDataFrame(rows, "id bigint, total_seed double, area double, started_at string")
    coerced = C.coerce_catalog({"cycles": cycles})
    monkeypatch.setattr(type(cycles), "unpivot", lambda *x, **y: (_ for _ in ()).throw(AssertionError("unpivot")))
    monkeypatch.setattr(C, "_quantiles", lambda items, probs: {(k, q): 1.0 for k, _, _ in items for q in probs})
    reports: dict = {}
    C.clean_catalog(coerced, reports=reports)
    assert reports["cycles"]["min_positive"]["total_seed"] == 2.0


def test_parts_of_a_shuffle_follow_its_size(spark):
    """Many parts to begin with, merged by size; a join with a small side sorts neither."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(5000).selectExpr("id % 500 AS cycle_id", "id AS x")
        j = facts.join(spark.range(500), F.col("cycle_id") == F.col("id"), "left")
        assert len(j.collect()) == 5000
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert f", {SHUFFLE_PARTITIONS})" in plan
    assert "ShuffledHashJoin" in plan.split("Initial Plan")[0]
