"""A hot cycle holding a third of every fact table: results stay exact."""
import datetime as dt

import numpy as np
import pandas as pd

from pondlens.config import PipelineConfig
from pondlens.operators import clean as C
from pondlens.operators import features as FE


def test_hot_cycle_main_table(spark):
    rng = np.random.default_rng(5)
    n = 9000
    cid = np.where(np.arange(n) % 3 == 0, 1, rng.integers(2, 400, n))          # cycle 1: a third of rows
    qty = rng.uniform(1, 50, n).round(4)
    qty[::97] = np.nan
    day = rng.integers(0, 90, n)
    feeds = pd.DataFrame({"cycle_id": cid, "quantity": qty,
                          "logged_at": [None if i % 41 == 0 else (dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d)))
                                        .strftime("%Y-%m-%d %H:%M:%S") for i, d in enumerate(day)]})
    cycles = pd.DataFrame({"id": np.arange(1, 400), "pond_id": 1, "total_seed": 1000.0, "area": 10.0,
                           "started_at": "2024-01-01 00:00:00", "finished_at": "2024-05-01 00:00:00"})
    cat = {"cycles": spark.createDataFrame(cycles, "id long, pond_id long, total_seed double, area double, "
                                                   "started_at string, finished_at string"),
           "feeds": spark.createDataFrame(feeds, "cycle_id long, quantity double, logged_at string")}
    cl = C.clean_catalog(C.coerce_catalog(cat), PipelineConfig())
    got = {r.cycle_id: r.total_feed for r in FE.feed_agg(cl["feeds"]).collect()}
    med = float(np.nanmedian(qty))
    exp = pd.Series(np.where(np.isnan(qty), med, qty)).groupby(cid).sum()
    assert abs(got[1] - exp[1]) < 1e-6 and len(got) == len(exp)
    # the hot cycle's NULL dates take its own exact median date
    hot_dates = pd.to_datetime(feeds.loc[(feeds.cycle_id == 1) & feeds.logged_at.notna(), "logged_at"])
    hot_med = hot_dates.sort_values().iloc[[(len(hot_dates) - 1) // 2, len(hot_dates) // 2]].mean()
    filled = {r.logged_at for r in cl["feeds"].where("cycle_id = 1").collect()}
    assert hot_med.to_pydatetime() in filled


def _facts(spark, hot: bool):
    """Rows of cycles scattered over the tasks; with ``hot``, a third of them on cycle 1."""
    from pyspark.sql import functions as F
    n = 4000
    cid = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit(1)).when(F.col("id") % 500 == 7, F.lit(None).cast("int")).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(900)).cast("int") + 2)
    df = spark.range(0, n, 1, 8).select("id", cid.cast("long").alias("cycle_id"), (F.col("id") % 17).cast("double").alias("quantity"))
    return df.cache()


def test_cycles_are_dealt_before_they_are_combined(spark):
    """Map tasks combine hot cycles only; results are those of a plain aggregate."""
    from pyspark.sql import functions as F
    for hot in (False, True):
        df = _facts(spark, hot)
        found = FE.hot_keys(df, "cycle_id")
        assert found == ([1] if hot else [])
        out = FE.feed_agg(df)
        want = df.where("cycle_id IS NOT NULL").groupBy("cycle_id").agg(F.sum("quantity").alias("total_feed"))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
        # from the scan upwards: the first exchange comes before the first aggregate, but for the hot rows
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = [x for x in plan.splitlines() if "HashAggregate" in x or "Exchange hashpartitioning" in x]
        assert ("partial_sum" in plan) and ("REPARTITION_BY_COL" in plan)
        assert hot or "Exchange" in below[-1], plan
        df.unpersist()


def test_only_the_tables_read_are_cleaned(spark):
    rows = {"cycles": spark.createDataFrame([(1, 1, None, 2.0, "2024-01-01", None), (2, 1, 4.0, None, None, "2024-05-01")],
                                            "id long, pond_id long, total_seed double, area double, started_at string, finished_at string"),
            "feeds": spark.createDataFrame([(1, -3.0, "2024-01-05"), (1, None, None), (2, 5.0, "2024-02-01")],
                                           "cycle_id long, quantity double, logged_at string"), "farms": None}
    cat = C.coerce_catalog(rows)
    lazy, whole = C.CleanedTables(cat, PipelineConfig()), C.clean_catalog(cat, PipelineConfig())
    assert lazy["farms"] is None and lazy["cycles"].collect() == whole["cycles"].collect()
    assert set(lazy.reports) == {"cycles"}
    assert {n: None if t is None else sorted(t.collect()) for n, t in lazy.items()} == {
        n: None if t is None else sorted(t.collect()) for n, t in whole.items()}
    assert list(lazy) == list(whole) and set(lazy.reports) == {"cycles", "feeds"}
