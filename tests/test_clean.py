"""Cleaning on hand-written pond rows; expected values computed by hand."""
import datetime as dt

from pyspark.sql import functions as F

from pondlens.config import CSV_SCHEMAS, PipelineConfig
from pondlens.operators import clean as C

AS_OF = "2026-01-01 00:00:00"


def _cycles(spark):
    rows = [(1, 10, 100.0, 500.0, "2024-01-01 00:00:00", "2024-04-10 00:00:00"),
            (2, 10, None, 600.0, "2024-02-01 00:00:00", None),          # NULL seed, open cycle
            (3, 11, -300.0, 700.0, "bad-date", "2024-05-01 00:00:00"),   # negative seed, bad date
            (4, 11, 0.0, 800.0, "2024-03-01 00:00:00", "2024-06-01 00:00:00"),  # zero seed
            (5, 12, 5000.0, None, "2024-03-05 00:00:00", "2024-06-05 00:00:00")]
    return spark.createDataFrame(rows, CSV_SCHEMAS["cycles"])


def test_coerce_and_impute_median_on_raw(spark):
    df = C.coerce_dates(_cycles(spark), ["started_at", "finished_at"])
    assert df.where(F.col("started_at").isNull()).count() == 1
    out, vals = C.impute_numeric(df, {"total_seed": "median", "area": "median"})
    # raw median of (100, -300, 0, 5000) = (0 + 100) / 2: taken before negatives are fixed
    assert vals["total_seed"] == 50.0 and vals["area"] == 650.0
    got = {r.id: r.total_seed for r in out.collect()}
    assert got[2] == 50.0


def test_all_null_column_falls_back_to_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "cycle_id bigint, average_weight double")
    out, vals = C.impute_numeric(df, {"average_weight": "median"})
    assert vals["average_weight"] is None
    assert [r.average_weight for r in out.collect()] == [0.0, 0.0]


def test_full_chain_cycles(spark):
    cat = C.coerce_catalog({"cycles": _cycles(spark)})
    reports = {}
    cl = C.clean_catalog(cat, PipelineConfig(as_of=AS_OF), reports)["cycles"]
    rows = {r.id: r for r in cl.collect()}
    # started_at median of 4 valid dates (Jan 1, Feb 1, Mar 1, Mar 5) -> midpoint of Feb 1 / Mar 1
    assert rows[3].started_at == dt.datetime(2024, 2, 15, 12, 0)
    # Open cycle ends at as_of
    assert rows[2].finished_at == dt.datetime(2026, 1, 1)
    # C3 abs then C4: zero -> smallest positive after abs = 50 (the imputed median)
    assert rows[3].total_seed == 300.0
    assert rows[4].total_seed == 50.0
    # Quartiles of (100, 50, 300, 50, 5000): q1 = 50, q3 = 300 -> upper fence 675
    assert rows[5].total_seed == 675.0
    assert reports["cycles"]["iqr_bounds"]["total_seed"] == (50 - 1.5 * 250, 300 + 1.5 * 250)
    assert cl.where(F.col("total_seed").isNull() | F.col("area").isNull()).count() == 0


def test_date_by_group_then_global(spark):
    rows = [(1, 1.0, "2024-01-01 00:00:00"), (1, 1.0, "2024-01-03 00:00:00"), (1, 1.0, None),
            (2, 1.0, None), (None, 1.0, None), (3, 1.0, "2024-02-01 00:00:00")]
    df = C.coerce_dates(spark.createDataFrame(rows, CSV_SCHEMAS["feeds"]), ["logged_at"])
    out = C.impute_date_by_group(df, "logged_at", AS_OF).collect()
    got = sorted((r.cycle_id or 0, r.logged_at) for r in out)
    # cycle 1 NULL -> its median Jan 2; after that the global median of (1, 3, 2 Jan, Feb 1) = Jan 2 12:00
    assert (1, dt.datetime(2024, 1, 2)) in got
    assert (2, dt.datetime(2024, 1, 2, 12)) in got and (0, dt.datetime(2024, 1, 2, 12)) in got


def test_fix_zero_keeps_zero_without_positive(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "quantity double")
    out, mins = C.fix_zero(df, ["quantity"])
    assert mins["quantity"] is None and [r.quantity for r in out.collect()] == [0.0, 0.0]


def test_iqr_constant_column(spark):
    df = spark.createDataFrame([(8.0,), (8.0,), (8.0,)], "evening_pH double")
    out, bounds = C.iqr_cap(df, ["evening_pH"])
    assert bounds["evening_pH"] == (8.0, 8.0)
    assert C.iqr_outliers(df, "m", bounds).count() == 0
