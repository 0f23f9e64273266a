from pyspark.sql import functions as F

from pondlens.functions import exprs as X


def test_floor_days_sub_day(spark):
    df = spark.createDataFrame(
        [("2024-01-02 00:00:00", "2024-01-01 02:00:00"),   # 22 h after: 0
         ("2024-01-01 00:00:00", "2024-01-01 22:00:00"),   # 22 h before: -1
         ("2024-01-02 01:00:00", "2024-01-01 23:00:00"),   # 2 h across midnight: 0
         ("2024-01-11 00:00:00", "2024-01-01 00:00:00"),
         (None, "2024-01-01 00:00:00")], "a string, b string")
    out = df.select(X.floor_days(F.to_timestamp("a"), F.to_timestamp("b")).alias("d")).collect()
    assert [r.d for r in out] == [0, -1, 0, 10, None]


def test_safe_div_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (6.0, 3.0), (-1.0, 1.0)], "a double, b double")
    out = df.select(X.safe_div("a", "b").alias("q"), X.clip("a", 0.0, 5.0).alias("c")).collect()
    assert [r.q for r in out] == [None, None, 2.0, -1.0]
    assert [r.c for r in out] == [1.0, None, 5.0, 0.0]


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 8.0), (2.0, 8.0), (3.0, 8.0)], "x double, y double")
    r = df.agg(X.safe_corr("x", "y").alias("c"), X.safe_corr("x", "x").alias("s")).first()
    assert r.c is None and abs(r.s - 1.0) < 1e-12


def test_season_null_month_is_dry(spark):
    df = spark.createDataFrame([(1,), (3,), (4,), (9,), (10,), (None,)], "m int")
    out = [r.s for r in df.select(X.season(F.col("m")).alias("s")).collect()]
    assert out == ["Hujan", "Hujan", "Kemarau", "Kemarau", "Hujan", "Kemarau"]


def test_r6_identical_rounding(spark):
    df = spark.createDataFrame([(270.60303749999997,), (-1e-9,), (1.0000005,)], "x double")
    out = [r.r for r in df.select(X.r6("x").alias("r")).collect()]
    assert out[1] == 0.0 and out[2] == 1.000001
    assert out[0] == (int(270.60303749999997 * 1e6 + 0.5)) / 1e6


def test_total_keeps_small_values(spark):
    df = spark.createDataFrame([(4e-7,), (4e-7,), (4e-7,), (None,)], "x double")
    assert abs(df.agg(X.total("x")).first()[0] - 1.2e-6) < 1e-18
    wide = spark.createDataFrame([(1e33,), (float("inf"),)], "x double")
    assert wide.agg(X.total("x")).first()[0] == float("inf")
