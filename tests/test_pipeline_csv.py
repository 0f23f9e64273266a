"""Stage 1 end to end from CSV files (some tables missing), plus S3 reload."""
import os

from pyspark.sql import functions as F

from pondlens.plans import preprocess
from pondlens.sources.catalog import load_csv, parse_dates_fallback
from pondlens.config import CSV_SCHEMAS

FILES = {
    "farms.csv": "id,name\n1,A\n2,B\n",
    "ponds.csv": "id,farm_id,length,width,deep\n10,1,20,10,1.5\n11,2,,12,0\n12,9,-15,8,1\n",
    "cycles.csv": ("id,pond_id,total_seed,area,started_at,finished_at\n"
                   "100,10,10000,200,2024-01-01,2024-04-10\n101,11,,300,2024-10-05 06:00:00,\n"
                   "102,12,-5000,250,not-a-date,2024-06-01\n103,10,0,,2024-03-01,2024-06-01\n"),
    "feeds.csv": "cycle_id,quantity,logged_at\n100,50,2024-01-10\n100,,2024-01-11\n101,20,\n999,5,2024-01-01\n",
    "harvests.csv": "cycle_id,size,weight,harvested_at\n100,50,150,2024-04-10\n101,40,80,2024-12-01\n",
    "samplings.csv": "cycle_id,average_weight,sampled_at\n100,5,2024-02-01\n100,12,2024-03-01\n101,8,2024-11-20\n",
    "measurements.csv": ("cycle_id,measured_at,morning_temperature,evening_temperature,morning_do,evening_do,"
                         "morning_salinity,evening_salinity,morning_pH,evening_pH\n"
                         "100,2024-01-05,28,30,5,4.5,15,15.5,7.8,8\n100,2024-01-06,27,29,,4.4,16,15,7.9,8\n"
                         "101,2024-10-10,29,31,5.2,4.6,14,14.5,7.7,8\n"),
}


def test_preprocess_from_csv(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    for name, text in FILES.items():
        (data / name).write_text(text)
    out = preprocess.run(spark, str(data), str(tmp_path / "out"), fmt="csv", as_of="2025-01-01 00:00:00")
    main = spark.read.parquet(out["main_dataset"])
    assert main.count() == 4                                    # one row per cycle
    r = {x.id: x for x in main.collect()}
    assert r[100].total_feed == 70.0 and r[100].fcr == 70.0 / 150.0   # NULL feed takes the median of (50, 20, 5)
    assert r[101].finished_at is not None and str(r[101].finished_at).startswith("2025-01-01")
    issues = spark.read.parquet(out["dq_issues"])
    rel = {x.relation: x["count"] for x in issues.where(F.col("relation").isNotNull()).collect()}
    assert rel == {"ponds-farms": 1, "feeds-cycles": 1}
    assert spark.read.parquet(out["null_totals"]).where("column IS NULL AND missing > 0").count() == 0


def test_missing_csv_is_none(spark, tmp_path):
    assert load_csv(spark, str(tmp_path / "nope.csv"), CSV_SCHEMAS["farms"]) is None


def test_parse_dates_fallback(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02",), ("2024-01-02 10:00:00",), ("x",)], "d string")
    got = [r.d for r in parse_dates_fallback(df, ["d"]).collect()]
    assert [str(g) if g else None for g in got] == ["2024-01-02 03:04:05", "2024-01-02 00:00:00",
                                                    "2024-01-02 10:00:00", None]
