"""NaN, paths and typed reload, whatever the source."""
import math

from pyspark.sql import functions as F

from pondlens.config import PipelineConfig
from pondlens.operators import clean as C
from pondlens.operators import models as M
from pondlens.sources import catalog as S
from tests.test_models_scoring import _main


def test_parquet_nan_is_missing(spark, tmp_path):
    rows = [(1, math.nan, "2024-01-01"), (1, 2.0, "2024-01-02"), (2, 4.0, "2024-01-03")]
    spark.createDataFrame(rows, "cycle_id long, quantity double, logged_at string").write.parquet(f"{tmp_path}/feeds.parquet")
    catalog = S.load_parquet_catalog(spark, f"file://{tmp_path}")
    assert catalog["harvests"] is None and catalog["feeds"].where(F.col("quantity").isNull()).count() == 1
    filled, _ = C.impute_numeric(catalog["feeds"], PipelineConfig().impute_columns["feeds"])
    totals = {r.cycle_id: r.q for r in filled.groupBy("cycle_id").agg(F.sum("quantity").alias("q")).collect()}
    assert totals == {1: 5.0, 2: 4.0}      # the median of 2 and 4 stands in for NaN


def test_export_and_load_by_uri(spark, tmp_path):
    main = _main(spark, n=120)
    small = {"rf": {"numTrees": 2, "maxDepth": 3, "seed": 1}}
    result = M.train_target(main, "sr", ("rf",), 0, 0, small)[0]
    out = f"file://{tmp_path}/models"
    M.save_models({"sr": result}, out)
    assert set(M.load_models(out)) == {"sr"}
    meta = M.load_metadata(spark, out)
    assert meta["targets"] == ["sr"] and meta["feature_names"]["sr"] == result.features


def test_failed_algorithm_is_reported_and_not_chosen(spark):
    main = _main(spark, n=120)
    got = M.train_target(main, "sr", ("rf", "xgb"), 0, 0, {"rf": {"numTrees": 2, "maxDepth": 3}, "xgb": {"maxIter": -1}})
    assert [r.error is None for r in got] == [True, False]
    assert M.best_result(got).algorithm == "rf"
    assert M.summary_frame(spark, got).where("error IS NOT NULL").count() == 1


def test_csv_reload_is_typed(spark, tmp_path):
    df = spark.sql("SELECT 7L AS id, 1.5D AS weight, 'Hujan' AS season, TIMESTAMP'2024-01-02 03:04:05' AS started_at, "
                   "TIMESTAMP'2024-02-02 00:00:00' AS last_sampled_at, CAST('NaN' AS DOUBLE) AS fcr")
    df.write.option("header", True).csv(f"{tmp_path}/main")
    got = S.load_processed(spark, str(tmp_path / "main"), fmt="csv")
    assert dict(got.dtypes) == {"id": "bigint", "weight": "double", "season": "string", "started_at": "timestamp",
                                "last_sampled_at": "timestamp", "fcr": "double"}
    row = got.first()
    assert (row.id, row.weight, row.fcr, row.started_at.hour) == (7, 1.5, None, 3)
    assert S.load_processed(spark, str(tmp_path / "none")) is None


def test_folds_do_not_depend_on_partitions(spark):
    ids = spark.range(500).withColumn("f", M.fold_of("id", 5))
    assert sorted(map(tuple, ids.collect())) == sorted(map(tuple, spark.range(500).repartition(7).withColumn("f", M.fold_of("id", 5)).collect()))
    assert ids.select("f").distinct().count() == 5


def test_dates_take_one_layout_for_the_whole_column(spark):
    rows = [("03/04/2024", "13/04/2024", "2024-04-03", "2024-04-03T01:02:03.000004Z", None),
            ("12/31/2024", "03/04/2024", "2024-04-04", "2024-04-03 01:02:03", None),
            ("2024-05-06", "junk", None, "2024-04-03", None)]
    df = spark.createDataFrame(rows, "month_first string, day_first string, day string, iso string, none string")
    got = S.parse_dates_by_column(df, df.columns).collect()
    text = [[None if v is None else v.strftime("%Y-%m-%d") for v in r] for r in got]
    assert [r[0] for r in text] == ["2024-03-04", "2024-12-31", "2024-05-06"]      # the last falls through
    assert [r[1] for r in text] == ["2024-04-13", "2024-04-03", None]              # day first, as the first row shows
    assert [r[2] for r in text] == ["2024-04-03", "2024-04-04", None] and [r[4] for r in text] == [None] * 3
    assert got[0].iso.microsecond == 4 and got[1].iso.hour == 1 and text[2][3] == "2024-04-03"
    assert S.parse_dates_by_column(df.limit(0), df.columns).count() == 0


def test_processed_tables_as_text_keep_values(spark, tmp_path):
    from pondlens.sources.sinks import save_processed
    df = spark.sql("SELECT 7L AS id, 0.1D + 0.2D AS weight, CAST(NULL AS DOUBLE) AS fcr, 'a, \"b\"' AS name, "
                   "TIMESTAMP'2024-01-02 03:04:05.678901' AS started_at")
    saved = save_processed(df, {"cycles": df, "feeds": None}, str(tmp_path / "out"), "csv")
    assert set(saved) == {"main_dataset", "cycles"}
    for path in saved.values():
        assert S.load_processed(spark, path, fmt="csv").collect() == df.collect()


def test_layouts_are_tried_on_texts_of_their_shape_only(spark):
    """Same results as trying every layout on every text; none of the other layouts' shapes takes an ISO text."""
    import re

    from pyspark.sql import functions as F

    from pondlens.sources import catalog as K
    texts = ["2024-03-04T05:06:07.123456Z", "2024-03-04t05:06:07+07:00", "2024-03-04T05:06:07.123", "2024-03-04 05:06:07", "2024-03-04 05:06:07.5",
             "2024-03-04", "03/04/2024", "13/04/2024", "03/13/2024 05:06:07", "04-03-2024", "31-12-2024 23:59:59", "2024/03/04", "2024/03/04 01:02:03",
             "+12024-03-04", "12024/03/04", "3/4/2024", "2024-3-4", " 2024-03-04", "2024-03-04 ", "bad-date", "", "2024-02-30", "99/99/2024", None,
             "03/04/12024", "2024-03-04\n", "24-03-04", "2024-03-04T05:06", "03-04-24"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    pats = sorted({p for layout in K.COLUMN_LAYOUTS for p in layout})
    plain = [F.try_to_timestamp(F.col("c"), F.lit(p)).cast("string") for p in pats]
    guarded = [K._try_layout("c", p).cast("string") for p in pats]
    for row in df.select("c", F.array(*plain).alias("a"), F.array(*guarded).alias("b")).collect():
        assert row["a"] == row["b"], row["c"]
    iso = "2024-03-04T05:06:07.123456Z"
    assert [p for p in pats if re.match(K.layout_shape(p), iso)] == [p for p in pats if "'T'" in p]
    assert K.layout_shape("EEE yyyy") is None


def test_processed_text_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """gzip keeps every value and row; a file is read by one task, so its rows are bounded."""
    import glob
    import os

    from pondlens.sources import sinks
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 100)
    df = spark.range(1000).selectExpr("id", "id / 7.0D AS weight", "IF(id % 3 = 0, NULL, 'a, \"b\"') AS name",
                                      "timestamp_micros(id * 1000003) AS started_at").coalesce(1)
    plain = sinks.save_processed(df, {"cycles": df, "feeds": None}, str(tmp_path / "plain"), "csv")
    small = sinks.save_processed(df, {"cycles": df, "feeds": None}, str(tmp_path / "small"), "csv", "gzip")
    assert set(plain) == set(small) == {"main_dataset", "cycles"}
    room = lambda saved: {k: sum(os.path.getsize(f) for f in glob.glob(f"{p}/part-*")) for k, p in saved.items()}
    for k, path in small.items():
        assert len(glob.glob(f"{path}/part-*.csv.gz")) == 10 and len(glob.glob(f"{plain[k]}/part-*.csv")) == 1
        assert room(small)[k] < room(plain)[k] / 2
        assert sorted(S.load_processed(spark, path, fmt="csv").collect()) == sorted(df.collect())


def test_reload_writes_compressed_text_and_frees_shuffles(spark, tmp_path, monkeypatch):
    """every table is written, none as plain text, and no shuffle file of the run is left behind."""
    import glob
    import time

    from pondlens.plans import stages
    main = spark.createDataFrame([(1, 2.5, "a")], "id long, weight double, name string")
    many = spark.range(5000).repartition(3, "id").groupBy("id").count()
    monkeypatch.setattr(stages, "checkpoint_dir", lambda _: str(tmp_path))
    st = stages.Stages(spark, {})
    st.main, st.cleaned = main, {"cycles": many, "feeds": None}
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x for x in manager.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in x}
    before, key = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert st.reloaded.collect() == main.collect() and spark.conf.get(key) == "false"
    files = glob.glob(f"{tmp_path}/pondlens/*/processed/*/part-*")
    assert {f.split("/")[-2] for f in files} == {"main_dataset", "cycles_processed"} and all(f.endswith(".csv.gz") for f in files)
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
