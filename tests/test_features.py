"""Joins, per-cycle aggregates and KPIs on hand-written rows."""
import datetime as dt

from pondlens.config import PipelineConfig
from pondlens.operators import features as FE


def test_last_sampling_last_non_null_and_ties(spark):
    rows = [(1, 2.0, dt.datetime(2024, 1, 5), 1), (1, None, dt.datetime(2024, 1, 9), 2),   # last row NULL
            (2, 3.0, dt.datetime(2024, 1, 5), 1), (2, 4.0, dt.datetime(2024, 1, 5), 2),    # tie on time
            (None, 9.0, dt.datetime(2024, 1, 5), 1)]
    df = spark.createDataFrame(rows, "cycle_id bigint, average_weight double, sampled_at timestamp, l_linenumber int")
    out = {r.cycle_id: r for r in FE.last_sampling(df, ["sampled_at", "l_linenumber"]).collect()}
    assert set(out) == {1, 2}
    assert out[1].average_weight == 2.0 and out[1].last_sampled_at == dt.datetime(2024, 1, 9)
    assert out[2].average_weight == 4.0


def test_water_std_single_row_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0)], "cycle_id bigint, morning_do double")
    out = {r.cycle_id: r for r in FE.water_quality_agg(df, ["morning_do"]).collect()}
    assert out[1].morning_do_std is None and out[2].morning_do_mean == 2.0


def _catalog(spark):
    cycles = spark.createDataFrame(
        [(1, 10, 1000.0, 100.0, dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 10)),
         (2, 99, 0.0, 100.0, dt.datetime(2024, 11, 1), None),            # orphan pond, zero seed, open
         (3, None, 500.0, 0.0, dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 1))],
        "id bigint, pond_id bigint, total_seed double, area double, started_at timestamp, finished_at timestamp")
    ponds = spark.createDataFrame([(10, 1, 10.0, 5.0, 2.0)],
                                  "id bigint, farm_id bigint, length double, width double, deep double")
    farms = spark.createDataFrame([(1, "A")], "id bigint, name string")
    harvests = spark.createDataFrame([(1, 50.0, 4.0, dt.datetime(2024, 4, 1)), (1, 50.0, 6.0, dt.datetime(2024, 4, 9))],
                                     "cycle_id bigint, size double, weight double, harvested_at timestamp")
    sampling = spark.createDataFrame([(1, 12.0, dt.datetime(2024, 1, 31, 1))],
                                     "cycle_id bigint, average_weight double, sampled_at timestamp")
    feeds = spark.createDataFrame([(1, 10.0), (1, 5.0), (None, 7.0)], "cycle_id bigint, quantity double")
    return {"cycles": cycles, "ponds": ponds, "farms": farms, "harvests": harvests, "sampling": sampling,
            "feeds": feeds, "measurements": None}


def test_main_table_kpis(spark):
    main = FE.build_main(_catalog(spark), PipelineConfig(as_of="2025-01-01 00:00:00"))
    rows = {r.id: r for r in main.collect()}
    assert len(rows) == 3                                      # one row per cycle
    r = rows[1]
    assert r.culture_duration == 100 and r.stocking_density == 10.0
    assert r.weight == 10.0 and r.size == 50.0 and r.abw_harvest == 20.0
    assert r.harvested_count == 500.0 and r.survival_rate == 50.0
    assert r.days_from_start == 30 and r.adg == 12.0 / 30
    assert r.total_feed == 15.0 and r.fcr == 1.5
    assert r.pond_volume == 100.0 and r.surface_to_volume_ratio == 0.5 and r.id_farm == 1
    assert rows[2].culture_duration == 61 and rows[2].id_pond is None    # open cycle, orphan pond
    assert rows[2].season == "Hujan" and rows[1].season == "Hujan" and rows[3].season == "Kemarau"
    assert rows[3].stocking_density is None                    # x / 0 -> NULL
    assert rows[2].survival_rate is None and rows[2].fcr is None


def test_daily_feed_and_first_cycles(spark):
    cycles = spark.createDataFrame([(i, dt.datetime(2024, 1, 1)) for i in range(1, 8)],
                                   "id bigint, started_at timestamp")
    feeds = spark.createDataFrame([(i, 1.0, dt.datetime(2024, 1, 1 + i % 3)) for i in range(1, 8)] +
                                  [(1, 2.0, dt.datetime(2024, 1, 2, 12)), (None, 1.0, dt.datetime(2024, 1, 1))],
                                  "cycle_id bigint, quantity double, logged_at timestamp")
    d = FE.daily_feed(feeds, cycles)
    got = {(r.cycle_id, r.culture_days): r.quantity for r in d.collect()}
    assert got[(1, 1)] == 3.0
    assert sorted({r.cycle_id for r in FE.first_cycles(d, 5).collect()}) == [1, 2, 3, 4, 5]
