"""Joins, per-cycle aggregates and KPIs.

Plan shape of the main table: every fact table is aggregated to one row per
cycle *before* it is joined (``per_key``: one shuffle of the columns read, hot
cycles combined on the map side), so no join multiplies rows and a hot cycle
collapses to one partial row per map task. All fact aggregates join the cycles on the same
key, so Spark keeps the ``id`` hash partitioning across the chain of
left joins; the pond/farm dimension is joined last and is broadcast by AQE
only when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.config import PipelineConfig
from pondlens.functions import exprs as X


#: The tables that ``build_main`` reads.
MAIN_TABLES = ["cycles", "harvests", "sampling", "feeds", "measurements", "ponds", "farms"]

# ---------------------------------------------------------------- hot keys --

#: A key with more than this share of the rows is combined in the map tasks first.
HOT_SHARE = 1 / 200
#: Keys that the sketch of frequent keys holds; its error is under a tenth of the share.
TRACKED_KEYS = 10_000


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys that hold a large share of the rows (at most 1 / HOT_SHARE of them), by a mergeable sketch of one aggregate."""
    most = int(1 / HOT_SHARE)
    keys = df.select(F.col(key).alias("k")).where("k IS NOT NULL")
    got = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {TRACKED_KEYS})").alias("top")).first()
    return [t["item"] for t in got["top"] or [] if t["count"] > HOT_SHARE * got["n"]]


def per_key(df: DataFrame, key: str, *aggs: F.Column) -> DataFrame:
    """``df.groupBy(key).agg(*aggs)`` over the rows with a key, one row for each.

    Rows of a cycle are scattered over the files, so combining them in the map
    tasks makes no fewer rows but wider ones (a dozen buffers for each value)
    and fills the map tasks' memory. Rows are dealt by key first and combined
    where they arrive; only the rows of hot keys are combined in the map tasks,
    so no task gets a hot key's rows. Which way a key goes changes no result.
    """
    rows = df.where(F.col(key).isNotNull())
    hot = hot_keys(df, key)
    if not hot:
        return rows.repartition(F.col(key)).groupBy(key).agg(*aggs)
    cold = rows.where(~F.col(key).isin(hot)).repartition(F.col(key)).groupBy(key).agg(*aggs)
    return cold.unionByName(rows.where(F.col(key).isin(hot)).groupBy(key).agg(*aggs))


# ---------------------------------------------------------------- ponds -----

def pond_geometry(ponds: DataFrame) -> DataFrame:
    """Pond volume and surface-to-volume ratio, computed on the pond table."""
    vol = F.col("length") * F.col("width") * F.col("deep")
    return ponds.withColumn("pond_volume", vol.cast("double")) \
        .withColumn("surface_to_volume_ratio", X.safe_div(F.col("length") * F.col("width"), F.col("pond_volume")))


def join_pond_farm(ponds: DataFrame, farms: DataFrame | None) -> DataFrame:
    """Ponds LEFT farms; the pond id becomes ``id_pond``, farm columns that
    clash with pond columns get ``_farm``."""
    p = ponds.withColumnRenamed("id", "id_pond")
    if farms is None:
        return p
    renamed = [F.col(c).alias("id_farm" if c == "id" else (f"{c}_farm" if c in p.columns else c))
               for c in farms.columns]
    f = farms.select(*renamed)
    return p.join(f, p["farm_id"] == f["id_farm"], "left")


def join_snowflake(cycles: DataFrame, ponds_farms: DataFrame) -> DataFrame:
    """Cycles LEFT (ponds + farms) on ``pond_id``."""
    return cycles.join(ponds_farms, cycles["pond_id"] == ponds_farms["id_pond"], "left")


# ---------------------------------------------------------------- facts -----

def harvest_agg(harvests: DataFrame) -> DataFrame:
    """A1: per cycle total weight, mean size, last harvest time."""
    return per_key(harvests.select("cycle_id", "weight", "size", "harvested_at"), "cycle_id",
                   F.coalesce(X.total("weight"), F.lit(0.0)).alias("weight"),
                   F.avg("size").alias("size"),
                   F.max("harvested_at").alias("harvested_at"))


def feed_agg(feeds: DataFrame) -> DataFrame:
    """A2 + F10: per cycle ``sum(quantity)`` named ``total_feed``."""
    return per_key(feeds.select("cycle_id", "quantity"), "cycle_id", F.coalesce(X.total("quantity"), F.lit(0.0)).alias("total_feed"))


def water_quality_agg(measurements: DataFrame, params: list[str]) -> DataFrame:
    """A4: mean/min/max/std (sample) of each water parameter per cycle."""
    params = [p for p in params if p in measurements.columns]
    aggs = []
    for p in params:
        aggs += [F.avg(p).alias(f"{p}_mean"), F.min(p).cast("double").alias(f"{p}_min"),
                 F.max(p).cast("double").alias(f"{p}_max"), F.stddev_samp(p).alias(f"{p}_std")]
    return per_key(measurements.select("cycle_id", *params), "cycle_id", *aggs)


def last_sampling(sampling: DataFrame, order: list[str]) -> DataFrame:
    """A5: last non-NULL ``average_weight`` per cycle in ``order`` (ties broken
    by the extra order columns) and the last sampling time.

    ``max_by`` with a NULL ordering for NULL values is the pandas
    ``groupby.last()`` rule (last non-NULL per column), done as one
    aggregate.
    """
    order = [c for c in order if c in sampling.columns]
    ordering = F.struct(*[F.col(c) for c in order])
    rows = sampling.select(*dict.fromkeys(["cycle_id", "average_weight", "sampled_at", *order]))
    return per_key(rows, "cycle_id",
                   F.max_by("average_weight", F.when(F.col("average_weight").isNotNull(), ordering)).alias("average_weight"),
                   F.max("sampled_at").alias("last_sampled_at"))


def fact_with_cycle(fact: DataFrame, cycles: DataFrame, time_col: str, out_col: str = "culture_days") -> DataFrame:
    """Fact LEFT cycles, with floor-days from the cycle start."""
    c = cycles.select(F.col("id").alias("__cid"), F.col("started_at").alias("__start"))
    j = fact.join(c, fact["cycle_id"] == c["__cid"], "left")
    return j.withColumn(out_col, X.floor_days(F.col(time_col), F.col("__start"))).drop("__cid", "__start")


def daily_feed(feeds: DataFrame, cycles: DataFrame) -> DataFrame:
    """A3: feed per (cycle, culture day); rows with a NULL key are dropped."""
    f = fact_with_cycle(feeds, cycles, "logged_at")
    return (f.where(F.col("cycle_id").isNotNull() & F.col("culture_days").isNotNull())
            .groupBy("cycle_id", "culture_days")
            .agg(F.coalesce(X.total("quantity"), F.lit(0.0)).alias("quantity")))


def first_cycles(df: DataFrame, k: int = 5, key: str = "cycle_id") -> DataFrame:
    """Rows of the ``k`` smallest cycle ids (top-k, then semi join)."""
    ids = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(k)
    return df.join(ids, key, "left_semi")


# ---------------------------------------------------------------- KPIs ------

def add_cycle_kpis(main: DataFrame, as_of: str) -> DataFrame:
    """K1-K4: duration (open cycles end at ``as_of``), density, month, quarter, season."""
    end = F.coalesce(F.col("finished_at"), X.ts_literal(as_of))
    return (main
            .withColumn("culture_duration", X.floor_days(end, F.col("started_at")))
            .withColumn("stocking_density", X.safe_div("total_seed", "area"))
            .withColumn("start_month", F.month("started_at"))
            .withColumn("start_quarter", F.quarter("started_at"))
            .withColumn("season", X.season(F.col("start_month"))))


def add_survival(main: DataFrame) -> DataFrame:
    """K5-K7: ABW at harvest = 1000/size, head count, survival rate %."""
    return (main
            .withColumn("abw_harvest", X.safe_div(F.lit(1000.0), F.col("size")))
            .withColumn("harvested_count", X.safe_div(F.col("weight") * 1000.0, F.col("abw_harvest")))
            .withColumn("survival_rate", X.safe_div("harvested_count", "total_seed") * 100.0))


def add_growth(main: DataFrame) -> DataFrame:
    """K8/K9: days from start to the last sampling, ADG = weight / days."""
    return (main
            .withColumn("days_from_start", X.floor_days(F.col("last_sampled_at"), F.col("started_at")))
            .withColumn("adg", X.safe_div("average_weight", "days_from_start")))


def add_fcr(main: DataFrame) -> DataFrame:
    """FCR = total feed / harvested weight."""
    return main.withColumn("fcr", X.safe_div("total_feed", "weight"))


def add_temp_fluctuation(main: DataFrame) -> DataFrame:
    """|morning mean temperature - evening mean temperature|."""
    if "morning_temperature_mean" not in main.columns or "evening_temperature_mean" not in main.columns:
        return main
    return main.withColumn("temp_daily_fluctuation",
                           F.abs(F.col("morning_temperature_mean") - F.col("evening_temperature_mean")))


def left_by_cycle(main: DataFrame, agg: DataFrame) -> DataFrame:
    """Cycles LEFT a per-cycle aggregate."""
    j = main.join(agg, main["id"] == agg["cycle_id"], "left")
    return j.drop(agg["cycle_id"])


def build_main(cat: dict, cfg: PipelineConfig | None = None) -> DataFrame:
    """One row per cycle with every KPI (cleaned catalog in)."""
    cfg = cfg or PipelineConfig()
    cycles = cat["cycles"]
    main = add_cycle_kpis(cycles, cfg.as_of)
    if cat.get("harvests") is not None:
        main = add_survival(left_by_cycle(main, harvest_agg(cat["harvests"])))
    if cat.get("sampling") is not None:
        main = add_growth(left_by_cycle(main, last_sampling(cat["sampling"], cfg.sampling_order)))
    if cat.get("feeds") is not None:
        main = left_by_cycle(main, feed_agg(cat["feeds"]))
        if "weight" in main.columns:
            main = add_fcr(main)
    if cat.get("measurements") is not None:
        main = add_temp_fluctuation(left_by_cycle(main, water_quality_agg(cat["measurements"], cfg.water_params)))
    if cat.get("ponds") is not None:
        ponds = pond_geometry(cat["ponds"])
        main = join_snowflake(main, join_pond_farm(ponds, cat.get("farms")))
    return main
