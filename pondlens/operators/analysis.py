"""KPI filters and analysis tables.

Everything here is one or two aggregates over the main table: several
correlations, moments or histograms are computed in a single pass and then
unpivoted, instead of one job per statistic.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.config import (CELLS_PER_BANDWIDTH, DENSITY_POINTS, FCR_VALID, HIST_BINS, ID_COLUMNS, IQR_FACTOR,
                             KERNEL_REACH, MIN_FACTOR_ROWS, SR_RANGE, SR_VALID, TOP_FACTORS)
from pondlens.functions.exprs import safe_corr
from pondlens.operators.profile import numeric_columns
from pondlens.operators.quantiles import quantile_table, quantile_values

# ---------------------------------------------------------------- filters ---


def sr_is_valid() -> F.Column:
    """5 < SR <= 100."""
    return (F.col("survival_rate") <= SR_VALID[1]) & (F.col("survival_rate") > SR_VALID[0])


def adg_is_valid() -> F.Column:
    """ADG > 0."""
    return F.col("adg") > 0


def fcr_is_valid() -> F.Column:
    """0.5 < FCR < 3."""
    return (F.col("fcr") > FCR_VALID[0]) & (F.col("fcr") < FCR_VALID[1])


def sr_in_range() -> F.Column:
    """1 <= SR <= 100."""
    return F.col("survival_rate").between(SR_RANGE[0], SR_RANGE[1])


def all_valid() -> F.Column:
    """F3 and F4 and F2."""
    return fcr_is_valid() & sr_in_range() & adg_is_valid()


def sr_density_valid() -> F.Column:
    """SR in [1, 100] and positive stocking density."""
    return sr_in_range() & (F.col("stocking_density") > 0)


# ---------------------------------------------------------------- A8 --------

def kpi_summary(main: DataFrame) -> DataFrame:
    """n/min/max/mean per KPI; SR, ADG and FCR only over their valid rows."""
    specs = [("culture_duration", None), ("stocking_density", None), ("survival_rate", sr_is_valid()),
             ("adg", adg_is_valid()), ("fcr", fcr_is_valid()),
             ("temp_daily_fluctuation", None), ("pond_volume", None)]
    specs = [(c, cond) for c, cond in specs if c in main.columns]
    aggs = []
    for c, cond in specs:
        v = F.col(c).cast("double") if cond is None else F.when(cond, F.col(c).cast("double"))
        aggs.append(F.struct(F.lit(c).alias("metric"), F.count(v).cast("bigint").alias("n"),
                             F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean")).alias(c))
    wide = main.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.col(c) for c, _ in specs])).alias("s")).select("s.*")


# ---------------------------------------------------------------- A10/A11 ---

def corr_matrix(df: DataFrame, cols: list[str], scope: str) -> DataFrame:
    """A10: pairwise-complete Pearson matrix, lower triangle (row var after col var)."""
    cols = [c for c in cols if c in df.columns]
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    return corr_pairs(df, pairs, scope)


def _pair_rows(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Long form ``(k, x, y)``: one generated row per input row and pair, so
    every pair is aggregated by the same narrow, code-generated aggregate
    (``groupBy(k)``) instead of one very wide single-row aggregate."""
    structs = [F.struct(F.lit(k).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
               for k, (x, y) in enumerate(pairs)]
    return df.select(F.inline(F.array(*structs)))


def corr_pairs(df: DataFrame, pairs: list[tuple[str, str]], scope: str) -> DataFrame:
    """Guarded correlation of each (x, y) pair, all in one aggregate."""
    names = df.sparkSession.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pairs)],
                                            "k int, var_x string, var_y string")
    agg = _pair_rows(df, pairs).groupBy("k").agg(
        F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).cast("bigint").alias("n"),
        safe_corr("x", "y").alias("corr"))
    return (F.broadcast(names).join(agg, "k", "left")
            .select(F.lit(scope).alias("scope"), "var_x", "var_y",
                    F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"), "corr"))


def water_mean_columns(main: DataFrame) -> list[str]:
    """Columns holding a per-cycle mean of temperature, DO, salinity or pH."""
    markers = ["temperature", "do", "salinity", "pH"]
    return [c for c in main.columns if any(m in c for m in markers) and "mean" in c]


# ---------------------------------------------------------------- A12 -------

def factor_columns(main: DataFrame, target: str = "survival_rate") -> list[str]:
    return [c for c in numeric_columns(main) if c not in ID_COLUMNS and c != target]


def top_factors(main: DataFrame, target: str = "survival_rate", k: int = TOP_FACTORS) -> DataFrame:
    """The ``k`` columns most correlated (absolute value) with ``target``.

    Over rows with SR in [1, 100]; a column needs more than 10 values; NULL
    correlations are dropped. Ties are ordered by name. The candidate columns
    are unpivoted next to the target and aggregated per factor.
    """
    cols = factor_columns(main, target)
    v = main.where(sr_in_range()).select(F.col(target).cast("double").alias("__y"),
                                         *[F.col(c).cast("double").alias(c) for c in cols])
    long = v.unpivot(["__y"], cols, "factor", "x")
    agg = long.groupBy("factor").agg(F.count("x").alias("n"), safe_corr("x", "__y").alias("corr"))
    return (agg.where((F.col("n") > MIN_FACTOR_ROWS) & F.col("corr").isNotNull())
            .orderBy(F.abs("corr").desc(), F.col("factor")).limit(k)
            .select("factor", "corr"))


# ---------------------------------------------------------------- A13 -------

def _metric_values(df: DataFrame, metrics: dict) -> DataFrame:
    """The metrics as double columns ``m0``, ``m1``, ...; NaN becomes NULL."""
    return df.select(*[F.nanvl(v.cast("double"), F.lit(None).cast("double")).alias(f"m{i}")
                       for i, v in enumerate(metrics.values())])


def _metric_stats(values: DataFrame, k: int) -> list[dict]:
    """n, lo, hi, std of each of ``k`` metric columns, in one aggregate."""
    row = values.agg(*[f(f"m{i}").alias(f"{n}{i}") for i in range(k)
                       for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max), ("std", F.stddev_samp))]).first()
    return [{n: row[f"{n}{i}"] for n in ("n", "lo", "hi", "std")} for i in range(k)]


def auto_bin_count(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """Number of equal-width bins for n values: the narrower of Sturges' and
    Freedman-Diaconis' widths, the latter not under half the square-root
    rule's; Sturges' alone if the quartiles are equal."""
    if hi == lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    freedman = 2.0 * (q3 - q1) / math.pow(n, 1.0 / 3.0)
    width = min(max(freedman, (hi - lo) / math.sqrt(n) / 2.0), sturges) if freedman > 0 else sturges
    return max(1, math.ceil((hi - lo) / width))


def auto_bins(df: DataFrame, metrics: dict) -> dict[str, int]:
    """The automatic bin count of every metric that has values (exact quartiles)."""
    values = _metric_values(df, metrics)
    stats = _metric_stats(values, len(metrics))
    q = quantile_values(values, values.columns, [0.25, 0.75])
    return {name: auto_bin_count(s["n"], s["lo"], s["hi"], q[(f"m{i}", 0.25)], q[(f"m{i}", 0.75)])
            for i, (name, s) in enumerate(zip(metrics, stats)) if s["n"]}


def histograms(df: DataFrame, metrics: dict, bins: int | dict[str, int] = HIST_BINS) -> DataFrame | None:
    """Equal-width histograms of several values of one table (the top edge
    falls into the last bin).

    ``metrics``: name -> value expression; a NULL or NaN value is left out.
    ``bins``: their number, the same for all or one for each metric. One
    aggregate gives every range, one pass counts all bins; every bin appears,
    empty ones with count 0, and a metric without values has none.
    """
    values = _metric_values(df, metrics)
    ranges, slots = [], []
    for i, (name, s) in enumerate(zip(metrics, _metric_stats(values, len(metrics)))):
        lo, hi = s["lo"], s["hi"]
        if lo is None:
            continue
        k = bins[name] if isinstance(bins, dict) else bins
        lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
        ranges.append((name, lo, hi, k))
        slot = F.least(F.floor((F.col(f"m{i}") - F.lit(lo)) * F.lit(float(k)) / F.lit(hi - lo)), F.lit(k - 1)).cast("int")
        slots.append(F.struct(F.lit(name).alias("metric"), F.when(F.col(f"m{i}").isNotNull(), slot).alias("bin")))
    edge = F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.col("k").cast("double")
    next_edge = F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.col("k").cast("double")
    frame = (df.sparkSession.createDataFrame(ranges, "metric string, lo double, hi double, k int")
             .select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"))
             .select("metric", "bin", edge.alias("bin_lo"), next_edge.alias("bin_hi")))
    if not slots:
        return frame.withColumn("count", F.lit(0).cast("bigint"))
    counts = (values.select(F.explode(F.array(*slots)).alias("s")).select("s.*").where("bin IS NOT NULL")
              .groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("count")))
    return (frame.join(counts, ["metric", "bin"], "left")
            .select("metric", "bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")))


def densities(df: DataFrame, metrics: dict, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian density curves of several values of one table, at ``points``
    equally spaced values from the smallest to the largest.

    The bandwidth is the standard deviation times n^(-1/5). Values are binned
    linearly (each splits its weight between the two ends of its cell) on a
    grid whose step is at most an eighth of the bandwidth, in one pass with
    map-side sums; only occupied cells exist as rows. Each cell then adds its
    kernel to the points within ``KERNEL_REACH`` bandwidths, beyond which it
    is under 1e-14 of its peak. NULL and NaN are left out; a metric with fewer
    than two different values has no curve.
    """
    values = _metric_values(df, metrics)
    curves, slots = [], []
    for i, (name, s) in enumerate(zip(metrics, _metric_stats(values, len(metrics)))):
        if s["n"] < 2 or s["lo"] == s["hi"]:
            continue
        width = s["std"] * math.pow(s["n"], -0.2)
        gap = (s["hi"] - s["lo"]) / (points - 1)
        step = gap / math.ceil(CELLS_PER_BANDWIDTH * gap / width)
        curves.append((name, s["n"], s["lo"], gap, step, width))
        at = (F.col(f"m{i}") - F.lit(s["lo"])) / F.lit(step)
        slots.append(F.struct(F.lit(name).alias("metric"), F.floor(at).alias("cell"), (at - F.floor(at)).alias("part")))
    schema = "metric string, n bigint, lo double, gap double, step double, width double"
    curve = df.sparkSession.createDataFrame(curves, schema)
    frame = curve.select("metric", "n", "width", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                         (F.col("lo") + F.col("point") * F.col("gap")).alias("x"))
    if not slots:
        return frame.select("metric", "point", "x", F.lit(0.0).alias("density"))
    cells = (values.select(F.explode(F.array(*slots)).alias("s")).select("s.*").where("cell IS NOT NULL")
             .groupBy("metric", "cell").agg(F.count(F.lit(1)).alias("c"), F.sum("part").alias("p")))
    ends = cells.select("metric", F.explode(F.array(
        F.struct(F.col("cell"), (F.col("c") - F.col("p")).alias("w")),
        F.struct((F.col("cell") + 1).alias("cell"), F.col("p").alias("w")))).alias("e")).select("metric", "e.*")
    # one row per metric, so a broadcast of a fixed size
    placed = ends.join(F.broadcast(curve), "metric").withColumn("offset", F.col("cell") * F.col("step"))
    reach = F.lit(KERNEL_REACH) * F.col("width")
    first = F.greatest(F.lit(0), F.ceil((F.col("offset") - reach) / F.col("gap"))).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("offset") + reach) / F.col("gap"))).cast("int")
    z = (F.col("point") * F.col("gap") - F.col("offset")) / F.col("width")
    near = (placed.withColumn("first", first).withColumn("last", last).where("first <= last")
            .select("metric", "w", "offset", "gap", "width", F.explode(F.sequence("first", "last")).alias("point"))
            .groupBy("metric", "point").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("mass")))
    height = F.col("mass") / (F.col("n") * F.col("width") * F.lit(math.sqrt(2 * math.pi)))
    return (frame.join(near, ["metric", "point"], "left")
            .select("metric", "point", "x", F.coalesce(height, F.lit(0.0)).alias("density")))


def main_metrics() -> dict:
    """The KPIs drawn as histograms, each over the rows its filter accepts."""
    return {"survival_rate": F.when(sr_is_valid(), F.col("survival_rate")),
            "fcr": F.when(fcr_is_valid(), F.col("fcr")), "adg": F.when(adg_is_valid(), F.col("adg"))}


def main_histograms(main: DataFrame) -> DataFrame:
    """The KPI histograms."""
    return histograms(main, main_metrics())


def auto_histograms(df: DataFrame, metrics: dict) -> DataFrame:
    """Histograms with an automatic number of bins for each metric."""
    return histograms(df, metrics, auto_bins(df, metrics))


def error_metrics(errors: DataFrame) -> dict:
    """The error of each model as a metric of its own: ``target_algorithm``."""
    models = errors.select("target", "algorithm").distinct().orderBy("target", "algorithm").collect()
    return {f"{t}_{a}": F.when((F.col("target") == t) & (F.col("algorithm") == a), F.col("error")) for t, a in models}


# ---------------------------------------------------------------- A14 -------

def trend_lines(df: DataFrame, pairs: list[tuple[str, str]], scope: str) -> DataFrame:
    """Least-squares line of y on x (slope, intercept, r2, n) per pair."""
    names = df.sparkSession.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pairs)],
                                            "k int, x string, y string")
    xs, ys = F.col("x"), F.col("y")
    slope = F.try_divide(F.regr_sxy(ys, xs), F.nullif(F.regr_sxx(ys, xs), F.lit(0.0)))
    agg = _pair_rows(df, pairs).groupBy("k").agg(
        F.regr_count(ys, xs).cast("bigint").alias("n"), slope.alias("slope"),
        (F.regr_avgy(ys, xs) - slope * F.regr_avgx(ys, xs)).alias("intercept"),
        F.pow(safe_corr("x", "y"), 2).alias("r2"))
    return (F.broadcast(names).join(agg, "k", "left")
            .select(F.lit(scope).alias("scope"), "x", "y", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"),
                    "slope", "intercept", "r2"))


# ---------------------------------------------------------------- A15 -------

def box_stats(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the 1.5 IQR fences),
    count and outlier count per group and column.

    Quartiles are exact grouped quantiles (a hot group is never gathered in
    one task); whiskers are a second conditional aggregate.
    """
    q = (quantile_table(df, cols, [0.25, 0.5, 0.75], by=[group])
         .groupBy(group, "column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
         .select(group, "column", F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"),
                 F.col("`0.75`").alias("q3")))
    vals = df.select(group, *[F.col(c).cast("double").alias(c) for c in cols])
    long = (vals.unpivot([group], cols, "column", "v") if len(cols) > 1
            else vals.select(group, F.lit(cols[0]).alias("column"), F.col(cols[0]).alias("v")))
    long = long.where(F.col("v").isNotNull() & ~F.isnan("v"))
    fences = q.select(group, "column", "q1", "median", "q3",
                      (F.col("q1") - IQR_FACTOR * (F.col("q3") - F.col("q1"))).alias("lo_fence"),
                      (F.col("q3") + IQR_FACTOR * (F.col("q3") - F.col("q1"))).alias("hi_fence"))
    j = long.join(fences, [group, "column"])
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    return j.groupBy(group, "column", "q1", "median", "q3").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"))


def cycles_by_month(cycles: DataFrame) -> DataFrame:
    """Cycles started per month, months 1-12 always present."""
    counts = (cycles.select(F.month("started_at").alias("month")).where(F.col("month").isNotNull())
              .groupBy("month").agg(F.count(F.lit(1)).cast("bigint").alias("n_cycles")))
    months = cycles.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return months.join(counts, "month", "left").select(
        "month", F.coalesce(F.col("n_cycles"), F.lit(0).cast("bigint")).alias("n_cycles"))


def cycles_by_season(main: DataFrame) -> DataFrame:
    """Value counts of the season label."""
    return main.groupBy("season").agg(F.count(F.lit(1)).cast("bigint").alias("n_cycles"))

