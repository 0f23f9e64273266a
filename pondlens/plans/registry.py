"""Query registry: one entry per SURVEY section 2 operator key.

Each entry has a Spark builder over the pipeline ``Stages``, an output spec
(column -> kind: d double, r ratio of sums, i bigint, t timestamp-as-text, s string, b bool)
that fixes names, types and rounding on both sides, and - where the operator
is SQL-expressible - an independent DuckDB statement over the same raw views.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.config import (BASE_FEATURES, CELLS_PER_BANDWIDTH, DENSITY_POINTS, FCR_VALID, ID_COLUMNS, IQR_FACTOR,
                             MIN_FACTOR_ROWS, SEASONAL_FEATURES, SR_RANGE, SR_VALID, TOP_FACTORS, WATER_FEATURE_MARKERS,
                             WATER_PARAMS, WATER_PARAMS_ALL)
from pondlens.functions import exprs as X
from pondlens.operators import analysis as AN
from pondlens.operators import clean as C
from pondlens.operators import ensembles as E
from pondlens.operators import features as FE
from pondlens.operators import models as M
from pondlens.operators import profile as P
from pondlens.operators import scoring as SC
from pondlens.plans import oracle as O
from pondlens.plans.stages import Stages, driver_stages
from pondlens.sources.catalog import table_shapes


@dataclass
class Query:
    build: Callable[[Stages], DataFrame]
    spec: list
    sql: str | None = None                      # inner SELECT over the oracle CTEs
    extra: list = field(default_factory=list)   # extra CTEs for the oracle


def finalize(df: DataFrame, spec: list) -> DataFrame:
    """Project to the spec: round doubles to 6 places, ints to bigint, times to text."""
    out = []
    for c, kind in spec:
        if kind == "d":
            out.append(X.r6(c).alias(c))
        elif kind == "r":
            out.append(X.r6(c, X.HALF_WITH_MARGIN).alias(c))
        elif kind == "i":
            out.append(F.col(c).cast("bigint").alias(c))
        elif kind == "t":
            out.append(X.ts_text(c).alias(c))
        elif kind == "b":
            out.append(F.col(c).cast("boolean").alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.select(*out)


def _u(parts):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _d(*cols):
    return [(c, "d") for c in cols]


WATER_AGG_COLS = [f"{p}_{s}" for p in WATER_PARAMS for s in ("mean", "min", "max", "std")]
WATER_MEANS = [f"{p}_mean" for p in WATER_PARAMS]
RAW_TABLES = list(O.RAW_COLUMNS)

# ---------------------------------------------------------------- helpers for oracle generation


def _union_sql(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _missing_sql(prefix: str) -> str:
    sel = []
    for tbl, cols in O.RAW_COLUMNS.items():
        for c in cols:
            sel.append(f"SELECT '{tbl}' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS count, "
                       f"count(*) AS n_rows FROM {prefix}_{tbl}")
    return _union_sql(sel)


def _value_sql(kind: str) -> str:
    cfg = O.PipelineConfig()
    sel = []
    for tbl, cols in O.RAW_COLUMNS.items():
        if kind == "invalid_dates":
            for c in cfg.date_columns.get(tbl, []):
                if c in cols:
                    sel.append(f"SELECT '{tbl}' AS dataset, '{c}' AS \"column\", "
                               f"count(*) FILTER (WHERE {c} IS NULL) AS count FROM t_{tbl}")
            continue
        for c in cfg.check_columns.get(tbl, []):
            if c not in cols:
                continue
            if kind == "negative_values":
                sel.append(f"SELECT '{tbl}' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {c} < 0) AS count FROM t_{tbl}")
            elif kind == "zero_values" and c != "average_weight":
                sel.append(f"SELECT '{tbl}' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {c} = 0) AS count FROM t_{tbl}")
    return f"SELECT * FROM ({_union_sql(sel)}) x WHERE count > 0"


def _fk_sql() -> str:
    sel = []
    for child, ck, parent, pk, label in O.PipelineConfig().foreign_keys:
        if child not in O.RAW_COLUMNS or parent not in O.RAW_COLUMNS:
            continue
        sel.append(f"SELECT '{label}' AS relation, count(DISTINCT c.{ck}) AS count FROM t_{child} c "
                   f"WHERE c.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t_{parent} p WHERE p.{pk} = c.{ck})")
    return f"SELECT * FROM ({_union_sql(sel)}) x WHERE count > 0"


# ---------------------------------------------------------------- model helpers


def model_rows(st: Stages, target: str) -> DataFrame:
    return M.model_frame(st.main, target)


def _split_sql(col="id") -> str:
    return (f"((((({col} % 2147483648) + 2147483648) % 2147483648) * 1103515245 + 12345) % 2147483648)")


def _bucket_sql(col="id") -> str:
    return f"(CAST(floor({_split_sql(col)} / 65536) AS BIGINT) % 100)"


def _feature_cols_sql() -> list[str]:
    water = [c for c in WATER_AGG_COLS if any(m in c for m in WATER_FEATURE_MARKERS)]
    return BASE_FEATURES + water + ["start_month", "start_quarter"]


TARGET_SQL = {"sr": "survival_rate", "abw": "average_weight", "fcr": "fcr"}


def _metrics_ctes() -> list[tuple[str, str]]:
    ctes = []
    for t, col in TARGET_SQL.items():
        ctes.append((f"m_{t}_base", f"SELECT id, CAST({col} AS DOUBLE) AS y, {_bucket_sql()} < 80 AS is_train "
                                    f"FROM main WHERE {col} IS NOT NULL"))
        if t == "abw":
            ctes.append((f"m_{t}_q", f"SELECT quantile_cont(y, 0.01) AS a, quantile_cont(y, 0.99) AS b "
                                     f"FROM m_{t}_base WHERE is_train"))
            ctes.append((f"m_{t}_b", f"SELECT a - {IQR_FACTOR} * (b - a) AS lo, b + {IQR_FACTOR} * (b - a) AS hi "
                                     f"FROM m_{t}_q"))
        elif t == "sr":
            ctes.append((f"m_{t}_b", "SELECT 0.0 AS lo, 100.0 AS hi"))
        else:
            ctes.append((f"m_{t}_b", f"SELECT {FCR_VALID[0]} AS lo, {FCR_VALID[1]} AS hi"))
        ctes.append((f"m_{t}_c", f"SELECT r.is_train, least(greatest(r.y, b.lo), b.hi) AS y FROM m_{t}_base r, m_{t}_b b"))
        ctes.append((f"m_{t}_p", f"SELECT least(greatest(avg(c.y), any_value(b.lo)), any_value(b.hi)) AS p "
                                 f"FROM m_{t}_c c, m_{t}_b b WHERE c.is_train"))
    return ctes


def _metrics_sql() -> str:
    parts = []
    for t in TARGET_SQL:
        parts.append(
            f"SELECT '{t}' AS target, count(*) AS n_test, sqrt(avg((p - y) * (p - y))) AS rmse, "
            f"avg(abs(p - y)) AS mae, 1 - sum((y - p) * (y - p)) / nullif(sum((y - ym) * (y - ym)), 0) AS r2 "
            f"FROM (SELECT c.y, p.p, avg(c.y) OVER () AS ym FROM m_{t}_c c, m_{t}_p p WHERE NOT c.is_train) z")
    return _union_sql(parts)


# ---------------------------------------------------------------- parts of the main table


def _with_kpis(st: Stages) -> DataFrame:
    return FE.add_cycle_kpis(st.cleaned["cycles"], st.cfg.as_of)


def _with_sampling(st: Stages) -> DataFrame:
    return FE.left_by_cycle(st.cleaned["cycles"], FE.last_sampling(st.cleaned["sampling"], st.cfg.sampling_order))


def _with_water(st: Stages) -> DataFrame:
    return FE.left_by_cycle(st.cleaned["cycles"], FE.water_quality_agg(st.cleaned["measurements"], st.cfg.water_params))


def _facts(st: Stages, table: str) -> tuple[DataFrame, DataFrame]:
    """A fact table and the cycles, cleaned at the same time."""
    cat = st.cleaned.load([table, "cycles"])
    return cat[table], cat["cycles"]


# ---------------------------------------------------------------- the registry


def _registry() -> dict[str, Query]:
    R: dict[str, Query] = {}
    cfg = O.PipelineConfig()

    # ---- S: sources
    R["table_shapes"] = Query(
        lambda st: table_shapes({k: v for k, v in st.raw.items() if v is not None}),
        [("dataset", "s"), ("n_rows", "i"), ("n_columns", "i")],
        _union_sql([f"SELECT '{t}' AS dataset, count(*) AS n_rows, {len(c)} AS n_columns FROM raw_{t}"
                    for t, c in O.RAW_COLUMNS.items()]))
    R["schema_summary"] = Query(
        lambda st: P.schema_summary(st.main),
        [("n_rows", "i"), ("n_columns", "i"), ("n_numeric", "i"), ("n_categorical", "i"), ("n_date", "i")],
        None)

    # ---- P: profiling
    R["describe_numeric"] = Query(
        lambda st: P.describe_catalog({**st.raw, "main": st.main},
                                      {"main": ["culture_duration", "stocking_density", "survival_rate", "adg",
                                                "fcr"]}),
        [("dataset", "s"), ("column", "s"), ("count", "i")] + _d("mean", "std", "min", "q25", "q50", "q75", "max"),
        _union_sql([f"SELECT '{t}' AS dataset, '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, "
                    f"stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, "
                    f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, "
                    f"CAST(max({c}) AS DOUBLE) AS max FROM {src}"
                    for t, src, cols in [(t, f"t_{t}", O.numeric_raw(t)) for t in RAW_TABLES]
                    + [("main", "main", ["culture_duration", "stocking_density", "survival_rate", "adg", "fcr"])]
                    for c in cols]))
    R["missing_profile"] = Query(
        lambda st: P.missing_profile(st.coerced, st.cfg),
        [("dataset", "s"), ("column", "s"), ("count", "i"), ("percentage", "d")],
        f"SELECT dataset, \"column\", count, count / n_rows * 100.0 AS percentage FROM ({_missing_sql('t')}) x WHERE count > 0")
    for issue in ("negative_values", "zero_values", "invalid_dates"):
        R[issue] = Query(
            (lambda i: lambda st: P.value_checks(st.coerced, st.cfg, i))(issue),
            [("dataset", "s"), ("column", "s"), ("count", "i")], _value_sql(issue))
    R["fk_violations"] = Query(lambda st: P.fk_violations(st.coerced, st.cfg),
                               [("relation", "s"), ("count", "i")], _fk_sql())
    issue_spec = [("dataset", "s"), ("column", "s"), ("relation", "s"), ("issue", "s"), ("count", "i"),
                  ("percentage", "d")]
    R["dq_issues"] = Query(
        lambda st: P.dq_issues(st.coerced, st.cfg), issue_spec,
        _union_sql([
            f"SELECT dataset, \"column\", NULL AS relation, 'missing_values' AS issue, count, count / n_rows * 100.0 "
            f"AS percentage FROM ({_missing_sql('t')}) x WHERE count > 0",
            *[f"SELECT dataset, \"column\", NULL AS relation, '{i}' AS issue, count, NULL AS percentage FROM ({_value_sql(i)}) y"
              for i in ("negative_values", "zero_values", "invalid_dates")],
            f"SELECT NULL AS dataset, NULL AS \"column\", relation, 'invalid_foreign_key' AS issue, count, NULL AS percentage "
            f"FROM ({_fk_sql()}) z"]))
    R["null_totals"] = Query(
        lambda st: P.null_totals(st.cleaned),
        [("dataset", "s"), ("column", "s"), ("missing", "i")],
        f"SELECT dataset, \"column\", count AS missing FROM ({_missing_sql('k')}) a UNION ALL "
        f"SELECT dataset, NULL AS \"column\", sum(count) AS missing FROM ({_missing_sql('k')}) b GROUP BY dataset")

    # ---- T1 / C: cleaning
    R["coerce_dates"] = Query(
        lambda st: st.coerced["cycles"],
        [("id", "i"), ("started_at", "t"), ("finished_at", "t")],
        "SELECT id, started_at, finished_at FROM t_cycles")
    R["impute_median"] = Query(
        lambda st: C.impute_numeric(st.coerced["cycles"], st.cfg.impute_columns["cycles"])[0],
        [("id", "i"), ("total_seed", "d"), ("area", "d")],
        "SELECT id, total_seed, area FROM a_cycles", O.clean_ctes("cycles", cfg, "a", "c1"))
    mean_cfg = replace(cfg, impute_columns={**cfg.impute_columns, "cycles": {"total_seed": "mean", "area": "mean"}})
    R["impute_mean"] = Query(
        lambda st: C.impute_numeric(st.coerced["cycles"], {"total_seed": "mean", "area": "mean"})[0],
        [("id", "i"), ("total_seed", "d"), ("area", "d")],
        "SELECT id, total_seed, area FROM b_cycles", O.clean_ctes("cycles", mean_cfg, "b", "c1"))
    R["impute_fallback"] = Query(
        # a column without any value beside one with some: the fallback applies to the first alone
        lambda st: C.impute_numeric(st.coerced["sampling"].withColumn("blank", F.lit(None).cast("double")),
                                    {"average_weight": "median", "blank": "median"})[0],
        [("cycle_id", "i"), ("l_linenumber", "i"), ("l_partkey", "i"), ("average_weight", "d"), ("blank", "d")],
        "SELECT cycle_id, l_linenumber, l_partkey, coalesce(average_weight, (SELECT quantile_cont(average_weight, 0.5) "
        "FROM t_sampling), 0.0) AS average_weight, 0.0 AS blank FROM t_sampling")
    R["preview"] = Query(
        lambda st: P.preview(st.coerced["cycles"], 5, ["id"]),
        [("id", "i"), ("pond_id", "i"), ("total_seed", "d"), ("started_at", "t")],
        "SELECT id, pond_id, total_seed, started_at FROM t_cycles ORDER BY id LIMIT 5")
    R["impute_date_global"] = Query(
        lambda st: C.impute_date_global(st.coerced["cycles"], "started_at"),
        [("id", "i"), ("started_at", "t")],
        "SELECT id, started_at FROM g_cycles", O.clean_ctes("cycles", cfg, "g", "c2"))
    R["impute_open_end"] = Query(
        lambda st: C.impute_open_end(st.coerced["cycles"], "finished_at", st.cfg.as_of),
        [("id", "i"), ("finished_at", "t")],
        f"SELECT id, coalesce(finished_at, {O.AS_OF}) AS finished_at FROM t_cycles")
    R["impute_date_by_group"] = Query(
        lambda st: C.impute_date_by_group(
            C.impute_numeric(st.coerced["feeds"], st.cfg.impute_columns["feeds"])[0], "logged_at", st.cfg.as_of),
        [("cycle_id", "i"), ("quantity", "d"), ("logged_at", "t")],
        "SELECT cycle_id, quantity, logged_at FROM g_feeds", O.clean_ctes("feeds", cfg, "g", "c2"))
    R["fix_negative"] = Query(
        lambda st: C.fix_negative(C.impute_numeric(st.coerced["cycles"], st.cfg.impute_columns["cycles"])[0],
                                  st.cfg.check_columns["cycles"]),
        [("id", "i"), ("total_seed", "d"), ("area", "d")],
        "SELECT id, total_seed, area FROM n_cycles", O.clean_ctes("cycles", cfg, "n", "c3"))
    R["fix_zero"] = Query(
        lambda st: C.fix_zero(C.fix_negative(
            C.impute_numeric(st.coerced["cycles"], st.cfg.impute_columns["cycles"])[0],
            st.cfg.check_columns["cycles"]), st.cfg.check_columns["cycles"])[0],
        [("id", "i"), ("total_seed", "d"), ("area", "d")],
        "SELECT id, total_seed, area FROM z_cycles", O.clean_ctes("cycles", cfg, "z", "c4"))
    R["impute_water"] = Query(
        lambda st: C.impute_numeric(st.coerced["measurements"], st.cfg.impute_columns["measurements"])[0],
        [("cycle_id", "i"), ("measured_at", "t")] + _d(*WATER_PARAMS_ALL),
        f"SELECT cycle_id, measured_at, {', '.join(WATER_PARAMS_ALL)} FROM w_measurements",
        O.clean_ctes("measurements", cfg, "w", "c1"))
    R["iqr_cap"] = Query(
        lambda st: st.cleaned["measurements"],
        [("cycle_id", "i"), ("measured_at", "t")] + _d(*WATER_PARAMS),
        f"SELECT cycle_id, measured_at, {', '.join(WATER_PARAMS)} FROM k_measurements")
    out_sql = []
    for tbl, cols in cfg.outlier_columns.items():
        for c in cols:
            if c not in O.RAW_COLUMNS.get(tbl, []):
                continue
            cond = f"(s.{c} < f.lo_{c} OR s.{c} > f.hi_{c})"
            out_sql.append(
                f"SELECT '{tbl}' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {cond}) AS count, "
                f"any_value(f.lo_{c}) AS lower_bound, any_value(f.hi_{c}) AS upper_bound, "
                f"min(s.{c}) FILTER (WHERE {cond}) AS min_outlier, max(s.{c}) FILTER (WHERE {cond}) AS max_outlier "
                f"FROM k{tbl}_c5pre s, k{tbl}_f f")
    R["iqr_outliers"] = Query(
        lambda st: _u([C.iqr_outliers(r["iqr_input"], n, r["iqr_bounds"])
                       for n, r in st.clean_reports.items() if r.get("iqr_bounds")]),
        [("dataset", "s"), ("column", "s"), ("count", "i")] + _d("lower_bound", "upper_bound", "min_outlier",
                                                                 "max_outlier"),
        f"SELECT * FROM ({_union_sql(out_sql)}) x WHERE count > 0")

    # ---- F: filters over the main table
    R["valid_sr"] = Query(lambda st: st.main.where(AN.sr_is_valid()), [("id", "i"), ("survival_rate", "d")],
                          f"SELECT id, survival_rate FROM main WHERE survival_rate <= {SR_VALID[1]} AND survival_rate > {SR_VALID[0]}")
    R["valid_adg"] = Query(lambda st: st.main.where(AN.adg_is_valid()), [("id", "i"), ("adg", "d")],
                           "SELECT id, adg FROM main WHERE adg > 0")
    R["valid_fcr"] = Query(lambda st: st.main.where(AN.fcr_is_valid()), [("id", "i"), ("fcr", "r")],
                           f"SELECT id, fcr FROM main WHERE fcr > {FCR_VALID[0]} AND fcr < {FCR_VALID[1]}")
    R["sr_between"] = Query(lambda st: st.main.where(AN.sr_in_range()), [("id", "i"), ("survival_rate", "d")],
                            f"SELECT id, survival_rate FROM main WHERE survival_rate BETWEEN {SR_RANGE[0]} AND {SR_RANGE[1]}")
    valid_all_sql = (f"fcr > {FCR_VALID[0]} AND fcr < {FCR_VALID[1]} AND survival_rate BETWEEN {SR_RANGE[0]} AND "
                     f"{SR_RANGE[1]} AND adg > 0")
    R["valid_all"] = Query(lambda st: st.main.where(AN.all_valid()),
                           [("id", "i"), ("fcr", "r")] + _d("survival_rate", "adg"),
                           f"SELECT id, fcr, survival_rate, adg FROM main WHERE {valid_all_sql}")
    dens_sql = f"survival_rate BETWEEN {SR_RANGE[0]} AND {SR_RANGE[1]} AND stocking_density > 0"
    R["sr_density_filter"] = Query(lambda st: st.main.where(AN.sr_density_valid()),
                                   [("id", "i")] + _d("stocking_density", "survival_rate"),
                                   f"SELECT id, stocking_density, survival_rate FROM main WHERE {dens_sql}")

    # ---- J: joins
    R["join_pond_farm"] = Query(
        lambda st: FE.join_pond_farm(st.cleaned["ponds"], st.cleaned["farms"]),
        [("id_pond", "i"), ("farm_id", "i"), ("id_farm", "i"), ("name", "s")] + _d("length", "width", "deep"),
        "SELECT p.id AS id_pond, p.farm_id, f.id AS id_farm, f.name, p.length, p.width, p.deep "
        "FROM k_ponds p LEFT JOIN t_farms f ON p.farm_id = f.id")
    R["join_snowflake"] = Query(
        lambda st: FE.join_snowflake(st.cleaned["cycles"],
                                     FE.join_pond_farm(st.cleaned["ponds"], st.cleaned["farms"])),
        [("id", "i"), ("pond_id", "i"), ("id_pond", "i"), ("farm_id", "i"), ("id_farm", "i"), ("name", "s")],
        "SELECT c.id, c.pond_id, pf.id_pond, pf.farm_id, pf.id_farm, pf.name FROM k_cycles c "
        "LEFT JOIN pf ON c.pond_id = pf.id_pond")
    R["join_harvest"] = Query(lambda st: FE.left_by_cycle(st.cleaned["cycles"], FE.harvest_agg(st.cleaned["harvests"])),
                              [("id", "i"), ("weight", "d"), ("size", "d"), ("harvested_at", "t")],
                              "SELECT id, weight, size, harvested_at FROM main")
    R["join_last_sampling"] = Query(lambda st: FE.add_growth(_with_sampling(st)),
                                    [("id", "i"), ("average_weight", "d"), ("days_from_start", "i")],
                                    "SELECT id, average_weight, days_from_start FROM main")
    R["join_feed"] = Query(lambda st: FE.left_by_cycle(st.cleaned["cycles"], FE.feed_agg(st.cleaned["feeds"])),
                           [("id", "i"), ("total_feed", "d")], "SELECT id, total_feed FROM main")
    R["join_water"] = Query(_with_water,
                                  [("id", "i")] + _d(*WATER_AGG_COLS),
                            f"SELECT id, {', '.join(WATER_AGG_COLS)} FROM main")
    fwc_sql = ("SELECT s.cycle_id, s.l_linenumber, s.l_partkey, s.sampled_at, s.average_weight, "
               f"CAST(floor((epoch_us(s.sampled_at) - epoch_us(c.started_at)) / {O.DAY_US}) AS BIGINT) AS culture_days "
               "FROM k_sampling s LEFT JOIN k_cycles c ON s.cycle_id = c.id")
    R["fact_with_cycle"] = Query(
        lambda st: FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at"),
        [("cycle_id", "i"), ("l_linenumber", "i"), ("l_partkey", "i"), ("sampled_at", "t"), ("average_weight", "d"),
         ("culture_days", "i")], fwc_sql)

    # ---- A: aggregations
    R["harvest_agg"] = Query(lambda st: FE.harvest_agg(st.cleaned["harvests"]),
                             [("cycle_id", "i"), ("weight", "d"), ("size", "d"), ("harvested_at", "t")],
                             "SELECT cycle_id, weight, size, harvested_at FROM h_agg")
    R["feed_agg"] = Query(lambda st: FE.feed_agg(st.cleaned["feeds"]), [("cycle_id", "i"), ("total_feed", "d")],
                          "SELECT cycle_id, total_feed FROM f_agg")
    R["daily_feed"] = Query(
        lambda st: FE.daily_feed(*_facts(st, "feeds")),
        [("cycle_id", "i"), ("culture_days", "i"), ("quantity", "d")], None, [])
    daily_sql = ("SELECT f.cycle_id, CAST(floor((epoch_us(f.logged_at) - epoch_us(c.started_at)) / "
                 f"{O.DAY_US}) AS BIGINT) AS culture_days, f.quantity FROM k_feeds f LEFT JOIN k_cycles c ON f.cycle_id = c.id")
    R["daily_feed"].sql = (f"SELECT cycle_id, culture_days, coalesce(sum(CAST(quantity AS DOUBLE)), 0.0) AS quantity FROM ({daily_sql}) d "
                           "WHERE cycle_id IS NOT NULL AND culture_days IS NOT NULL GROUP BY cycle_id, culture_days")
    R["daily_feed_first5"] = Query(
        lambda st: FE.first_cycles(FE.daily_feed(*_facts(st, "feeds")), 5),
        [("cycle_id", "i"), ("culture_days", "i"), ("quantity", "d")],
        f"SELECT * FROM ({R['daily_feed'].sql}) d WHERE cycle_id IN "
        f"(SELECT DISTINCT cycle_id FROM ({R['daily_feed'].sql}) e ORDER BY cycle_id LIMIT 5)")
    R["water_quality_agg"] = Query(
        lambda st: FE.water_quality_agg(st.cleaned["measurements"], st.cfg.water_params),
        [("cycle_id", "i")] + _d(*WATER_AGG_COLS), f"SELECT cycle_id, {', '.join(WATER_AGG_COLS)} FROM w_agg")
    R["last_sampling"] = Query(
        lambda st: FE.last_sampling(st.cleaned["sampling"], st.cfg.sampling_order),
        [("cycle_id", "i"), ("average_weight", "d"), ("last_sampled_at", "t")],
        "SELECT cycle_id, average_weight, last_sampled_at FROM s_agg")
    R["cycles_by_month"] = Query(
        lambda st: AN.cycles_by_month(st.cleaned["cycles"]), [("month", "i"), ("n_cycles", "i")],
        "SELECT m.month, coalesce(c.n, 0) AS n_cycles FROM range(1, 13) m(month) LEFT JOIN "
        "(SELECT month(started_at) AS month, count(*) AS n FROM k_cycles WHERE started_at IS NOT NULL GROUP BY 1) c "
        "ON m.month = c.month")
    R["cycles_by_season"] = Query(lambda st: AN.cycles_by_season(st.main), [("season", "s"), ("n_cycles", "i")],
                                  "SELECT season, count(*) AS n_cycles FROM main GROUP BY season")
    kpi_sql = []
    for c, cond in [("culture_duration", None), ("stocking_density", None),
                    ("survival_rate", f"survival_rate <= {SR_VALID[1]} AND survival_rate > {SR_VALID[0]}"),
                    ("adg", "adg > 0"), ("fcr", f"fcr > {FCR_VALID[0]} AND fcr < {FCR_VALID[1]}"),
                    ("temp_daily_fluctuation", None), ("pond_volume", None)]:
        v = f"CAST({c} AS DOUBLE)" if cond is None else f"CASE WHEN {cond} THEN CAST({c} AS DOUBLE) END"
        kpi_sql.append(f"SELECT '{c}' AS metric, count({v}) AS n, min({v}) AS min, max({v}) AS max, avg({v}) AS mean FROM main")
    R["kpi_summary"] = Query(lambda st: AN.kpi_summary(st.main),
                             [("metric", "s"), ("n", "i")] + _d("min", "max", "mean"), _union_sql(kpi_sql))

    def corr_sql(pairs, src, scope, where="TRUE"):
        return _union_sql([
            f"SELECT '{scope}' AS scope, '{x}' AS var_x, '{y}' AS var_y, "
            f"count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n, "
            f"regr_sxy({y}, {x}) / nullif(sqrt(regr_sxx({y}, {x}) * regr_syy({y}, {x})), 0) AS corr "
            f"FROM {src} WHERE {where}" for x, y in pairs])

    corr_spec = [("scope", "s"), ("var_x", "s"), ("var_y", "s"), ("n", "i"), ("corr", "d")]
    kpis = ["culture_duration", "stocking_density", "survival_rate", "adg", "fcr"]
    tri = lambda cols: [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    R["corr_matrix"] = Query(
        lambda st: AN.corr_matrix(st.cleaned["measurements"], st.cfg.water_params, "water").unionByName(
            AN.corr_matrix(st.main, kpis, "kpi")),
        corr_spec, corr_sql(tri(WATER_PARAMS), "k_measurements", "water") + "\nUNION ALL\n" +
        corr_sql(tri(kpis), "main", "kpi"))
    R["corr_density_sr"] = Query(
        lambda st: AN.corr_pairs(st.main.where(AN.sr_density_valid()), [("stocking_density", "survival_rate")],
                                 "density_sr"),
        corr_spec, corr_sql([("stocking_density", "survival_rate")], "main", "density_sr", dens_sql))
    R["corr_water_adg"] = Query(
        lambda st: AN.corr_pairs(st.main.where(AN.adg_is_valid()), [(c, "adg") for c in AN.water_mean_columns(st.main)],
                                 "water_adg"),
        corr_spec, corr_sql([(c, "adg") for c in WATER_MEANS], "main", "water_adg", "adg > 0"))
    R["corr_fcr_sr_adg"] = Query(
        lambda st: AN.corr_pairs(st.main.where(AN.all_valid()), [("fcr", "survival_rate"), ("fcr", "adg")], "fcr"),
        corr_spec, corr_sql([("fcr", "survival_rate"), ("fcr", "adg")], "main", "fcr", valid_all_sql))

    R["top_factors"] = Query(lambda st: AN.top_factors(st.main), [("factor", "s"), ("corr", "d")], None)
    R["histogram"] = Query(
        lambda st: _u([AN.main_histograms(st.main),
                       AN.histograms(st.cleaned["harvests"], {"harvest_size": F.col("size")}),
                       AN.histograms(st.cleaned["measurements"], {p: F.col(p) for p in WATER_PARAMS}),
                       AN.histograms(FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at"),
                                     {"daily_growth": X.safe_div("average_weight", "culture_days")})]),
        [("metric", "s"), ("bin", "i")] + _d("bin_lo", "bin_hi") + [("count", "i")], None)
    hist_parts = []
    auto_metrics = [*[(p, p, "k_measurements", "TRUE") for p in WATER_PARAMS],
                    ("daily_growth", "average_weight / nullif(CAST(culture_days AS DOUBLE), 0)", f"({fwc_sql})", "TRUE")]
    kpi_metrics = [
        ("survival_rate", "survival_rate", "main", f"survival_rate <= {SR_VALID[1]} AND survival_rate > {SR_VALID[0]}"),
        ("fcr", "fcr", "main", f"fcr > {FCR_VALID[0]} AND fcr < {FCR_VALID[1]}"),
        ("harvest_size", "size", "k_harvests", "TRUE"), ("adg", "adg", "main", "adg > 0")]
    for metric, col, src, where in kpi_metrics + auto_metrics:
        v = (f"(SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE ({where}) AND {col} IS NOT NULL "
             f"AND NOT isnan(CAST({col} AS DOUBLE)))")
        rng = (f"(SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, "
               f"CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {v} a)")
        cnt = (f"(SELECT CAST(least(floor((v - r.lo) * 20.0 / (r.hi - r.lo)), 19) AS BIGINT) AS bin, count(*) AS n "
               f"FROM {v} b, {rng} r GROUP BY 1)")
        hist_parts.append(
            f"SELECT '{metric}' AS metric, e.bin, r.lo + e.bin * (r.hi - r.lo) / 20.0 AS bin_lo, "
            f"r.lo + (e.bin + 1) * (r.hi - r.lo) / 20.0 AS bin_hi, coalesce(c.n, 0) AS count "
            f"FROM {rng} r, range(0, 20) e(bin) LEFT JOIN {cnt} c ON e.bin = c.bin WHERE r.lo IS NOT NULL")
    R["histogram"].sql = _union_sql(hist_parts)

    def drawn_values(metrics):
        return _union_sql([f"SELECT '{m}' AS metric, CAST({col} AS DOUBLE) AS v FROM {src} WHERE ({where}) AND {col} IS NOT NULL "
                           f"AND NOT isnan(CAST({col} AS DOUBLE))" for m, col, src, where in metrics])

    def growth():
        return {"daily_growth": X.safe_div("average_weight", "culture_days")}

    def water():
        return {p: F.col(p) for p in WATER_PARAMS}

    R["histogram_auto"] = Query(
        lambda st: _u([AN.auto_histograms(st.cleaned["measurements"], water()),
                       AN.auto_histograms(FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at"), growth())]),
        R["histogram"].spec,
        "SELECT b.metric, b.bin, lo + b.bin * (hi - lo) / k AS bin_lo, lo + (b.bin + 1) * (hi - lo) / k AS bin_hi, "
        "coalesce(c.n, 0) AS count FROM (SELECT *, unnest(range(CAST(k AS BIGINT))) AS bin FROM a_bins) b LEFT JOIN "
        "(SELECT metric, CAST(least(floor((v - lo) * k / (hi - lo)), k - 1) AS BIGINT) AS bin, count(*) AS n "
        "FROM a_vals JOIN a_bins USING (metric) GROUP BY ALL) c ON b.metric = c.metric AND b.bin = c.bin",
        [("a_vals", drawn_values(auto_metrics)),
         ("a_stats", "SELECT metric, count(*) AS n, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.25) AS q1, "
                     "quantile_cont(v, 0.75) AS q3 FROM a_vals GROUP BY metric"),
         ("a_widths", "SELECT *, (hi - lo) / (log2(n) + 1) AS sturges, CASE WHEN q3 > q1 THEN "
                      "greatest(2 * (q3 - q1) / pow(n, 1.0::DOUBLE / 3), (hi - lo) / sqrt(n) / 2) END AS freedman FROM a_stats"),
         ("a_bins", "SELECT metric, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END "
                    "AS hi, CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE greatest(1, ceil((hi - lo) / least(sturges, "
                    "coalesce(freedman, sturges)))) END AS k FROM a_widths")])
    R["density"] = Query(
        lambda st: _u([AN.densities(st.main, AN.main_metrics()),
                       AN.densities(st.cleaned["harvests"], {"harvest_size": F.col("size")}),
                       AN.densities(st.cleaned["measurements"], water()),
                       AN.densities(FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at"), growth())]),
        [("metric", "s"), ("point", "i"), ("x", "d"), ("density", "r")],
        f"SELECT s.metric, p.point, s.lo + p.point * s.gap AS x, "
        f"sum(e.w * exp(-0.5 * pow((p.point * s.gap - e.cell * s.step) / s.width, 2))) / (any_value(s.n) * any_value(s.width) "
        f"* sqrt(2 * pi())) AS density FROM e_curves s JOIN e_ends e USING (metric), range(0, {DENSITY_POINTS}) p(point) "
        f"GROUP BY s.metric, p.point, s.lo, s.gap",
        [("e_vals", drawn_values(kpi_metrics + auto_metrics)),
         ("e_stats", "SELECT metric, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2::DOUBLE) AS width, "
                     f"(max(v) - min(v)) / {DENSITY_POINTS - 1} AS gap FROM e_vals GROUP BY metric HAVING count(*) > 1 AND max(v) > min(v)"),
         ("e_curves", f"SELECT *, gap / ceil({CELLS_PER_BANDWIDTH} * gap / width) AS step FROM e_stats"),
         ("e_cells", "SELECT metric, floor((v - lo) / step) AS cell, count(*) AS c, "
                     "sum((v - lo) / step - floor((v - lo) / step)) AS p FROM e_vals JOIN e_curves USING (metric) GROUP BY ALL"),
         ("e_ends", "SELECT metric, cell, c - p AS w FROM e_cells UNION ALL SELECT metric, cell + 1, p FROM e_cells")])
    R["top_factors"].sql = None  # filled below (needs the main column list)

    trend_spec = [("scope", "s"), ("x", "s"), ("y", "s"), ("n", "i")] + _d("slope", "intercept", "r2")

    def trend_sql(pairs, src, scope, where="TRUE"):
        return _union_sql([
            f"SELECT '{scope}' AS scope, '{x}' AS x, '{y}' AS y, regr_count({y}, {x}) AS n, "
            f"regr_sxy({y}, {x}) / nullif(regr_sxx({y}, {x}), 0) AS slope, "
            f"regr_avgy({y}, {x}) - regr_sxy({y}, {x}) / nullif(regr_sxx({y}, {x}), 0) * regr_avgx({y}, {x}) AS intercept, "
            f"pow(regr_sxy({y}, {x}) / nullif(sqrt(regr_sxx({y}, {x}) * regr_syy({y}, {x})), 0), 2) AS r2 "
            f"FROM {src} WHERE {where}" for x, y in pairs])

    R["trend_line"] = Query(
        lambda st: _u([
            AN.trend_lines(FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at"),
                           [("culture_days", "average_weight")], "growth"),
            AN.trend_lines(st.main.where(AN.sr_density_valid()), [("stocking_density", "survival_rate")], "density_sr"),
            AN.trend_lines(st.main.where(AN.adg_is_valid()), [(c, "adg") for c in WATER_MEANS], "water_adg"),
            AN.trend_lines(st.main.where(AN.all_valid()), [("fcr", "survival_rate"), ("fcr", "adg")], "fcr")]),
        trend_spec,
        _union_sql([trend_sql([("culture_days", "average_weight")], f"({fwc_sql})", "growth"),
                    trend_sql([("stocking_density", "survival_rate")], "main", "density_sr", dens_sql),
                    trend_sql([(c, "adg") for c in WATER_MEANS], "main", "water_adg", "adg > 0"),
                    trend_sql([("fcr", "survival_rate"), ("fcr", "adg")], "main", "fcr", valid_all_sql)]))
    box_parts = []
    for col in ("survival_rate", "adg"):
        src = (f"(SELECT season, CAST({col} AS DOUBLE) AS v FROM main WHERE survival_rate BETWEEN {SR_RANGE[0]} AND "
               f"{SR_RANGE[1]} AND {col} IS NOT NULL AND NOT isnan({col}))")
        q = (f"(SELECT season, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
             f"quantile_cont(v, 0.75) AS q3 FROM {src} s GROUP BY season)")
        box_parts.append(
            f"SELECT d.season, '{col}' AS \"column\", q.q1, q.median, q.q3, count(*) AS n, "
            f"min(d.v) FILTER (WHERE d.v >= q.q1 - {IQR_FACTOR} * (q.q3 - q.q1) AND d.v <= q.q3 + {IQR_FACTOR} * (q.q3 - q.q1)) AS whisker_lo, "
            f"max(d.v) FILTER (WHERE d.v >= q.q1 - {IQR_FACTOR} * (q.q3 - q.q1) AND d.v <= q.q3 + {IQR_FACTOR} * (q.q3 - q.q1)) AS whisker_hi, "
            f"count(*) FILTER (WHERE NOT (d.v >= q.q1 - {IQR_FACTOR} * (q.q3 - q.q1) AND d.v <= q.q3 + {IQR_FACTOR} * (q.q3 - q.q1))) AS n_outliers "
            f"FROM {src} d JOIN {q} q ON d.season = q.season GROUP BY d.season, q.q1, q.median, q.q3")
    R["box_stats"] = Query(
        lambda st: AN.box_stats(st.main.where(AN.sr_in_range()), "season", ["survival_rate", "adg"]),
        [("season", "s"), ("column", "s")] + _d("q1", "median", "q3") + [("n", "i")] + _d("whisker_lo", "whisker_hi")
        + [("n_outliers", "i")],
        _union_sql(box_parts))

    # ---- K: KPIs
    R["culture_duration"] = Query(_with_kpis,
                                  [("id", "i"), ("started_at", "t"), ("finished_at", "t"),
                                                       ("culture_duration", "i")],
                                  "SELECT id, started_at, finished_at, culture_duration FROM main")
    R["stocking_density"] = Query(_with_kpis,
                                  [("id", "i"), ("stocking_density", "d")],
                                  "SELECT id, stocking_density FROM main")
    R["season_features"] = Query(_with_kpis,
                                  [("id", "i"), ("start_month", "i"), ("start_quarter", "i"),
                                                      ("season", "s")],
                                 "SELECT id, start_month, start_quarter, season FROM main")
    R["survival_rate"] = Query(lambda st: FE.add_survival(FE.left_by_cycle(
        st.cleaned["cycles"], FE.harvest_agg(st.cleaned["harvests"]))), [("id", "i")] + _d("abw_harvest", "harvested_count", "survival_rate"),
                               "SELECT id, abw_harvest, harvested_count, survival_rate FROM main")
    R["adg"] = Query(lambda st: FE.add_growth(_with_sampling(st)), [("id", "i"), ("average_weight", "d"), ("days_from_start", "i"), ("adg", "d")],
                     "SELECT id, average_weight, days_from_start, adg FROM main")
    R["growth_by_age"] = Query(
        lambda st: FE.fact_with_cycle(*_facts(st, "sampling"), "sampled_at")
        .withColumn("adg", X.safe_div("average_weight", "culture_days")),
        [("cycle_id", "i"), ("l_linenumber", "i"), ("l_partkey", "i"), ("culture_days", "i"), ("adg", "d")],
        f"SELECT cycle_id, l_linenumber, l_partkey, culture_days, "
        f"average_weight / nullif(CAST(culture_days AS DOUBLE), 0) AS adg FROM ({fwc_sql}) g")
    R["growth_by_age_subday"] = Query(
        lambda st: FE.fact_with_cycle(st.events, st.cleaned["cycles"], "sampled_at")
        .withColumn("adg", X.safe_div("average_weight", "culture_days")),
        [("event_id", "i"), ("cycle_id", "i"), ("sampled_at", "t"), ("culture_days", "i"), ("adg", "d")],
        "SELECT e.event_id, e.cycle_id, e.sampled_at, "
        f"CAST(floor((epoch_us(e.sampled_at) - epoch_us(c.started_at)) / {O.DAY_US}) AS BIGINT) AS culture_days, "
        f"e.average_weight / nullif(CAST(CAST(floor((epoch_us(e.sampled_at) - epoch_us(c.started_at)) / {O.DAY_US}) "
        "AS BIGINT) AS DOUBLE), 0) AS adg FROM raw_events e LEFT JOIN k_cycles c ON e.cycle_id = c.id")
    R["fcr"] = Query(lambda st: FE.add_fcr(FE.left_by_cycle(FE.left_by_cycle(
        st.cleaned["cycles"], FE.harvest_agg(st.cleaned["harvests"])), FE.feed_agg(st.cleaned["feeds"]))), [("id", "i")] + _d("total_feed", "weight") + [("fcr", "r")],
                     "SELECT id, total_feed, weight, fcr FROM main")
    R["temp_fluctuation"] = Query(lambda st: FE.add_temp_fluctuation(_with_water(st)), [("id", "i"), ("temp_daily_fluctuation", "d")],
                                  "SELECT id, temp_daily_fluctuation FROM main")
    R["pond_geometry"] = Query(
        lambda st: FE.pond_geometry(st.cleaned["ponds"]),
        [("id", "i")] + _d("length", "width", "deep", "pond_volume", "surface_to_volume_ratio"),
        "SELECT id, length, width, deep, length * width * deep AS pond_volume, "
        "(length * width) / nullif(length * width * deep, 0) AS surface_to_volume_ratio FROM k_ponds")
    R["harvest_by_age"] = Query(
        lambda st: FE.fact_with_cycle(*_facts(st, "harvests"), "harvested_at", "culture_duration"),
        [("cycle_id", "i"), ("harvested_at", "t"), ("weight", "d"), ("culture_duration", "i")],
        "SELECT h.cycle_id, h.harvested_at, h.weight, "
        f"CAST(floor((epoch_us(h.harvested_at) - epoch_us(c.started_at)) / {O.DAY_US}) AS BIGINT) AS culture_duration "
        "FROM k_harvests h LEFT JOIN k_cycles c ON h.cycle_id = c.id")
    main_spec = ([("id", "i"), ("pond_id", "i")] + _d("total_seed", "area") + [("started_at", "t"), ("finished_at", "t"),
                 ("culture_duration", "i")] + _d("stocking_density") + [("start_month", "i"), ("start_quarter", "i"),
                 ("season", "s")] + _d("weight", "size") + [("harvested_at", "t")]
                 + _d("abw_harvest", "harvested_count", "survival_rate", "average_weight")
                 + [("last_sampled_at", "t"), ("days_from_start", "i")] + _d("adg", "total_feed") + [("fcr", "r")]
                 + _d(*WATER_AGG_COLS) + _d("temp_daily_fluctuation")
                 + [("id_pond", "i"), ("farm_id", "i")] + _d("length", "width", "deep", "pond_volume",
                                                             "surface_to_volume_ratio")
                 + [("id_farm", "i"), ("name", "s")])
    R["main_table"] = Query(lambda st: st.main, main_spec,
                            f"SELECT {', '.join(c for c, _ in main_spec)} FROM main")
    R["reload_processed"] = Query(lambda st: st.reloaded, main_spec, R["main_table"].sql)
    n_num = sum(1 for _, k in main_spec if k in ("d", "r", "i"))
    n_date = sum(1 for _, k in main_spec if k == "t")
    R["schema_summary"].sql = (f"SELECT count(*) AS n_rows, {len(main_spec)} AS n_columns, {n_num} AS n_numeric, "
                               f"{len(main_spec) - n_num - n_date} AS n_categorical, {n_date} AS n_date FROM main")

    # top factors: numeric main columns minus ids and target, fixed by the main spec
    factor_cols = [c for c, k in main_spec if k in ("d", "r", "i") and c not in ID_COLUMNS and c != "survival_rate"]
    tf_rows = _union_sql([
        f"SELECT '{c}' AS factor, count({c}) AS n, "
        f"regr_sxy(survival_rate, {c}) / nullif(sqrt(regr_sxx(survival_rate, {c}) * regr_syy(survival_rate, {c})), 0) AS corr "
        f"FROM main WHERE survival_rate BETWEEN {SR_RANGE[0]} AND {SR_RANGE[1]}" for c in factor_cols])
    R["top_factors"].sql = (f"SELECT factor, corr FROM ({tf_rows}) x WHERE n > {MIN_FACTOR_ROWS} AND corr IS NOT NULL "
                            f"ORDER BY abs(corr) DESC, factor LIMIT {TOP_FACTORS}")

    # ---- M: model preparation and evaluation
    feats = _feature_cols_sql()
    R["feature_mean_fill"] = Query(
        lambda st: M.feature_means(model_rows(st, "sr")),
        [("feature", "s"), ("mean", "d")],
        _union_sql([f"SELECT '{f}' AS feature, avg({f}) AS mean FROM main WHERE survival_rate IS NOT NULL"
                    for f in feats]))
    R["one_hot"] = Query(
        lambda st: M.one_hot_counts(model_rows(st, "sr")),
        [("feature", "s"), ("category", "i"), ("n", "i")],
        "SELECT 'start_month' AS feature, start_month AS category, count(*) AS n FROM main "
        "WHERE survival_rate IS NOT NULL AND start_month IS NOT NULL GROUP BY 2 UNION ALL "
        "SELECT 'start_quarter' AS feature, start_quarter AS category, count(*) AS n FROM main "
        "WHERE survival_rate IS NOT NULL AND start_quarter IS NOT NULL GROUP BY 2")
    R["split_counts"] = Query(
        lambda st: M.split_counts(model_rows(st, "sr")),
        [("split", "s"), ("n", "i")],
        f"SELECT CASE WHEN {_bucket_sql()} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n "
        "FROM main WHERE survival_rate IS NOT NULL GROUP BY 1")
    R["abw_fences"] = Query(
        lambda st: M.abw_fences(model_rows(st, "abw")),
        [("n_train", "i")] + _d("q01", "q99", "lower", "upper"),
        f"SELECT n_train, a AS q01, b AS q99, a - {IQR_FACTOR} * (b - a) AS lower, b + {IQR_FACTOR} * (b - a) AS upper "
        f"FROM (SELECT count(*) AS n_train, quantile_cont(average_weight, 0.01) AS a, "
        f"quantile_cont(average_weight, 0.99) AS b FROM main WHERE average_weight IS NOT NULL AND {_bucket_sql()} < 80) x")
    R["regression_metrics"] = Query(
        lambda st: M.baseline_metrics(st.main),
        [("target", "s"), ("n_test", "i")] + _d("rmse", "mae", "r2"), _metrics_sql(), _metrics_ctes())
    R["prediction_errors"] = Query(
        lambda st: E.prediction_errors(st.export, st.main),
        [("target", "s"), ("algorithm", "s"), ("id", "i")] + _d("actual", "prediction", "error"), None)
    R["error_histogram"] = Query(
        lambda st: (lambda e: AN.auto_histograms(e, AN.error_metrics(e)))(E.prediction_errors(st.export, st.main)),
        R["histogram"].spec, None)
    R["error_density"] = Query(
        lambda st: (lambda e: AN.densities(e, AN.error_metrics(e)))(E.prediction_errors(st.export, st.main)),
        R["density"].spec, None)
    R["feature_importance"] = Query(
        lambda st: E.feature_importance(st.export),
        [("target", "s"), ("feature", "s"), ("importance", "d")], None)
    R["model_summary"] = Query(
        lambda st: E.summary(st.export),
        [("model_type", "s"), ("algorithm", "s")] + _d("r2", "rmse", "mae", "cv_mean", "cv_std"), None)
    R["model_search"] = Query(
        lambda st: E.summary(st.searched),
        [("model_type", "s"), ("algorithm", "s"), ("settings", "s")] + _d("r2", "rmse", "mae", "cv_mean", "cv_std"), None)
    R["export_metadata"] = Query(
        lambda st: E.export_metadata(st.export),
        [("target", "s"), ("algorithm", "s"), ("n_features", "i"), ("feature_names", "s")] + _d("lower", "upper"), None)
    R["standardise"] = Query(
        lambda st: E.scaled_ranges(st.main),
        [("feature", "s"), ("n", "i")] + _d("mean", "std", "lowest", "highest"),
        _union_sql([f"SELECT '{f}' AS feature, count(*) AS n, any_value(m) AS mean, any_value(s) AS std, "
                    f"min((coalesce({f}, m) - m) / CASE WHEN s > 0 THEN s ELSE 1 END) AS lowest, "
                    f"max((coalesce({f}, m) - m) / CASE WHEN s > 0 THEN s ELSE 1 END) AS highest FROM main, "
                    f"(SELECT avg({f}) AS m, stddev_pop({f}) AS s FROM main WHERE {_bucket_sql()} < 80) x"
                    for f in feats if f not in SEASONAL_FEATURES]))

    # ---- B: batch scoring
    R["validate_scoring_input"] = Query(
        lambda st: SC.validate(SC.records_from_main(st.main)),
        [("id", "i"), ("sr_ok", "b"), ("abw_ok", "b"), ("fcr_ok", "b")],
        "SELECT id, coalesce(stocking_density BETWEEN 0 AND 1000, FALSE) AS sr_ok, "
        "coalesce(culture_duration > 0, FALSE) AS abw_ok, coalesce(culture_duration > 0, FALSE) AS fcr_ok FROM main")
    R["score_batch"] = Query(
        lambda st: E.score(st.export, SC.records_from_main(st.main)).select("id", *M.TARGETS.values()),
        [("id", "i")] + _d("survival_rate", "average_weight", "fcr"), None)
    R["model_info"] = Query(lambda st: E.model_info(st.export),
                            [("target", "s"), ("model_type", "s"), ("n_features", "i"), ("feature_names", "s"), ("status", "s")],
                            None)
    return R


_REG: dict[str, Query] | None = None


def registry() -> dict[str, Query]:
    global _REG
    if _REG is None:
        _REG = _registry()
    return _REG


def run(spark, sf_dir: str, name: str) -> DataFrame:
    q = registry()[name]
    return finalize(q.build(driver_stages(spark, sf_dir)), q.spec)


def oracle(name: str) -> str | None:
    q = registry()[name]
    if q.sql is None:
        return None
    return O.with_clause(q.extra) + "\n" + O.wrap(q.spec, q.sql)
