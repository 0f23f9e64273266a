"""DuckDB oracle SQL for the query registry.

This is an independent, plain-SQL statement of every operator's semantics
(exact ``quantile_cont``, ``arg_max``, ``nullif`` division, ...) over the same
raw views, used only to check the Spark plans. The CTE chain mirrors the
cleaning order C1 -> C2 -> C3 -> C4 -> C5 -> C6 and is generated from the same
column configuration the Spark operators receive.
"""

from __future__ import annotations

from pondlens.config import IQR_FACTOR, PipelineConfig
from pondlens.functions.exprs import HALF, HALF_WITH_MARGIN
from pondlens.sources.driver_views import RAW_VIEWS

AS_OF = "TIMESTAMP '2026-01-01 00:00:00'"
DAY_US = "86400000000"

# columns of the raw views over the driver tables (pond table -> columns)
RAW_COLUMNS = {
    "farms": ["id", "name"],
    "ponds": ["id", "farm_id", "length", "width", "deep"],
    "cycles": ["id", "pond_id", "total_seed", "area", "started_at", "finished_at"],
    "feeds": ["cycle_id", "quantity", "logged_at"],
    "harvests": ["cycle_id", "size", "weight", "harvested_at"],
    "sampling": ["cycle_id", "average_weight", "sampled_at", "l_linenumber", "l_partkey", "l_suppkey"],
    "measurements": ["cycle_id", "measured_at", "morning_temperature", "evening_temperature",
                     "morning_do", "evening_do", "morning_salinity", "evening_salinity",
                     "morning_pH", "evening_pH", "transparency", "ammonia", "nitrate", "nitrite", "alkalinity",
                     "hardness", "calcium", "magnesium", "carbonate", "bicarbonate", "tom", "total_plankton"],
    "mortalities": ["cycle_id", "quantity", "average_weight", "recorded_at"],
    "fasting": ["cycle_id", "fasted_at"],
    "feed_tray": ["cycle_id", "logged_at", "feed_logged_at"],
}
NAN_COLUMNS = {"feeds": ["quantity"], "measurements": ["hardness"]}
UNCHECKED_DATES = {"fasting": ["fasted_at"]}
TEXT_COLUMNS = {"farms": ["name"], "cycles": ["started_at", "finished_at"]}


def numeric_raw(tbl: str) -> list[str]:
    dates = PipelineConfig().date_columns.get(tbl, []) + UNCHECKED_DATES.get(tbl, [])
    return [c for c in RAW_COLUMNS[tbl] if c not in dates and c not in TEXT_COLUMNS.get(tbl, [])]


def _sel(cols: list[str], repl: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f"{repl[c]} AS {c}" if c in repl else f"{prefix}{c}" for c in cols)


def _ts_from_us(x: str) -> str:
    return f"make_timestamp(CAST(floor({x}) AS BIGINT))"


def clean_ctes(tbl: str, cfg: PipelineConfig, prefix: str = "k", stop_after: str = "c6") -> list[tuple[str, str]]:
    """CTEs taking ``t_{tbl}`` through the cleaning chain to ``{prefix}_{tbl}``."""
    cols = RAW_COLUMNS[tbl]
    ctes: list[tuple[str, str]] = []
    src = f"t_{tbl}"
    p = f"{prefix}{tbl}"

    def add(name, sql):
        nonlocal src
        ctes.append((name, sql))
        src = name

    imp = {c: m for c, m in cfg.impute_columns.get(tbl, {}).items() if c in cols}
    if imp:
        aggs = ", ".join(
            (f"avg({c}) AS m_{c}" if m == "mean" else f"quantile_cont({c}, 0.5) AS m_{c}") for c, m in imp.items())
        ctes.append((f"{p}_m1", f"SELECT {aggs} FROM {src}"))
        repl = {c: f"coalesce(CAST(s.{c} AS DOUBLE), m.m_{c}, 0.0)" for c in imp}
        add(f"{p}_c1", f"SELECT {_sel(cols, repl, 's.')} FROM {src} s, {p}_m1 m")
    if stop_after == "c1":
        ctes.append((f"{prefix}_{tbl}", f"SELECT * FROM {src}"))
        return ctes
    for dc in [c for c in cfg.date_columns.get(tbl, []) if c in cols]:
        if tbl == "cycles" and dc == "started_at":
            ctes.append((f"{p}_gd_{dc}", f"SELECT quantile_cont(epoch_us({dc}), 0.5) AS m FROM {src}"))
            add(f"{p}_d_{dc}", f"SELECT {_sel(cols, {dc: f'coalesce(s.{dc}, {_ts_from_us('g.m')})'}, 's.')} "
                               f"FROM {src} s, {p}_gd_{dc} g")
        elif tbl == "cycles" and dc == "finished_at":
            add(f"{p}_d_{dc}", f"SELECT {_sel(cols, {dc: f'coalesce({dc}, {AS_OF})'})} FROM {src}")
        else:
            ctes.append((f"{p}_cd_{dc}", f"SELECT cycle_id AS g_id, quantile_cont(epoch_us({dc}), 0.5) AS gm "
                                         f"FROM {src} WHERE cycle_id IS NOT NULL GROUP BY cycle_id"))
            add(f"{p}_da_{dc}", f"SELECT {_sel(cols, {dc: f'coalesce(s.{dc}, {_ts_from_us('g.gm')})'}, 's.')} "
                                f"FROM {src} s LEFT JOIN {p}_cd_{dc} g ON s.cycle_id = g.g_id")
            ctes.append((f"{p}_gd_{dc}", f"SELECT quantile_cont(epoch_us({dc}), 0.5) AS m FROM {src}"))
            add(f"{p}_d_{dc}", f"SELECT {_sel(cols, {dc: f'coalesce(s.{dc}, {_ts_from_us('g.m')}, {AS_OF})'}, 's.')} "
                               f"FROM {src} s, {p}_gd_{dc} g")
    if stop_after == "c2":
        ctes.append((f"{prefix}_{tbl}", f"SELECT * FROM {src}"))
        return ctes
    check = [c for c in cfg.check_columns.get(tbl, []) if c in cols]
    if check:
        add(f"{p}_c3", f"SELECT {_sel(cols, {c: f'CASE WHEN {c} < 0 THEN -{c} ELSE {c} END' for c in check})} FROM {src}")
    if stop_after == "c3":
        ctes.append((f"{prefix}_{tbl}", f"SELECT * FROM {src}"))
        return ctes
    zero = [c for c in check if c in cfg.zero_fix_columns]
    if zero:
        ctes.append((f"{p}_z", "SELECT " + ", ".join(f"min({c}) FILTER (WHERE {c} > 0) AS z_{c}" for c in zero)
                     + f" FROM {src}"))
        repl = {c: f"CASE WHEN s.{c} = 0 THEN coalesce(z.z_{c}, s.{c}) ELSE s.{c} END" for c in zero}
        add(f"{p}_c4", f"SELECT {_sel(cols, repl, 's.')} FROM {src} s, {p}_z z")
    if stop_after == "c4":
        ctes.append((f"{prefix}_{tbl}", f"SELECT * FROM {src}"))
        return ctes
    out = [c for c in cfg.outlier_columns.get(tbl, []) if c in cols]
    if out:
        qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in out)
        ctes.append((f"{p}_q", f"SELECT {qs} FROM {src}"))
        fences = ", ".join(
            f"q1_{c} - {IQR_FACTOR} * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + {IQR_FACTOR} * (q3_{c} - q1_{c}) AS hi_{c}"
            for c in out)
        ctes.append((f"{p}_f", f"SELECT {fences} FROM {p}_q"))
        repl = {c: f"CASE WHEN s.{c} < f.lo_{c} THEN f.lo_{c} WHEN s.{c} > f.hi_{c} THEN f.hi_{c} ELSE s.{c} END"
                for c in out}
        ctes.append((f"{p}_c5pre", f"SELECT * FROM {src}"))
        add(f"{p}_c5", f"SELECT {_sel(cols, repl, 's.')} FROM {src} s, {p}_f f")
    if imp:
        add(f"{p}_c6", f"SELECT {_sel(cols, {c: f'coalesce({c}, 0.0)' for c in imp})} FROM {src}")
    ctes.append((f"{prefix}_{tbl}", f"SELECT * FROM {src}"))
    return ctes


def coerce_ctes(cfg: PipelineConfig) -> list[tuple[str, str]]:
    out = []
    for tbl, cols in RAW_COLUMNS.items():
        dates = set(cfg.date_columns.get(tbl, []))
        nans = NAN_COLUMNS.get(tbl, [])
        sel = ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" if c in dates
                        else f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" if c in nans else c for c in cols)
        out.append((f"t_{tbl}", f"SELECT {sel} FROM raw_{tbl}"))
    return out


def main_ctes(cfg: PipelineConfig, src: str = "k") -> list[tuple[str, str]]:
    params = cfg.water_params
    w = ", ".join(f"avg({p}) AS {p}_mean, CAST(min({p}) AS DOUBLE) AS {p}_min, CAST(max({p}) AS DOUBLE) AS {p}_max, "
                  f"stddev_samp({p}) AS {p}_std" for p in params)
    wcols = ", ".join(f"w.{p}_{s}" for p in params for s in ("mean", "min", "max", "std"))
    return [
        ("h_agg", f"SELECT cycle_id, coalesce(sum(CAST(weight AS DOUBLE)), 0.0) AS weight, avg(size) AS size, "
                  f"max(harvested_at) AS harvested_at FROM {src}_harvests WHERE cycle_id IS NOT NULL GROUP BY cycle_id"),
        ("s_agg", "SELECT cycle_id, arg_max(average_weight, (sampled_at, l_linenumber, l_partkey, l_suppkey)) "
                  "FILTER (WHERE average_weight IS NOT NULL) AS average_weight, max(sampled_at) AS last_sampled_at "
                  f"FROM {src}_sampling WHERE cycle_id IS NOT NULL GROUP BY cycle_id"),
        ("f_agg", f"SELECT cycle_id, coalesce(sum(CAST(quantity AS DOUBLE)), 0.0) AS total_feed FROM {src}_feeds "
                  "WHERE cycle_id IS NOT NULL GROUP BY cycle_id"),
        ("w_agg", f"SELECT cycle_id, {w} FROM {src}_measurements WHERE cycle_id IS NOT NULL GROUP BY cycle_id"),
        ("pf", "SELECT p.id AS id_pond, p.farm_id, p.length, p.width, p.deep, "
               "p.length * p.width * p.deep AS pond_volume, "
               "(p.length * p.width) / nullif(p.length * p.width * p.deep, 0) AS surface_to_volume_ratio, "
               f"f.id AS id_farm, f.name FROM {src}_ponds p LEFT JOIN t_farms f ON p.farm_id = f.id"),
        ("main0", "SELECT c.id, c.pond_id, c.total_seed, c.area, c.started_at, c.finished_at, "
                  f"CAST(floor((epoch_us(coalesce(c.finished_at, {AS_OF})) - epoch_us(c.started_at)) / {DAY_US}) AS BIGINT) "
                  "AS culture_duration, "
                  "c.total_seed / nullif(c.area, 0) AS stocking_density, "
                  "month(c.started_at) AS start_month, quarter(c.started_at) AS start_quarter, "
                  "CASE WHEN month(c.started_at) >= 10 OR month(c.started_at) <= 3 THEN 'Hujan' ELSE 'Kemarau' END AS season, "
                  "h.weight, h.size, h.harvested_at, "
                  "s.average_weight, s.last_sampled_at, "
                  f"CAST(floor((epoch_us(s.last_sampled_at) - epoch_us(c.started_at)) / {DAY_US}) AS BIGINT) AS days_from_start, "
                  f"fa.total_feed, {wcols}, "
                  "pf.id_pond, pf.farm_id, pf.length, pf.width, pf.deep, pf.pond_volume, pf.surface_to_volume_ratio, "
                  "pf.id_farm, pf.name "
                  "FROM k_cycles c LEFT JOIN h_agg h ON c.id = h.cycle_id LEFT JOIN s_agg s ON c.id = s.cycle_id "
                  "LEFT JOIN f_agg fa ON c.id = fa.cycle_id LEFT JOIN w_agg w ON c.id = w.cycle_id "
                  "LEFT JOIN pf ON c.pond_id = pf.id_pond"),
        ("main1", "SELECT *, 1000.0 / nullif(size, 0) AS abw_harvest, "
                  "average_weight / nullif(CAST(days_from_start AS DOUBLE), 0) AS adg, "
                  "total_feed / nullif(weight, 0) AS fcr, "
                  "abs(morning_temperature_mean - evening_temperature_mean) AS temp_daily_fluctuation FROM main0"),
        ("main2", "SELECT *, (weight * 1000.0) / nullif(abw_harvest, 0) AS harvested_count FROM main1"),
        ("main", "SELECT *, harvested_count / nullif(total_seed, 0) * 100.0 AS survival_rate FROM main2"),
    ]


def base_ctes(cfg: PipelineConfig | None = None) -> list[tuple[str, str]]:
    cfg = cfg or PipelineConfig()
    ctes = [(n, s) for n, s in RAW_VIEWS.items()]
    ctes += coerce_ctes(cfg)
    for tbl in RAW_COLUMNS:
        ctes += clean_ctes(tbl, cfg)
    ctes += main_ctes(cfg)
    return ctes


def with_clause(extra: list[tuple[str, str]] | None = None, cfg: PipelineConfig | None = None) -> str:
    ctes = base_ctes(cfg) + list(extra or [])
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes)


def wrap(spec: list[tuple[str, str]], inner: str) -> str:
    """Final projection matching ``finalize`` on the Spark side."""
    sel = []
    for c, kind in spec:
        if kind in ("d", "r"):
            x, half = f'CAST("{c}" AS DOUBLE)', HALF if kind == "d" else HALF_WITH_MARGIN
            sel.append(f'CASE WHEN abs({x}) < 9e12 THEN floor({x} * 1e6 + {half}) / 1e6 ELSE {x} END + 0.0 AS "{c}"')
        elif kind == "i":
            sel.append(f'CAST("{c}" AS BIGINT) AS "{c}"')
        elif kind == "t":
            sel.append(f'strftime("{c}", \'%Y-%m-%d %H:%M:%S\') AS "{c}"')
        elif kind == "b":
            sel.append(f'CAST("{c}" AS BOOLEAN) AS "{c}"')
        else:
            sel.append(f'CAST("{c}" AS VARCHAR) AS "{c}"')
    return f"SELECT {', '.join(sel)} FROM ({inner}) q"
