"""Cleaning (T1, C1-C6) in the reference's fixed order.

Each phase that feeds a statistic back into the rows (median, smallest
positive value, quartiles) runs one distributed aggregate - batched across
all tables in ``clean_catalog`` - and brings back only ``columns x stats``
numbers, which are then inlined as literals. The cleaned table stays a plain projection over the source scan, so
filters and column pruning still reach Parquet. The per-cycle date median
(C2c) is a grouped exact quantile joined back on ``cycle_id`` - it replaces a
Python loop over cycles.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pondlens.config import IQR_FACTOR, PipelineConfig
from pondlens.functions.exprs import ts_literal
from pondlens.operators.quantiles import column_quantiles, quantile_table, quantile_values

# ---------------------------------------------------------------- T1 --------

def coerce_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns become TIMESTAMP; unparseable text becomes NULL."""
    out = []
    for f in df.schema.fields:
        if f.name in columns:
            if isinstance(f.dataType, T.StringType):
                out.append(F.try_to_timestamp(F.col(f.name)).cast("timestamp").alias(f.name))
            else:
                out.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def coerce_catalog(catalog: dict, cfg: PipelineConfig | None = None) -> dict:
    cfg = cfg or PipelineConfig()
    return {name: (None if df is None else coerce_dates(df, cfg.date_columns.get(name, [])))
            for name, df in catalog.items()}


# ---------------------------------------------------------------- C1 --------

def impute_numeric(df: DataFrame, methods: dict[str, str]) -> tuple[DataFrame, dict[str, float | None]]:
    """C1 + C1b: fill NULLs with the column median (or mean); an all-NULL column gets 0."""
    cols = [c for c in methods if c in df.columns]
    med_cols = [c for c in cols if methods[c] == "median"]
    mean_cols = [c for c in cols if methods[c] == "mean"]
    values: dict[str, float | None] = {}
    if med_cols:
        q = quantile_values(df, med_cols, [0.5])
        values.update({c: q[(c, 0.5)] for c in med_cols})
    if mean_cols:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in mean_cols]).first()
        values.update({c: row[c] for c in mean_cols})
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(values[c] if values[c] is not None else 0.0))
             for c in cols}
    return _replace(df, fills), values


# ---------------------------------------------------------------- C2 --------

def _micros_to_ts(x) -> F.Column:
    return F.timestamp_micros(F.floor(x).cast("bigint"))


def impute_date_global(df: DataFrame, column: str, median_micros: float | None = None) -> DataFrame:
    """Fill with the median of the non-NULL values of the whole column."""
    if median_micros is None:
        median_micros = quantile_values(df.select(F.unix_micros(F.col(column)).alias("m")), ["m"], [0.5])[("m", 0.5)]
    if median_micros is None:
        return df
    return _replace(df, {column: F.coalesce(F.col(column), _micros_to_ts(F.lit(median_micros)))})


def impute_open_end(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """An open cycle ends at the fixed ``as_of`` clock."""
    return _replace(df, {column: F.coalesce(F.col(column), ts_literal(as_of))})


def impute_date_by_group(df: DataFrame, column: str, as_of: str, group: str = "cycle_id") -> DataFrame:
    """Median of the column within the group, then the global median of
    the result, then ``as_of``.

    The group medians are an exact grouped quantile (no group is gathered in
    one task), left-joined back on the group key; NULL keys never match.
    """
    filled = _group_date_fill(df, column, group)
    glob = quantile_values(filled.select(F.unix_micros(F.col(column)).alias("m")), ["m"], [0.5])[("m", 0.5)]
    fallback = _micros_to_ts(F.lit(glob)) if glob is not None else ts_literal(as_of)
    return _replace(filled, {column: F.coalesce(F.col(column), fallback)})


# ---------------------------------------------------------------- C3-C5 -----

def fix_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Negative values become their absolute value."""
    cols = [c for c in columns if c in df.columns]
    return _replace(df, {c: F.when(F.col(c) < 0, -F.col(c)).otherwise(F.col(c)) for c in cols})


def fix_zero(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, float | None]]:
    """C4: zeros become the smallest positive value of the column (if any)."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df, {}
    row = df.agg(*[F.min(F.when(F.col(c) > 0, F.col(c))).alias(c) for c in cols]).first()
    mins = {c: row[c] for c in cols}
    fills = {c: F.when(F.col(c) == 0, F.lit(mins[c])).otherwise(F.col(c))
             for c in cols if mins[c] is not None}
    return _replace(df, fills), mins


def iqr_bounds(df: DataFrame, columns: list[str], factor: float = IQR_FACTOR) -> dict[str, tuple[float, float]]:
    """Tukey fences from exact quartiles: (Q1 - k IQR, Q3 + k IQR)."""
    cols = [c for c in columns if c in df.columns]
    q = quantile_values(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None or q3 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1 - factor * iqr, q3 + factor * iqr)
    return out


def iqr_cap(df: DataFrame, columns: list[str], bounds: dict | None = None) -> tuple[DataFrame, dict]:
    """Cap values outside the fences to the fence; NULL stays NULL."""
    bounds = bounds if bounds is not None else iqr_bounds(df, columns)
    fills = {}
    for c, (lo, hi) in bounds.items():
        fills[c] = (F.when(F.col(c) < F.lit(lo), F.lit(lo))
                    .when(F.col(c) > F.lit(hi), F.lit(hi)).otherwise(F.col(c)))
    return _replace(df, fills), bounds


def iqr_outliers(df: DataFrame, name: str, bounds: dict) -> DataFrame | None:
    """Per column, the outlier count, fences and min/max outlier (count > 0 only)."""
    if not bounds:
        return None
    aggs = []
    for c, (lo, hi) in bounds.items():
        is_out = (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count_if(is_out).cast("bigint").alias("count"),
            F.lit(float(lo)).alias("lower_bound"), F.lit(float(hi)).alias("upper_bound"),
            F.min(F.when(is_out, F.col(c))).cast("double").alias("min_outlier"),
            F.max(F.when(is_out, F.col(c))).cast("double").alias("max_outlier")).alias(c))
    wide = df.agg(*aggs)
    long = wide.select(F.explode(F.array(*[F.col(c) for c in bounds])).alias("s")).select("s.*")
    return long.where(F.col("count") > 0).select(F.lit(name).alias("dataset"), "*")


# ---------------------------------------------------------------- chain -----

def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    if not exprs:
        return df
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def _quantiles(items: list[tuple[str, DataFrame, F.Column]], probs: list[float]) -> dict:
    """Exact quantiles of many (key, table, expression) slices, batched.

    Slices of the same table share its scans.
    """
    groups: dict[int, tuple[DataFrame, dict[str, F.Column]]] = {}
    for key, df, expr in items:
        groups.setdefault(id(df), (df, {}))[1][key] = expr
    return column_quantiles(list(groups.values()), probs)


def clean_catalog(catalog: dict, cfg: PipelineConfig | None = None, reports: dict | None = None) -> dict:
    """The whole ``handle_missing_data`` stage over a coerced catalog.

    C1 -> C2 -> C3 -> C4 -> C5 -> C6 for every table; the statistics of all tables
    are batched: one computation for every C1 median, one scan of each table for C1
    means, C2 NULL checks and C4 inputs (smallest positive |v|, NULL count), one for the C2 global date
    medians (only tables with missing dates), one for every C5 quartile.
    """
    cfg = cfg or PipelineConfig()
    tabs = {n: df for n, df in catalog.items() if df is not None}
    reps = {n: {} for n in tabs}

    # job 1: C1 medians/means + NULL counts of date columns + cycles.started_at median
    q_items, stats = [], {}
    methods = {n: {c: m for c, m in cfg.impute_columns.get(n, {}).items() if c in df.columns}
               for n, df in tabs.items()}
    dcols = {n: [c for c in cfg.date_columns.get(n, []) if c in df.columns] for n, df in tabs.items()}
    for n, df in tabs.items():
        q_items += [(f"{n}|{c}", df, F.col(c)) for c, m in methods[n].items() if m == "median"]
        # one scan of a table for its means, C4 inputs and counts of missing dates
        aggs = {(c, -2.0): F.avg(F.col(c).cast("double")) for c, m in methods[n].items() if m == "mean"}
        for c in cfg.check_columns.get(n, []):
            if c in df.columns and c in cfg.zero_fix_columns:
                # C4 inputs from the raw column: smallest positive |v| and NULL count
                # (after C1 + C3 the smallest positive value follows from these and
                # the C1 fill value, so C4 needs no scan of its own)
                a = F.abs(F.col(c).cast("double"))
                aggs[(f"{c}__minabs", -4.0)] = F.min(F.when(a > 0, a))
                aggs[(f"{c}__nulls", -4.0)] = F.count_if(F.col(c).isNull()).cast("double")
        aggs |= {(c, -1.0): F.count_if(F.col(c).isNull()).cast("double") for c in dcols[n]}
        if aggs:
            row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs.values())]).first()
            stats |= {(f"{n}|{c}", kind): x for (c, kind), x in zip(aggs, row)}
        if n == "cycles" and "started_at" in dcols[n]:
            q_items.append(("cycles|started_at@us", df, F.unix_micros(F.col("started_at"))))
    stats.update(_quantiles(q_items, [0.5]))

    # C1 (+ C1b fallback 0)
    for n, df in list(tabs.items()):
        vals = {c: stats.get((f"{n}|{c}", 0.5 if m == "median" else -2.0)) for c, m in methods[n].items()}
        reps[n]["impute"] = vals
        tabs[n] = _replace(df, {c: F.coalesce(F.col(c).cast("double"), F.lit(v if v is not None else 0.0))
                                for c, v in vals.items()})

    # Dates (per-cycle medians are lazy joins; their global fallbacks batch below).
    # C2 changes only date columns and C3-C5 only numeric ones, so the numeric
    # statistics below are taken on ``numeric`` (no date fill in their plans).
    numeric = dict(tabs)
    def fill_dates(n: str) -> tuple[DataFrame, list[tuple[str, str]]]:
        """A table with its dates filled, and the columns whose rest takes a global median."""
        df, rest = tabs[n], []
        for c in dcols[n]:
            if not stats.get((f"{n}|{c}", -1.0)):
                continue
            if n == "cycles" and c == "started_at":
                med = stats.get(("cycles|started_at@us", 0.5))
                if med is not None:
                    df = _replace(df, {c: F.coalesce(F.col(c), _micros_to_ts(F.lit(med)))})
            elif n == "cycles" and c == "finished_at":
                df = impute_open_end(df, c, cfg.as_of)
            else:
                df = _group_date_fill(df, c) if "cycle_id" in df.columns else df
                rest.append((n, c))
        return df, rest

    # the tables' group medians are independent jobs
    with ThreadPoolExecutor(4) as pool:
        filled = dict(zip(tabs, pool.map(fill_dates, tabs)))
    pending = [x for _, rest in filled.values() for x in rest]
    tabs = {n: df for n, (df, _) in filled.items()}

    # C3 and job 2: global date medians of pending columns + C4 minimum positive values
    check = {n: [c for c in cfg.check_columns.get(n, []) if c in df.columns] for n, df in tabs.items()}
    for n in tabs:
        tabs[n] = fix_negative(tabs[n], check[n])
        numeric[n] = fix_negative(numeric[n], check[n])
    zero = {n: [c for c in check[n] if c in cfg.zero_fix_columns] for n in tabs}
    dq = [(f"{n}|{c}@us", tabs[n], F.unix_micros(F.col(c))) for n, c in pending]
    stats2 = _quantiles(dq, [0.5])
    for n, c in pending:
        g = stats2.get((f"{n}|{c}@us", 0.5))
        fallback = _micros_to_ts(F.lit(g)) if g is not None else ts_literal(cfg.as_of)
        tabs[n] = _replace(tabs[n], {c: F.coalesce(F.col(c), fallback)})
    for n, cols in zero.items():
        mins = {}
        for c in cols:
            cands = [stats.get((f"{n}|{c}__minabs", -4.0))]
            if stats.get((f"{n}|{c}__nulls", -4.0)) and c in reps[n]["impute"]:
                fill = reps[n]["impute"][c]
                cands.append(abs(fill if fill is not None else 0.0))
            cands = [v for v in cands if v is not None and v > 0]
            mins[c] = min(cands) if cands else None
        reps[n]["min_positive"] = mins
        fills = {c: F.when(F.col(c) == 0, F.lit(m)).otherwise(F.col(c)) for c, m in mins.items() if m is not None}
        tabs[n] = _replace(tabs[n], fills)
        numeric[n] = _replace(numeric[n], fills)

    # job 3: C5 quartiles of every outlier column
    ocols = {n: [c for c in cfg.outlier_columns.get(n, []) if c in tabs[n].columns] for n in tabs}
    qi = [(f"{n}|{c}", numeric[n], F.col(c)) for n, cols in ocols.items() for c in cols]
    stats3 = _quantiles(qi, [0.25, 0.75])
    for n, cols in ocols.items():
        if not cols:
            continue
        bounds = {}
        for c in cols:
            q1, q3 = stats3.get((f"{n}|{c}", 0.25)), stats3.get((f"{n}|{c}", 0.75))
            if q1 is None or q3 is None:
                continue
            iqr = q3 - q1
            bounds[c] = (q1 - IQR_FACTOR * iqr, q3 + IQR_FACTOR * iqr)
        reps[n]["iqr_bounds"] = bounds
        reps[n]["iqr_input"] = numeric[n]
        tabs[n], _ = iqr_cap(tabs[n], cols, bounds)

    # C6
    for n in tabs:
        tabs[n] = _replace(tabs[n], {c: F.coalesce(F.col(c), F.lit(0.0)) for c in methods[n]})
    if reports is not None:
        reports.update(reps)
    return {n: tabs.get(n) for n in catalog}


class CleanedTables(Mapping):
    """The cleaned catalog, each table cleaned when it is first read.

    No statistic of one table enters another, so a query pays for the tables
    it reads only. ``load`` cleans several at once; iterating over the items
    cleans all. ``reports`` holds the statistics of the tables cleaned so far.
    """

    def __init__(self, coerced: dict, cfg: PipelineConfig | None = None):
        self.coerced, self.cfg = coerced, cfg
        self.reports: dict[str, dict] = {}
        self._done: dict[str, DataFrame | None] = {}

    def load(self, names=None) -> "CleanedTables":
        todo = [n for n in (self.coerced if names is None else names) if n in self.coerced and n not in self._done]

        def one(name: str) -> tuple[dict, dict]:
            reports: dict = {}
            return clean_catalog({name: self.coerced[name]}, self.cfg, reports), reports

        # the tables' statistics are independent jobs
        with ThreadPoolExecutor(4) as pool:
            for tables, reports in pool.map(one, todo):
                self._done.update(tables)
                self.reports.update(reports)
        return self

    def __getitem__(self, name: str) -> DataFrame | None:
        if name not in self._done:
            if name not in self.coerced:
                raise KeyError(name)
            self.load([name])
        return self._done[name]

    def __iter__(self):
        return iter(self.coerced)

    def __len__(self) -> int:
        return len(self.coerced)

    def items(self):
        return self.load()._done_in_order().items()

    def values(self):
        return self.load()._done_in_order().values()

    def _done_in_order(self) -> dict:
        return {n: self._done[n] for n in self.coerced}


def _group_date_fill(df: DataFrame, column: str, group: str = "cycle_id") -> DataFrame:
    """C2c first level: NULL dates take the exact median of their group.

    Only rows with a NULL date go through the join, and group medians are
    computed only for groups that have a NULL date (semi join), so the usual
    case - few missing dates - costs a small fraction of the table, and rows
    with a date pass straight through.
    """
    has = df.where(F.col(column).isNotNull())
    missing = df.where(F.col(column).isNull())
    need = missing.select(F.col(group).alias("__g")).where(F.col("__g").isNotNull()).distinct()
    m = (has.select(F.col(group).alias("__g"), F.unix_micros(F.col(column)).alias("__m"))
         .join(need, "__g", "left_semi"))
    # ends in an aggregate keyed by the join key: when a query does not read
    # the date, Spark's outer-join elimination drops this whole subplan
    gmed = (quantile_table(m, ["__m"], [0.5], by=["__g"])
            .groupBy("__g").agg(F.max("value").alias("__gm")))
    filled = missing.join(gmed, missing[group] == gmed["__g"], "left")
    filled = _replace(filled, {column: _micros_to_ts(F.col("__gm"))}).drop("__g", "__gm")
    return has.unionByName(filled.select(*df.columns))
