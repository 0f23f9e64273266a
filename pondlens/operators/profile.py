"""Profiling (P1-P9): data-quality counts as result tables, not printouts.

Every table is scanned once for all its missing / negative / zero /
invalid-date counts: one aggregate with ``count_if`` per (check, column),
then ``unpivot`` into long form. Foreign-key checks are ``left_anti`` joins
over the distinct keys (each side deduplicated before the shuffle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pondlens.config import PipelineConfig, ZERO_REPORT_EXEMPT
from pondlens.operators.quantiles import column_quantiles

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def _union(parts: list[DataFrame]) -> DataFrame | None:
    parts = [p for p in parts if p is not None]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _check_counts(name: str, df: DataFrame, checks: list[tuple[str, str, F.Column]]) -> DataFrame:
    """One scan of ``df``: ``checks`` are (issue, column, boolean predicate).

    Returns ``dataset, column, issue, count, n_rows``.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(pred).alias(f"{i}|{c}") for i, c, pred in checks]
    wide = df.agg(*aggs)
    if not checks:
        return None
    long = wide.unpivot(["__rows"], [f"{i}|{c}" for i, c, _ in checks], "key", "count")
    return long.select(
        F.lit(name).alias("dataset"),
        F.split_part("key", F.lit("|"), F.lit(2)).alias("column"),
        F.split_part("key", F.lit("|"), F.lit(1)).alias("issue"),
        F.col("count").cast("bigint").alias("count"),
        F.col("__rows").cast("bigint").alias("n_rows"))


def _table_checks(name: str, df: DataFrame, cfg: PipelineConfig, missing=True, negative=True,
                  zero=True, dates=True) -> list[tuple[str, str, F.Column]]:
    checks = []
    cols = set(df.columns)
    numeric = set(numeric_columns(df))
    if missing:
        checks += [("missing_values", c, F.col(c).isNull()) for c in df.columns]
    for c in cfg.check_columns.get(name, []):
        if c in cols and c in numeric:
            if negative:
                checks.append(("negative_values", c, F.col(c) < 0))
            if zero and c not in ZERO_REPORT_EXEMPT:
                checks.append(("zero_values", c, F.col(c) == 0))
    if dates:
        checks += [("invalid_dates", c, F.col(c).isNull()) for c in cfg.date_columns.get(name, []) if c in cols]
    return checks


def _issue_rows(catalog: dict, cfg: PipelineConfig, **kinds) -> DataFrame | None:
    parts = []
    for name, df in catalog.items():
        if df is None:
            continue
        checks = _table_checks(name, df, cfg, **kinds)
        if checks:
            parts.append(_check_counts(name, df, checks))
    return _union(parts)


def missing_profile(catalog: dict, cfg: PipelineConfig | None = None) -> DataFrame | None:
    """Columns with at least one NULL: count and percent of rows."""
    cfg = cfg or PipelineConfig()
    rows = _issue_rows(catalog, cfg, missing=True, negative=False, zero=False, dates=False)
    if rows is None:
        return None
    return (rows.where(F.col("count") > 0)
            .select("dataset", "column", "count",
                    (F.col("count") / F.col("n_rows") * 100.0).alias("percentage")))


def value_checks(catalog: dict, cfg: PipelineConfig | None = None, issue: str = "negative_values") -> DataFrame | None:
    """Negative, zero (not for ``average_weight``) or invalid-date counts > 0."""
    cfg = cfg or PipelineConfig()
    kinds = dict(missing=False, negative=issue == "negative_values",
                 zero=issue == "zero_values", dates=issue == "invalid_dates")
    rows = _issue_rows(catalog, cfg, **kinds)
    if rows is None:
        return None
    return rows.where(F.col("count") > 0).select("dataset", "column", "count")


def fk_violations(catalog: dict, cfg: PipelineConfig | None = None) -> DataFrame | None:
    """Distinct non-NULL child keys absent from the parent key set.

    All children of a parent share one anti join: their distinct (relation,
    key) pairs are united first.
    """
    cfg = cfg or PipelineConfig()
    children: dict[tuple[str, str], list[DataFrame]] = {}
    for child, ck, parent, pk, label in cfg.foreign_keys:
        c, p = catalog.get(child), catalog.get(parent)
        if c is None or p is None or ck not in c.columns or pk not in p.columns:
            continue
        keys = c.select(F.lit(label).alias("relation"), F.col(ck).cast(p.schema[pk].dataType).alias("k"))
        children.setdefault((parent, pk), []).append(keys.where(F.col("k").isNotNull()))
    parts = []
    for (parent, pk), keys in children.items():
        pairs = _union(keys).distinct()
        parts.append(pairs.join(catalog[parent].select(F.col(pk).alias("k")), "k", "left_anti"))
    out = _union(parts)
    return None if out is None else out.groupBy("relation").agg(F.count(F.lit(1)).alias("count"))


def dq_issues(catalog: dict, cfg: PipelineConfig | None = None) -> DataFrame:
    """The whole issue report (P3-P7) in the reference's long format."""
    cfg = cfg or PipelineConfig()
    rows = _issue_rows(catalog, cfg)
    parts = []
    if rows is not None:
        rows = rows.where(F.col("count") > 0)
        parts.append(rows.select(
            "dataset", "column", F.lit(None).cast("string").alias("relation"), "issue", "count",
            F.when(F.col("issue") == "missing_values", F.col("count") / F.col("n_rows") * 100.0)
             .cast("double").alias("percentage")))
    fk = fk_violations(catalog, cfg)
    if fk is not None:
        parts.append(fk.select(
            F.lit(None).cast("string").alias("dataset"), F.lit(None).cast("string").alias("column"),
            "relation", F.lit("invalid_foreign_key").alias("issue"), "count",
            F.lit(None).cast("double").alias("percentage")))
    out = _union(parts)
    return out if out is not None else out


def null_totals(catalog: dict) -> DataFrame | None:
    """Remaining NULLs per column and per table (``column`` NULL = table total).

    One aggregate per table; its one row is unfolded into columns and total.
    """
    parts = []
    for name, df in catalog.items():
        if df is None:
            continue
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
        entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
        entries.append(F.struct(F.lit(None).cast("string").alias("column"), total.alias("missing")))
        parts.append(wide.select(F.explode(F.array(*entries)).alias("e"))
                     .select(F.lit(name).alias("dataset"), "e.column", F.col("e.missing").cast("bigint").alias("missing")))
    return _union(parts)


def describe_numeric(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, std (sample), min, 25/50/75 % (exact), max per numeric column."""
    return describe_catalog({name: df}, {name: columns} if columns else None)


def describe_catalog(catalog: dict, columns: dict | None = None) -> DataFrame | None:
    """P2 for many tables in one quantile computation: the first pass of the
    exact quantiles also yields count/min/max of every column, a plain
    aggregate of the whole columns their mean and std."""
    tables, spark, all_keys = [], None, []
    for name, df in catalog.items():
        if df is None:
            continue
        cols = (columns or {}).get(name) or numeric_columns(df)
        if not cols:
            continue
        spark = df.sparkSession
        all_keys += [f"{name}|{c}" for c in cols]
        tables.append((df, {f"{name}|{c}": F.col(f"`{c}`") for c in cols}))
    if not tables:
        return None
    mom: dict = {}
    q = column_quantiles(tables, [0.25, 0.5, 0.75], moments=mom)
    rows = []
    for key in all_keys:                  # an all-NULL column reports count 0
        m = mom.get(key, {"n": 0, "mean": None, "std": None, "lo": None, "hi": None})
        ds, col = key.split("|", 1)
        rows.append((ds, col, int(m["n"]), m["mean"], m["std"], m["lo"], q.get((key, 0.25)), q.get((key, 0.5)),
                     q.get((key, 0.75)), m["hi"]))
    return spark.createDataFrame(rows, "dataset string, column string, count bigint, mean double, std double, "
                                       "min double, q25 double, q50 double, q75 double, max double")


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; ordered (deterministic) when keys are given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and column counts by type class of a (main) table."""
    numeric = len(numeric_columns(df))
    dates = len([f for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))])
    cat = len([f for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(numeric).cast("bigint").alias("n_numeric"),
        F.lit(cat).cast("bigint").alias("n_categorical"),
        F.lit(dates).cast("bigint").alias("n_date"))
