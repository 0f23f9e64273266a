"""Table catalog: load the pond tables from CSV or Parquet into a dict.

A missing file gives ``None`` for that table, and every later stage skips
tables (and columns) that are absent, as the reference does. Loading is lazy:
only the schema is resolved here, no rows are read.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pondlens.config import CSV_FILES, CSV_SCHEMAS, TABLE_NAMES

Catalog = dict  # name -> DataFrame | None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its file system (the default one if it names none)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map float NaN to NULL (pandas treats NaN as missing; Spark does not)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """CSV with header and an explicit schema; ``None`` if the file is missing.

    Columns not in the schema are read as strings and pass through.
    """
    if not path_exists(spark, path):
        return None
    if schema is None:
        return spark.read.option("header", True).csv(path)
    header = spark.read.option("header", True).csv(path).schema
    known = {f.name: f for f in schema.fields}
    fields = [known.get(f.name, T.StructField(f.name, T.StringType(), True)) for f in header.fields]
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE")
          .option("enforceSchema", False).schema(T.StructType(fields)).csv(path))
    return nan_to_null(df)


def load_csv_catalog(spark: SparkSession, data_dir: str) -> Catalog:
    """The ten pond tables from ``data_dir`` (missing ones are ``None``)."""
    return {name: load_csv(spark, os.path.join(data_dir, CSV_FILES[name]), CSV_SCHEMAS[name])
            for name in TABLE_NAMES}


def load_parquet_catalog(spark: SparkSession, data_dir: str, names=TABLE_NAMES) -> Catalog:
    """The same catalog written as Parquet (``{name}.parquet`` per table)."""
    out = {}
    for name in names:
        path = os.path.join(data_dir, f"{name}.parquet")
        out[name] = nan_to_null(spark.read.parquet(path)) if path_exists(spark, path) else None
    return out


def table_shapes(catalog: Catalog) -> DataFrame | None:
    """S2 report: one row per loaded table with its row and column count.

    The counts of all tables are computed in a single job (one union of
    per-table aggregates), not one driver round trip per table.
    """
    parts = []
    for name, df in catalog.items():
        if df is None:
            continue
        parts.append(df.select(F.lit(name).alias("dataset"))
                     .groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))
                     .withColumn("n_columns", F.lit(len(df.columns)).cast("bigint")))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def parse_dates_fallback(df: DataFrame, columns: list[str],
                         formats=("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
                                  "yyyy-MM-dd")) -> DataFrame:
    """S3: re-parse date text written by the CSV sink: ISO-8601 first, then
    ``yyyy-MM-dd``, then other layouts; per row (the first format that fits
    wins), unparseable text becomes NULL."""
    out = []
    for f in df.schema.fields:
        if f.name in columns and isinstance(f.dataType, T.StringType):
            parsed = [F.try_to_timestamp(F.col(f.name), F.lit(fmt)) for fmt in formats]
            out.append(F.coalesce(*parsed, F.try_to_timestamp(F.col(f.name))).cast("timestamp").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


ISO_LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
               "yyyy-MM-dd")
# Layouts of a whole column in order of preference; each is a tuple of patterns.
COLUMN_LAYOUTS = (ISO_LAYOUTS, ("yyyy-MM-dd",), ("MM/dd/yyyy[ HH:mm:ss]",), ("dd/MM/yyyy[ HH:mm:ss]",), ("dd-MM-yyyy[ HH:mm:ss]",),
                  ("yyyy/MM/dd[ HH:mm:ss]",))


_FIELDS = {"yyyy": ".{4,}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "HH": "[0-9]{2}", "mm": "[0-9]{2}", "ss": "[0-9]{2}", "'T'": "[Tt]"}


def layout_shape(pattern: str) -> str | None:
    """A regular expression that every text of the layout matches (others may, too); ``None`` if a field is not known here."""
    must, at, out = re.sub(r"\[[^\]]*\]", "", pattern), 0, "^"
    while at < len(must):
        field = next((f for f in _FIELDS if must.startswith(f, at)), None)
        if field is None and (must[at].isalpha() or must[at] in "'[]#{}"):
            return None
        out += _FIELDS[field] if field else re.escape(must[at])
        at += len(field or must[at])
    return out if "[" in pattern else out + "$"


def _try_layout(column: str, pattern: str) -> F.Column:
    """The text by one pattern. A failing parse costs an exception, many times a parse, so texts of another shape are not tried."""
    shape, parsed = layout_shape(pattern), F.try_to_timestamp(F.col(column), F.lit(pattern))
    return parsed if shape is None else F.when(F.col(column).rlike(shape), parsed)


def _parsed(column: str, layout: tuple[str, ...]) -> F.Column:
    return F.coalesce(*[_try_layout(column, p) for p in layout])


def choose_layouts(df: DataFrame, columns: list[str], layouts=COLUMN_LAYOUTS) -> dict[str, list[int]]:
    """For each column the order in which to try ``layouts``: first the one that fails for the fewest of its texts
    (the earlier one of equals), then the others as given. One aggregate counts all failures."""
    failed = [F.count_if(F.col(c).isNotNull() & _parsed(c, p).isNull()).alias(f"{k}_{i}")
              for k, c in enumerate(columns) for i, p in enumerate(layouts)]
    row = df.agg(*failed).first() if failed else None
    order = {}
    for k, c in enumerate(columns):
        best = min(range(len(layouts)), key=lambda i: (row[f"{k}_{i}"], i))
        order[c] = [best, *[i for i in range(len(layouts)) if i != best]]
    return order


def parse_dates_by_column(df: DataFrame, columns: list[str], layouts=COLUMN_LAYOUTS) -> DataFrame:
    """S3: re-parse date text with one layout for the whole column, so that ``03/04/2024`` means the same in every row of it.

    The rows that do not fit the column's layout fall through to the others
    and then to Spark's own parser; what fits none becomes NULL.
    """
    text = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, T.StringType)]
    order = choose_layouts(df, text, layouts)
    return df.select(*[
        F.coalesce(*[_parsed(c, layouts[i]) for i in order[c]], F.try_to_timestamp(F.col(c))).cast("timestamp").alias(c)
        if c in order else F.col(c) for c in df.columns])


# Column types of the main table written as CSV; every other column is a double.
MAIN_DATES = ("started_at", "finished_at", "harvested_at", "last_sampled_at")
MAIN_TEXT = ("season", "name")
MAIN_INTEGERS = ("id", "pond_id", "id_pond", "farm_id", "id_farm", "culture_duration", "days_from_start", "start_month",
                 "start_quarter")


def load_processed(spark: SparkSession, path: str, date_columns=MAIN_DATES, fmt: str = "parquet") -> DataFrame | None:
    """S3: reload the processed main table (Parquet keeps types; CSV text is typed again)."""
    if not path_exists(spark, path):
        return None
    if fmt != "csv":
        return nan_to_null(spark.read.parquet(path))
    df = parse_dates_by_column(spark.read.option("header", True).csv(path), list(date_columns))
    text = [c for c in df.columns if c in date_columns or c in MAIN_TEXT]
    return nan_to_null(df.select(*[F.col(c) if c in text else F.expr(
        f"try_cast(`{c}` AS {'bigint' if c in MAIN_INTEGERS else 'double'})").alias(c) for c in df.columns]))
