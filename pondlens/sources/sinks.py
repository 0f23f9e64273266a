"""Sinks (S4, S8): write result tables as Parquet (default) or CSV.

Writes go through Spark's committer, so a retried or lost task never leaves a
partial file behind; ``overwrite`` makes a rerun of a stage idempotent.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

# CSV text keeps the microseconds that timestamps have
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Rows of a file of compressed text, which is read by one task.
ROWS_PER_FILE = 200_000


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                compression: str | None = None) -> str:
    """``df`` written to ``path``; ``compression`` is for CSV text."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        if compression:
            w = w.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
        w.option("header", True).option("timestampFormat", CSV_TIMESTAMP).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_processed(main: DataFrame, tables: dict, out_dir: str, fmt: str = "parquet", compression: str | None = None) -> dict[str, str]:
    """``main_dataset`` plus ``{name}_processed`` for every present table."""
    out = {"main_dataset": write_table(main, os.path.join(out_dir, "main_dataset"), fmt, compression=compression)}
    for name, df in tables.items():
        if df is not None:
            out[name] = write_table(df, os.path.join(out_dir, f"{name}_processed"), fmt, compression=compression)
    return out
