"""Stage 1: load -> profile -> clean -> main table -> analysis -> write.

    python -m pondlens.plans.preprocess --data DIR --out DIR [--format csv|parquet] [--as-of TS]

Reads the ten pond tables (CSV with explicit schemas; missing files are
skipped), writes the issue report, the cleaned tables, the main table and
the analysis tables. Every step is a Spark job over the whole tables.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.config import KPI_COLUMNS, PipelineConfig
from pondlens.operators import analysis as AN
from pondlens.operators import clean as C
from pondlens.operators import features as FE
from pondlens.operators import profile as P
from pondlens.plans.stages import Stages
from pondlens.session import get_spark
from pondlens.sources.catalog import load_csv_catalog, load_parquet_catalog, table_shapes
from pondlens.sources.sinks import save_processed, write_table


def run(spark, data_dir: str, out_dir: str, fmt: str = "csv", as_of: str | None = None,
        out_format: str = "parquet") -> dict[str, str]:
    cfg = PipelineConfig() if as_of is None else replace(PipelineConfig(), as_of=as_of)
    raw = load_csv_catalog(spark, data_dir) if fmt == "csv" else load_parquet_catalog(spark, data_dir)
    st = Stages(spark, raw, cfg)
    outputs = {}

    def w(name, df):
        if df is not None:
            outputs[name] = write_table(df, os.path.join(out_dir, "reports", name), out_format)

    w("table_shapes", table_shapes({k: v for k, v in raw.items() if v is not None}))
    w("describe_numeric", P.describe_catalog(raw))
    w("dq_issues", P.dq_issues(st.coerced, cfg))
    cleaned = st.cleaned
    w("null_totals", P.null_totals(cleaned))
    outputs.update(save_processed(st.main, cleaned, os.path.join(out_dir, "processed"), out_format))
    main = st.main
    w("kpi_summary", AN.kpi_summary(main))
    w("corr_kpi", AN.corr_matrix(main, KPI_COLUMNS, "kpi"))
    if cleaned.get("measurements") is not None:
        w("corr_water", AN.corr_matrix(cleaned["measurements"], cfg.water_params, "water"))
    w("top_factors", AN.top_factors(main))
    w("box_stats", AN.box_stats(main.where(AN.sr_in_range()), "season", ["survival_rate", "adg"]))
    w("cycles_by_month", AN.cycles_by_month(cleaned["cycles"]))
    w("cycles_by_season", AN.cycles_by_season(main))
    w("schema_summary", P.schema_summary(main))
    w("histograms", AN.main_histograms(main))
    w("corr_filtered", AN.corr_pairs(main.where(AN.sr_density_valid()), [("stocking_density", "survival_rate")], "density_sr")
      .unionByName(AN.corr_pairs(main.where(AN.all_valid()), [("fcr", "survival_rate"), ("fcr", "adg")], "fcr")))
    w("trend_lines", AN.trend_lines(main.where(AN.sr_density_valid()), [("stocking_density", "survival_rate")], "density_sr")
      .unionByName(AN.trend_lines(main.where(AN.all_valid()), [("fcr", "survival_rate"), ("fcr", "adg")], "fcr")))
    outliers = [C.iqr_outliers(r["iqr_input"], n, r["iqr_bounds"]) for n, r in st.clean_reports.items() if r.get("iqr_bounds")]
    if outliers:
        w("iqr_outliers", reduce(DataFrame.unionByName, outliers))
    if cleaned.get("measurements") is not None:
        w("histograms_water", AN.histograms(cleaned["measurements"], {
            p: F.col(p) for p in cfg.water_params if p in cleaned["measurements"].columns}))
    if cleaned.get("feeds") is not None:
        w("daily_feed", FE.daily_feed(cleaned["feeds"], cleaned["cycles"]))
    return outputs


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--out-format", default="parquet", choices=["csv", "parquet"])
    ap.add_argument("--as-of", default=None)
    a = ap.parse_args()
    spark = get_spark(app="pondlens-preprocess")
    for k, v in run(spark, a.data, a.out, a.format, a.as_of, a.out_format).items():
        print(f"{k}\t{v}")


if __name__ == "__main__":
    main()
