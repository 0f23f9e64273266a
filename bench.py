"""Benchmark: wall time of the headline queries at $BENCH_SF_DIR.

Like the reference pipeline, cleaning statistics (medians, minimums,
quartiles of every table) are computed once per run; that stage is timed on
its own as ``clean_stats``. ``main_table`` builds the main table from the raw
Parquet, stores it in the checkpoint folder and reads it back. The queries in
``FROM_STORED_MAIN`` read that table (in whole or in part); every other query
runs from the raw Parquet. All run to completion through the ``noop`` sink -
nothing is collected to the driver.
``value`` is the sum of all timings. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "main_table", "dq_issues", "describe_numeric", "null_totals", "iqr_outliers", "impute_date_by_group",
    "kpi_summary", "corr_matrix", "top_factors", "histogram", "trend_line", "box_stats",
    "daily_feed", "last_sampling", "water_quality_agg", "regression_metrics", "validate_scoring_input",
]

FROM_STORED_MAIN = ["kpi_summary", "corr_matrix", "top_factors", "histogram", "trend_line", "box_stats",
                    "regression_metrics", "validate_scoring_input", "describe_numeric"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from pondlens.plans import registry, stages
    from pondlens.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="pondlens-bench", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, parquet footers, codegen caches
    registry.run(spark, sf_dir, "table_shapes").write.format("noop").mode("overwrite").save()
    timings = {}
    stages._MEMO.clear()
    t0 = time.perf_counter()
    stages.driver_stages(spark, sf_dir).cleaned.load()  # runs the statistics jobs
    timings["clean_stats"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        registry.run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()   # shutdown logs come before the result line
    sys.stderr.flush()
    print(json.dumps({"metric": "total_query_wall_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus),
                      "from_stored_main": [n for n in names if n in FROM_STORED_MAIN]}), flush=True)


if __name__ == "__main__":
    main()
