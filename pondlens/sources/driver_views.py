"""Bind the driver's TPC-H-style test tables to the pond schema.

The driver tables carry no NULLs or orphans, so dirt (orphans, NULLs,
NaN, negatives, zeros, outliers, unparseable dates, open cycles) is injected by
key arithmetic over every row. The SQL below runs unchanged in Spark and in
DuckDB: Spark runs it with the driver tables bound as DataFrame parameters
(no temp views touch the caller's catalog), the DuckDB oracle uses the same
text as leading CTEs. Every view reads its whole source table.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from pondlens.sources.catalog import nan_to_null

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]

RAW_VIEWS: dict[str, str] = {
    "raw_farms": """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation""",
    "raw_ponds": """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 61 = 0 THEN 999 ELSE CAST(c_nationkey AS BIGINT) END AS farm_id,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal / 100 END AS length,
       CAST(10 + c_custkey % 30 AS DOUBLE) AS width,
       CASE WHEN c_custkey % 10 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(1 + c_custkey % 3 AS DOUBLE) END AS deep
FROM customer""",
    "raw_cycles": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS pond_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN -o_totalprice
            WHEN o_orderkey % 17 = 0 THEN CAST(0 AS DOUBLE)
            WHEN o_orderkey % 101 = 0 THEN o_totalprice * 20
            ELSE o_totalprice END AS total_seed,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL
            ELSE CAST(500 + o_orderkey % 1500 AS DOUBLE) END AS area,
       CASE WHEN o_orderkey % 23 = 0 THEN 'bad-date'
            ELSE CAST(o_orderdate AS STRING) END AS started_at,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate + INTERVAL 100 DAY AS STRING)
            ELSE CAST(o_orderdate + INTERVAL 130 DAY AS STRING) END AS finished_at
FROM orders""",
    "raw_harvests": """
SELECT l_orderkey AS cycle_id,
       CASE WHEN l_partkey % 29 = 0 THEN NULL
            ELSE CAST(20 + l_linenumber * 10 AS DOUBLE) END AS size,
       CASE WHEN l_partkey % 31 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity * 100 END AS weight,
       l_shipdate AS harvested_at
FROM lineitem""",
    "raw_feeds": """
SELECT CASE WHEN l_orderkey % 89 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END AS cycle_id,
       CASE WHEN l_partkey % 37 = 0 THEN NULL
            WHEN l_partkey % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice / 20 END AS quantity,
       CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_shipdate END AS logged_at
FROM lineitem""",
    "raw_sampling": """
SELECT l_orderkey AS cycle_id,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS average_weight,
       l_shipdate AS sampled_at, l_linenumber, l_partkey, l_suppkey
FROM lineitem""",
    "raw_measurements": """
SELECT l_orderkey AS cycle_id, l_shipdate AS measured_at,
       26 + l_tax * 20 AS morning_temperature,
       27 + l_discount * 40 AS evening_temperature,
       CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE 4 + l_tax * 10 END AS morning_do,
       4 + l_discount * 10 AS evening_do,
       CASE WHEN l_partkey % 47 = 0 THEN CAST(400 AS DOUBLE) ELSE 10 + l_quantity / 5 END AS morning_salinity,
       11 + l_quantity / 5 AS evening_salinity,
       7 + l_tax * 10 AS morning_pH,
       CAST(8 AS DOUBLE) AS evening_pH,
       CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE 20 + l_quantity END AS transparency,
       CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE l_discount * 5 END AS ammonia,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_tax * 50 END AS nitrate,
       l_discount * l_tax * 20 AS nitrite,
       CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE 80 + l_extendedprice / 1000 END AS alkalinity,
       CASE WHEN l_partkey % 67 = 0 THEN CAST('NaN' AS DOUBLE) ELSE 2000 + l_extendedprice / 25 END AS hardness,
       CAST(200 + l_partkey % 300 AS DOUBLE) AS calcium,
       CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE CAST(500 + l_suppkey % 700 AS DOUBLE) END AS magnesium,
       CAST(l_linenumber * 4 AS DOUBLE) AS carbonate,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 90 + l_quantity END AS bicarbonate,
       40 + l_quantity * (1 + l_tax) AS tom,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice * 10 END AS total_plankton
FROM lineitem""",
    "raw_mortalities": """
SELECT l_orderkey AS cycle_id,
       CAST((l_partkey % 7) - 1 AS DOUBLE) AS quantity,
       l_quantity / 2 AS average_weight, l_shipdate AS recorded_at
FROM lineitem""",
    "raw_fasting": """
SELECT CASE WHEN l_orderkey % 79 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END AS cycle_id, l_shipdate AS fasted_at
FROM lineitem""",
    "raw_feed_tray": """
SELECT CASE WHEN l_orderkey % 73 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END AS cycle_id,
       CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END AS logged_at,
       CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_shipdate + INTERVAL 1 DAY END AS feed_logged_at
FROM lineitem""",
    "raw_events": """
SELECT user_id AS cycle_id, value AS average_weight, ts AS sampled_at, event_id FROM events""",
}

# pond table name -> raw view
VIEW_FOR_TABLE = {
    "farms": "raw_farms", "ponds": "raw_ponds", "cycles": "raw_cycles",
    "feeds": "raw_feeds", "harvests": "raw_harvests", "sampling": "raw_sampling",
    "measurements": "raw_measurements", "mortalities": "raw_mortalities",
    "fasting": "raw_fasting", "feed_tray": "raw_feed_tray",
}


BASE_TABLES = ("nation", "customer", "orders", "lineitem", "events")
_FROM = re.compile(r"\bFROM (" + "|".join(BASE_TABLES) + r")\b")


def driver_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> dict[str, DataFrame]:
    """The driver parquet tables as lazy scans (no temp views are registered)."""
    return {n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")) for n in names}


def view_df(spark: SparkSession, view: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run one raw view's SQL with the driver tables bound as DataFrame
    parameters, so the caller's session catalog is left untouched."""
    sql = _FROM.sub(lambda m: "FROM {" + m.group(1) + "}", RAW_VIEWS[view])
    used = {n: tables[n] for n in BASE_TABLES if "{" + n + "}" in sql}
    return spark.sql(sql, **used)


def raw_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    """The pond catalog over the driver tables; NaN counts as missing, as in every source."""
    tables = driver_tables(spark, sf_dir)
    return {table: nan_to_null(view_df(spark, view, tables)) for table, view in VIEW_FOR_TABLE.items()}
