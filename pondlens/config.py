"""Table and column configuration.

Operators never hard-code table or column names: they receive these
mappings, so the same code runs on another star/snowflake schema by passing a
different ``PipelineConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These lists must equal the reference's so the cleaning and
# feature steps touch the same columns in the same order.
# ---------------------------------------------------------------------------

TABLE_NAMES = ["farms", "ponds", "cycles", "feeds", "fasting", "harvests",
               "sampling", "measurements", "mortalities", "feed_tray"]

CSV_FILES = {
    "farms": "farms.csv", "ponds": "ponds.csv", "cycles": "cycles.csv",
    "feeds": "feeds.csv", "fasting": "fasting.csv", "harvests": "harvests.csv",
    "sampling": "samplings.csv", "measurements": "measurements.csv",
    "mortalities": "mortalities.csv", "feed_tray": "feed_tray.csv",
}

DATE_COLUMNS = {
    "cycles": ["started_at", "finished_at"],
    "feeds": ["logged_at"],
    "harvests": ["harvested_at"],
    "sampling": ["sampled_at"],
    "measurements": ["measured_at"],
    "mortalities": ["recorded_at"],
    "feed_tray": ["logged_at", "feed_logged_at"],
}

# columns checked for negative / zero values (profile P4/P5, clean C3/C4)
CHECK_COLUMNS = {
    "ponds": ["length", "width", "deep"],
    "cycles": ["total_seed", "area"],
    "feeds": ["quantity"],
    "harvests": ["size", "weight"],
    "sampling": ["average_weight"],
    "mortalities": ["quantity", "average_weight"],
}

# zero counts are not reported for these columns (P5)
ZERO_REPORT_EXEMPT = ["average_weight"]

# columns whose zeros are replaced by the smallest positive value (C4)
ZERO_FIX_COLUMNS = ["length", "width", "deep", "total_seed", "area", "quantity", "size", "weight"]

WATER_PARAMS_ALL = [
    "morning_temperature", "evening_temperature", "morning_do", "evening_do",
    "morning_salinity", "evening_salinity", "morning_pH", "evening_pH",
    "transparency", "ammonia", "nitrate", "nitrite", "alkalinity", "hardness",
    "calcium", "magnesium", "carbonate", "bicarbonate", "tom", "total_plankton",
]

# numeric imputation (C1): table -> {column: method}
IMPUTE_COLUMNS = {
    "ponds": {"length": "median", "width": "median", "deep": "median"},
    "cycles": {"total_seed": "median", "area": "median"},
    "feeds": {"quantity": "median"},
    "harvests": {"size": "median", "weight": "median"},
    "sampling": {"average_weight": "median"},
    "measurements": {p: "median" for p in WATER_PARAMS_ALL},
    "mortalities": {"quantity": "median", "average_weight": "median"},
}

# the eight water parameters aggregated per cycle and correlated
WATER_PARAMS = [
    "morning_temperature", "evening_temperature", "morning_do", "evening_do",
    "morning_salinity", "evening_salinity", "morning_pH", "evening_pH",
]

# IQR capping
OUTLIER_COLUMNS = {
    "ponds": ["length", "width", "deep"],
    "cycles": ["total_seed", "area"],
    "sampling": ["average_weight"],
    "measurements": WATER_PARAMS,
}

IQR_FACTOR = 1.5

# foreign keys checked (P7): (child, child_key, parent, parent_key, relation label)
FOREIGN_KEYS = [
    ("ponds", "farm_id", "farms", "id", "ponds-farms"),
    ("cycles", "pond_id", "ponds", "id", "cycles-ponds"),
] + [
    (t, "cycle_id", "cycles", "id", f"{t}-cycles")
    for t in ["feeds", "fasting", "harvests", "sampling", "measurements", "mortalities", "feed_tray"]
]

# KPI filters
SR_VALID = (5.0, 100.0)       # 5 < SR <= 100
SR_RANGE = (1.0, 100.0)       # closed range used by the analysis steps
FCR_VALID = (0.5, 3.0)        # open interval

KPI_COLUMNS = ["culture_duration", "stocking_density", "survival_rate", "adg", "fcr"]

# columns never used as correlation factors
ID_COLUMNS = ["id", "id_pond", "id_farm", "farm_id", "pond_id", "cycle_id"]

TOP_FACTORS = 10
MIN_FACTOR_ROWS = 10          # a factor needs more than this many values
HIST_BINS = 20
DENSITY_POINTS = 200          # of a density curve

# grid of the density curves: cells a bandwidth, and bandwidths up to which a kernel counts
CELLS_PER_BANDWIDTH = 8
KERNEL_REACH = 8.0

# model features (M1): base features, water substrings, seasonal
BASE_FEATURES = ["stocking_density", "pond_volume", "surface_to_volume_ratio",
                 "culture_duration", "temp_daily_fluctuation"]
WATER_FEATURE_MARKERS = ["temperature", "do", "salinity", "pH", "ammonia", "nitrate", "nitrite"]
SEASONAL_FEATURES = ["start_month", "start_quarter"]

# a fixed "now" for open cycles; pipelines take it as a parameter
DEFAULT_AS_OF = "2026-01-01 00:00:00"


# ---------------------------------------------------------------------------
# Explicit schemas for CSV input (no inference)
# ---------------------------------------------------------------------------

def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_D, _L, _S = T.DoubleType(), T.LongType(), T.StringType()

CSV_SCHEMAS = {
    "farms": _s(("id", _L)),
    "ponds": _s(("id", _L), ("farm_id", _L), ("length", _D), ("width", _D), ("deep", _D)),
    "cycles": _s(("id", _L), ("pond_id", _L), ("total_seed", _D), ("area", _D),
                 ("started_at", _S), ("finished_at", _S)),
    "feeds": _s(("cycle_id", _L), ("quantity", _D), ("logged_at", _S)),
    "fasting": _s(("cycle_id", _L)),
    "harvests": _s(("cycle_id", _L), ("size", _D), ("weight", _D), ("harvested_at", _S)),
    "sampling": _s(("cycle_id", _L), ("average_weight", _D), ("sampled_at", _S)),
    "measurements": _s(("cycle_id", _L), ("measured_at", _S), *[(p, _D) for p in WATER_PARAMS_ALL]),
    "mortalities": _s(("cycle_id", _L), ("quantity", _D), ("average_weight", _D), ("recorded_at", _S)),
    "feed_tray": _s(("cycle_id", _L), ("logged_at", _S), ("feed_logged_at", _S)),
}


@dataclass
class PipelineConfig:
    """Everything a pipeline run needs besides the tables themselves."""

    as_of: str = DEFAULT_AS_OF
    date_columns: dict = field(default_factory=lambda: dict(DATE_COLUMNS))
    check_columns: dict = field(default_factory=lambda: dict(CHECK_COLUMNS))
    zero_fix_columns: list = field(default_factory=lambda: list(ZERO_FIX_COLUMNS))
    impute_columns: dict = field(default_factory=lambda: dict(IMPUTE_COLUMNS))
    outlier_columns: dict = field(default_factory=lambda: dict(OUTLIER_COLUMNS))
    foreign_keys: list = field(default_factory=lambda: list(FOREIGN_KEYS))
    water_params: list = field(default_factory=lambda: list(WATER_PARAMS))
    # tie-break columns for "last sampling" beyond sampled_at
    sampling_order: list = field(default_factory=lambda: ["sampled_at"])
