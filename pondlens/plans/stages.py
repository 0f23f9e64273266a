"""Composed stages: load -> coerce -> profile -> clean -> main -> analyse.

``Stages`` builds each stage once per (session, data folder) and keeps the
resulting lazy plans; cleaning runs its bounded statistics jobs when first
asked for. Nothing here collects table rows to the driver.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pondlens.config import PipelineConfig
from pondlens.operators import clean as C
from pondlens.operators import ensembles as E
from pondlens.operators import features as FE
from pondlens.session import apply_session_conf, checkpoint_dir, shuffles_freed
from pondlens.sources.catalog import load_processed
from pondlens.sources.sinks import save_processed, write_table
from pondlens.sources.driver_views import driver_tables, raw_catalog, view_df

# the driver tables give sampling rows these extra tie-break columns
DRIVER_SAMPLING_ORDER = ["sampled_at", "l_linenumber", "l_partkey", "l_suppkey"]


class Stages:
    def __init__(self, spark: SparkSession, catalog: dict, cfg: PipelineConfig | None = None,
                 materialize: bool = True):
        self.spark = spark
        self.cfg = cfg or PipelineConfig()
        self.raw = catalog
        self.materialize = materialize
        self.run_id = uuid.uuid4().hex

    @cached_property
    def coerced(self) -> dict:
        return C.coerce_catalog(self.raw, self.cfg)

    @cached_property
    def clean_reports(self) -> dict:
        """The cleaning statistics of the tables whose outliers are capped."""
        tables = [n for n, cols in self.cfg.outlier_columns.items() if cols]
        return self.cleaned.load(tables).reports

    @cached_property
    def cleaned(self) -> C.CleanedTables:
        """Every table, cleaned when a query first reads it."""
        return C.CleanedTables(self.coerced, self.cfg)

    @cached_property
    def main_plan(self) -> DataFrame:
        """The lazy main-table plan (K15) over the cleaned catalog."""
        return FE.build_main(self.cleaned.load(FE.MAIN_TABLES), self.cfg)

    @cached_property
    def main(self) -> DataFrame:
        """The main table written once to the shared checkpoint folder and
        read back - later stages reuse it and its lineage is cut."""
        if not self.materialize:
            return self.main_plan
        path = os.path.join(checkpoint_dir(self.spark), "pondlens", self.run_id, "main")
        write_table(self.main_plan, path)
        return self.spark.read.parquet(path)

    @cached_property
    def reloaded(self) -> DataFrame:
        """S3 + S4: the main and the cleaned tables written as CSV text, and the main table typed again from it.

        Plain, the text takes some 30 times the room of the Parquet files it comes from, so it is compressed."""
        out = os.path.join(checkpoint_dir(self.spark), "pondlens", self.run_id, "processed")
        with shuffles_freed(self.spark):
            saved = save_processed(self.main, self.cleaned, out, "csv", "gzip")
        return load_processed(self.spark, saved["main_dataset"], fmt="csv")

    @cached_property
    def export(self) -> E.Export:
        """Every target by every algorithm at the reference's own settings, trained once and exported; the model queries read it."""
        return E.Export(self.spark, E.train(self.main, os.path.join(checkpoint_dir(self.spark), "pondlens", self.run_id, "models")))

    @cached_property
    def searched(self) -> E.Export:
        """The same after the reference's random search: 20 draws by 5 folds for each target and algorithm."""
        return E.Export(self.spark, E.train(self.main, os.path.join(checkpoint_dir(self.spark), "pondlens", self.run_id, "search"), n_iter=20))


_MEMO: dict = {}


def driver_stages(spark: SparkSession, sf_dir: str) -> Stages:
    """Stages over the driver test tables bound to the pond schema."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    st = _MEMO.get(key)
    if st is None:
        apply_session_conf(spark)
        cfg = replace(PipelineConfig(), sampling_order=list(DRIVER_SAMPLING_ORDER))
        st = Stages(spark, raw_catalog(spark, sf_dir), cfg)
        # time-stamped facts with sub-day times (floor-days on real timestamps)
        st.events = view_df(spark, "raw_events", driver_tables(spark, sf_dir, ("events",)))
        _MEMO[key] = st
    return st
