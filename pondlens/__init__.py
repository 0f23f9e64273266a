"""pondlens: a Spark-native pipeline for pond-culture records.

Stages (all lazy DataFrame plans, executed by Spark):

* ``sources``   - CSV/Parquet catalog loading, sinks, and the views that bind
                  the driver test tables to the pond schema.
* ``operators`` - profiling, cleaning, feature/KPI building, analysis,
                  exact distributed quantiles, MLlib models, batch scoring.
* ``functions`` - null-safe column expressions (floor days, safe divide,
                  guarded correlation, clipping, season).
* ``plans``     - composed pipelines and the query registry used by
                  ``__spark_entry__``.
* ``streaming`` - Structured Streaming scoring of records landing in a folder.
"""

from pondlens.session import get_spark

__all__ = ["get_spark"]
