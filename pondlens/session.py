"""Session helpers.

The pipeline relies on four session properties:

* ``spark.sql.session.timeZone=UTC`` - day arithmetic is done on epoch
  microseconds, so the zone must be fixed;
* ``spark.sql.ansi.enabled=true`` - every division goes through ``try_divide``
  and every parse through ``try_to_timestamp``, so ANSI errors never fire on
  dirty data while real bugs still surface;
* no generated method above the JVM's limit for compiled code (8,000 bytes): a
  stage that would have one runs its operators one by one, which is many times
  faster than interpreted bytecode;
* AQE on, with skew-join splitting (also where it costs an extra shuffle),
  so hot cycle/pond keys are split at run time. Shuffles start with
  ``SHUFFLE_PARTITIONS`` parts, which AQE merges up to its advisory size: the
  memory of a task then follows that size, not the input. A join whose smaller
  side has only small parts hashes these instead of sorting both sides.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Parts of a shuffle before AQE merges the small ones.
SHUFFLE_PARTITIONS = 1000

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(SHUFFLE_PARTITIONS),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot cycle's join partition even when the next operator then
    # needs its own shuffle (that shuffle follows a map-side partial aggregate)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, app: str = "pondlens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on an existing session (e.g. the driver's)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of a query that runs inside are removed when it ends, not when the driver's JVM next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points to shared storage and is used
    as is. Only when it is unset (local tests) is a scratch folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables are written there")
    d = tempfile.mkdtemp(prefix="pondlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d
