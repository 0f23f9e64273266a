import tracemalloc

import numpy as np

from pondlens.llm import bloom


def test_bitmap_stays_packed_on_the_driver(spark):
    """A bitmap of 2^23 slots takes 1 MB; the driver never holds a byte a slot, nor all parts."""
    n = 300_000
    keys = spark.range(0, n, 1, 4).selectExpr("xxhash64(id) AS k")
    tracemalloc.start()
    found = bloom.bitmap(keys, "k")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.dtype == np.uint8 and found.nbytes == (1 << 23) // 8
    assert peak < 1 << 23, peak
    held = keys.toPandas()["k"].to_numpy()
    assert bloom.maybe(found, held).all()
    other = spark.range(n, 2 * n).selectExpr("xxhash64(id) AS k").toPandas()["k"].to_numpy()
    assert bloom.maybe(found, other).mean() < 0.06


def test_reduced_keeps_every_row_with_a_key(spark):
    rows = spark.range(1000).selectExpr("id", "xxhash64(id % 40) AS k")
    keys = spark.range(20).selectExpr("xxhash64(id) AS j").unionByName(spark.createDataFrame([(None,)], "j bigint"))
    kept = bloom.reduced(rows, "k", keys, "j")
    assert kept.columns == ["id", "k"]
    assert {r["id"] % 40 for r in kept.collect()} == set(range(20)) and kept.count() == 500
