"""Semi-join reduction: a bitmap of keys that lets a scan skip rows before a shuffle.

A bitmap has at most ``MAX_BITS`` bits (16 MB), whatever the number of keys;
with more keys it lets more rows pass. It only saves work: rows that pass are
still joined on their exact keys. It is packed, eight slots a byte, wherever it
is held; the driver merges the tasks' parts one at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

MIN_BITS, MAX_BITS = 1 << 16, 1 << 27
BITS_PER_KEY = 16
#: Tasks that make a bitmap; each makes a part of the whole size.
PARTS = 8


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    shift = np.uint64(64 - (bits.bit_length() - 1))
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Packed booleans at the slots of the long column's values."""
    n = keys.count()
    bits = MIN_BITS
    while bits < min(MAX_BITS, n * BITS_PER_KEY):
        bits *= 2

    def run(batches):
        out = np.zeros(bits, dtype=bool)
        for b in batches:
            out[_slots(b["k"].to_numpy(), bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(out).tobytes()], type=pa.binary())], names=["map"])

    parts = T.materialize(keys.select(F.col(column).alias("k")).where("k IS NOT NULL").coalesce(PARTS).mapInArrow(run, "map binary"), "bitmap")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for p in parts.toLocalIterator():
        out |= np.frombuffer(p["map"], np.uint8)
    T.release(parts)
    return out


def maybe(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap."""
    slots = _slots(np.ascontiguousarray(keys), 8 * len(found))
    return (found[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def reduced(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``df`` with few of the rows whose ``column`` is not among ``keys``; all others stay."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap(keys, key))

    def run(batches):
        found = shared.value
        for b in batches:
            yield b.filter(pa.array(maybe(found, b[column].to_numpy())))

    return df.mapInArrow(run, df.schema)
