"""Vectorised text primitives over Arrow string columns, and scratch tables.

Texts are handled as UTF-8 bytes in blocks of whole rows of about
``BLOCK_BYTES``, so a task holds a bounded working set whatever the partition
size; a longer text forms a block of its own. Null texts count as empty.
"""

from __future__ import annotations

import os
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 1 << 20
ARROW_BATCH_BYTES = 8 << 20
ARROW_BATCH_ROWS = 2000

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


#: Word bytes: everything but blank, tab, LF, VT, FF, CR.
WS_WORD = ~_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Word bytes after lower-casing: digits, a-z and every non-ASCII byte.
PLAIN_WORD = _table(bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of a bounded size, for any length of text; skewed joins are split whatever follows them."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share(spark: SparkSession, value):
    """Broadcast an object with its class, for executors that lack this package; ``shared`` gives it back."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(box):
    return pickle.loads(box.value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    # imported here: this module is shipped to executors by value, and they may lack the rest of the package
    from pondlens.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), "pondlens-llm", uuid.uuid4().hex, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    The lineage ends there: a lost executor costs no recomputation of what
    came before, and later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the folders of materialized frames; call it once what was made of them is written."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


class Block:
    """Consecutive rows of one Arrow string column as bytes.

    ``data`` holds the bytes, ``offsets`` the row limits (n + 1), ``first``
    the index of the first row in its batch.
    """

    __slots__ = ("data", "offsets", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + block_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Block(whole[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lo)
        lo = hi


def lowered(block: Block) -> Block:
    """The block with A-Z in lower case."""
    return Block(np.frombuffer(block.data.tobytes().lower(), dtype=np.uint8), block.offsets, block.first)


def words(block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and each row's range of words (n + 1)."""
    mask = table[block.data]
    size = len(mask)
    if size == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(block) + 1, np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    cuts = block.offsets[(block.offsets > 0) & (block.offsets < size)]
    begin[cuts] = mask[cuts]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    end[cuts - 1] = mask[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> _U(31))
    h = h * _K2
    h = h ^ (h >> _U(29))
    h = h * _K3
    return h ^ (h >> _U(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, read eight bytes at a time."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view(_U), shape=(len(padded) - 7,), strides=(1,))
    length = ends - starts
    h = (length.astype(_U) + _U(1)) * _K1
    keep = np.array([0xFFFFFFFFFFFFFFFF >> (8 * (8 - k)) if k else 0 for k in range(9)], dtype=_U)
    active, at, left = slice(None), starts, length
    while True:
        v = eight[at] & keep[np.minimum(left, 8)]
        x = (h[active] ^ v) * _K2
        h[active] = x ^ (x >> _U(32))
        more = left > 8
        if not more.any():
            return mix64(h)
        active = np.flatnonzero(more) if isinstance(active, slice) else active[more]
        at, left = at[more] + 8, left[more] - 8


def windows(hashes: np.ndarray, ranges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows, and each row's range of windows.

    A row of fewer than k words (but one at least) has one window: its whole
    sequence.
    """
    n = len(hashes)
    counts = np.diff(ranges)
    each = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out = np.concatenate([[0], np.cumsum(each)])
    acc = np.zeros(max(n - k + 1, 0), _U)
    for i in range(k):
        acc = acc * _K1 + hashes[i:n - k + 1 + i] if len(acc) else acc
    acc = mix64(acc + _U(k))
    res = np.zeros(out[-1], _U)
    long_rows = counts >= k
    if long_rows.all() and len(counts):
        # windows that span two rows are left out
        pick = np.repeat(ranges[:-1] - out[:-1], each) + np.arange(out[-1])
        res[:] = acc[pick]
    else:
        full = np.repeat(long_rows, each)
        pick = (np.repeat(ranges[:-1] - out[:-1], each) + np.arange(out[-1]))[full]
        res[full] = acc[pick] if len(pick) else 0
        for i in np.flatnonzero((counts > 0) & ~long_rows):
            h = _U(0)
            with np.errstate(over="ignore"):
                for x in hashes[ranges[i]:ranges[i + 1]]:
                    h = h * _K1 + x
                res[out[i]] = mix64(np.array([h + _U(counts[i])], dtype=_U))[0]
    return res, out


def window_argmin(values: np.ndarray, k: int) -> np.ndarray:
    """Where the first smallest value of each window of ``k`` values stands."""
    low, at, width = values, np.arange(len(values)), 1
    while width < k:
        # two windows of ``width`` values make one that is up to twice as wide
        step = min(width, k - width)
        right = low[step:] < low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.minimum(low[step:], low[:-step])
        width += step
    return at


def shingle_sets(block: Block, k: int = 5, table: np.ndarray = WS_WORD) -> list[np.ndarray]:
    """Each row's sorted distinct k-word shingles (of the lower-cased text) as 64-bit hashes."""
    low = lowered(block)
    starts, ends, ranges = words(low, table)
    h, out = windows(word_hashes(low.data, starts, ends), ranges, k)
    return [np.unique(h[a:b]) for a, b in zip(out[:-1].tolist(), out[1:].tolist())]


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32) if parts else np.zeros(1, np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, type=kind))
