"""Benchmark decontamination: size-partitioned MinHash containment search.

An item (a short test text) leaks into a document if the document contains at
least ``THRESHOLD`` of the item's distinct 5-word shingles. Items are
partitioned by the size of their shingle set, in powers of two. The index
keeps, for an item of n shingles, its k smallest MinHash values with
k = n - ceil(THRESHOLD * n) + 1: a document that reaches the threshold lacks
at most n - ceil(THRESHOLD * n) shingles, so it holds one of the k values for
certain. A document is a candidate for an item if it holds one of them and is
large enough for the item's partition; candidates are verified by the exact
number of shared shingles in the same pass. Nothing is lost to sketching.

The index is collected and broadcast in parts of at most ``PART_SHINGLES``
shingles, one after the other: a part's result is written and the part let go
before the next one is fetched, so neither the driver nor an executor ever
holds more than one. Documents are searched once for each part and are never
shuffled.

Words are runs of digits, letters and non-ASCII characters after lower-casing
A-Z, so case and punctuation do not hide a leak. An item of fewer than five
words has its whole sequence as its one shingle, and is looked up among the
document's windows of just as many words, wherever they stand. Items and texts
without words and null texts match nothing. Repeated documents and items count
once. An empty side gives an empty result. Ids may be of any type, null
included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from pondlens.llm import textops as T

SHINGLE = 5
THRESHOLD = 0.75
PART_SHINGLES = 4_000_000
FILTER_BITS = 22


class Index:
    """MinHash index of some items, all with shingles of ``window`` words.

    ``keys`` are the sorted distinct index values; the items of ``keys[i]``
    are ``items[posts[i]:posts[i + 1]]``; ``sets`` hold all shingles.
    """

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float, window: int = SHINGLE):
        self.ids, self.sets, self.window = ids, sets, window
        self.need = np.array([_need(len(s), threshold) for s in sets], dtype=np.int64)
        # partitions by size: an item's partition holds sizes in [2^p, 2^(p + 1))
        part = np.array([len(s).bit_length() - 1 for s in sets], dtype=np.int64)
        self.least = np.array([_need(1 << int(p), threshold) for p in part], dtype=np.int64)
        value, item = [], []
        for i, s in enumerate(sets):
            k = len(s) - int(self.need[i]) + 1
            value.append(np.sort(T.mix64(s))[:k])
            item.append(np.full(k, i))
        values = np.concatenate(value) if value else np.zeros(0, np.uint64)
        items = np.concatenate(item) if item else np.zeros(0, np.int64)
        order = np.argsort(values, kind="stable")
        self.items = items[order].astype(np.int64)
        self.keys, first = np.unique(values[order], return_index=True)
        self.posts = np.append(first, len(values))
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, ranges: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of every row that reaches an item's threshold; rows come as word hashes."""
        h, limits = T.windows(hashes, ranges, self.window)
        m = T.mix64(h)
        hit = np.flatnonzero(self.maybe[(m >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.searchsorted(self.keys, m[hit])
        at[at == len(self.keys)] = 0
        real = self.keys[at] == m[hit] if len(self.keys) else np.zeros(0, bool)
        hit, at = hit[real], at[real]
        rows = np.searchsorted(limits, hit, side="right") - 1
        for row in np.unique(rows).tolist():
            found = np.unique(h[limits[row]:limits[row + 1]])
            keys = np.unique(at[rows == row])
            near = np.unique(np.concatenate([self.items[self.posts[k]:self.posts[k + 1]] for k in keys.tolist()]))
            for i in near[self.least[near] <= len(found)].tolist():
                shared = int(np.isin(self.sets[i], found, assume_unique=True).sum())
                if shared >= self.need[i]:
                    yield row, i, shared


class Part:
    """One index for each window length of a part's items."""

    def __init__(self, rows: list, threshold: float):
        """``rows``: (item id, window, shingles as bytes)."""
        self.indexes = []
        for k in sorted({r[1] for r in rows}):
            here = [r for r in rows if r[1] == k]
            self.indexes.append(Index([r[0] for r in here], [np.frombuffer(r[2], np.uint64) for r in here], threshold, k))

    def search(self, texts: pa.Array) -> list[tuple]:
        """(row, item id, shingles of the item, shared shingles) of every leak."""
        out = []
        for b in T.blocks(texts):
            low = T.lowered(b)
            starts, ends, ranges = T.words(low, T.PLAIN_WORD)
            hashes = T.word_hashes(low.data, starts, ends)
            for x in self.indexes:
                out += [(b.first + row, x.ids[i], len(x.sets[i]), n) for row, i, n in x.hits(hashes, ranges)]
        return out


def _need(n: int, threshold: float) -> int:
    """The least number of shared shingles that is ``threshold`` of n."""
    return max(1, int(np.ceil(threshold * n - 1e-9)))


def index_parts(items: DataFrame, id_col: str, text_col: str, threshold: float) -> Iterator[tuple[Part, bool]]:
    """The index in parts of bounded size (one item at least), one at a time, each with whether it is the last."""
    T.bound_batches(items.sparkSession)
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    schema = StructType([rows.schema["item_id"], *StructType.fromDDL("window int, shingles binary").fields])

    def sets(batches):
        for b in batches:
            sizes, got = [], []
            for x in T.blocks(b["text"]):
                sizes += np.diff(T.words(T.lowered(x), T.PLAIN_WORD)[2]).tolist()
                got += [s.tobytes() for s in T.shingle_sets(x, SHINGLE, T.PLAIN_WORD)]
            yield pa.RecordBatch.from_arrays(
                [b["item_id"], pa.array([min(n, SHINGLE) for n in sizes], type=pa.int32()), pa.array(got, type=pa.binary())],
                names=["item_id", "window", "shingles"])

    made = T.materialize(rows.mapInArrow(sets, schema).where("window > 0"), "items")
    total = made.agg(F.sum(F.length("shingles"))).first()[0] or 0
    parts = -(-(total // 8) // PART_SHINGLES)
    for p in range(parts):
        # bounded: a part holds about PART_SHINGLES shingles of eight bytes
        got = made.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(parts)) == p).collect()
        got.sort(key=lambda r: (str(r["item_id"]), bytes(r["shingles"])))
        yield Part([(r["item_id"], r["window"], bytes(r["shingles"])) for r in got], threshold), p == parts - 1


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs doc_id, item_id, n_item, n_shared, containment."""
    spark = docs.sparkSession
    T.bound_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = items.schema[item_id_col].dataType
    schema = StructType([rows.schema["doc_id"], StructField("item_id", item_type), StructField("n_item", LongType()),
                         StructField("n_shared", LongType())])
    item_arrow = to_arrow_type(item_type)
    found = spark.createDataFrame([], schema)
    for part, last in index_parts(items, item_id_col, item_text_col, threshold):
        box = T.share(spark, part)

        def run(batches, box=box):
            index = T.shared(box)
            for b in batches:
                hits = index.search(b["text"])
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].take(pa.array([h[0] for h in hits], type=pa.int64())),
                     pa.array([h[1] for h in hits], type=item_arrow),
                     pa.array([h[2] for h in hits], type=pa.int64()),
                     pa.array([h[3] for h in hits], type=pa.int64())], names=["doc_id", "item_id", "n_item", "n_shared"])

        pairs = rows.mapInArrow(run, schema)
        if not last:
            pairs = T.materialize(pairs, "leaks")
            box.destroy()
        found = found.unionByName(pairs)
    found = found.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    best = F.max(F.struct("containment", "n_item", "n_shared")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_item", "best.n_shared", "best.containment")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows into which an item leaks; what a part leaves is written before the next part is fetched."""
    spark = docs.sparkSession
    T.bound_batches(spark)
    flag = T.free_name(docs, "leaks")
    schema = StructType([*docs.schema.fields, StructField(flag, BooleanType())])
    for part, last in index_parts(items, item_id_col, item_text_col, threshold):
        box = T.share(spark, part)

        def run(batches, box=box):
            index = T.shared(box)
            for b in batches:
                bad = np.zeros(b.num_rows, dtype=bool)
                bad[[h[0] for h in index.search(b[text_col])]] = True
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bad)], names=[*b.schema.names, flag])

        docs = docs.mapInArrow(run, schema).where(~F.col(flag)).drop(flag)
        if not last:
            docs = T.materialize(docs, "clean")
            box.destroy()
    return docs
