"""Target-distribution importance resampling over hashed word n-grams, by Arrow kernels.

A document is drawn the likelier, the more its words look like those of a
target corpus.

1. Texts are lower-cased (A-Z) and split into words by Arrow's ``ascii_lower``
   and ``split_pattern_regex``; ``list_flatten`` and ``dictionary_encode`` turn
   a batch into one array of word numbers. Runs of 2 and 3 words are pairs of
   that array with itself shifted: (word, next word), (pair, word after), again
   dictionary encoded. Only distinct pairs are hashed: the CRC-32 of a run
   continues that of its head. ``take`` spreads the buckets over all runs.
2. Runs are counted by bucket over the whole corpus and over the whole target:
   one vector of ``buckets`` numbers a task, summed by Spark. A bucket's gain is
   ``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))``. The gains
   are a fixed number of integers, broadcast to a second narrow pass, which sums
   them over each document (a segmented sum).
3. A document's score is its weight plus seeded Gumbel noise, so the highest
   scores are a draw without replacement. Ranks come from one distributed sort
   and the row counts of its partitions; no rows are ranked in one task.

Null texts count as empty; a text without words has weight 0 and is never drawn
if ``min_words`` is above 0. A null id hashes as an empty one and sorts last;
rows that repeat an id get the same noise and ranks of their own. Empty corpora
and targets are allowed (T or S is 0 then). Only the named columns are read;
``resample`` passes all others through, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pondlens.llm import textops as T

BUCKETS = 10_000
MAX_WORDS = 3
SEED = 42
PERCENT = 5
MIN_WORDS = 20
#: What separates words, after lower-casing: every ASCII character but digits and letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that are split at a time (a longer text is split alone).
SLICE_BYTES = 4 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive rows of about ``SLICE_BYTES``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), lo + 1)
        yield texts.slice(lo, hi - lo)
        lo = hi


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and each key's place among them."""
    enc = pc.dictionary_encode(pa.array(keys))
    return enc.dictionary.to_numpy(zero_copy_only=False), enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def runs(texts: pa.Array, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> tuple[list, np.ndarray]:
    """(bucket, row) arrays of all runs, one pair for each length, and each row's number of words."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATOR)
    flat, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(flat, "")
    enc = pc.dictionary_encode(flat.filter(real))
    row = row.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    word = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = enc.dictionary.cast(pa.large_binary()).to_pylist()
    tails = [b" " + w for w in names]
    crc = [zlib.crc32(w) for w in names]
    head, out = word, []
    for n in range(1, max_words + 1):
        if n > 1:
            # a run of n words is the run of n - 1 before it and its last word
            same = row[n - 1:] == row[:len(row) - n + 1]
            keys, place = _distinct(head[:len(same)] * len(tails) + word[n - 1:])
            left, last = (keys // max(len(tails), 1)).tolist(), (keys % max(len(tails), 1)).tolist()
            crc = [zlib.crc32(tails[j], crc[i]) for i, j in zip(left, last)]
            head = place
        spread = pc.take(pa.array(np.array(crc, np.int64) % buckets), pa.array(head)).to_numpy(zero_copy_only=False)
        at = row[:len(head)]
        # pairs that reach into the next row are no runs
        out.append((spread, at) if n == 1 else (spread[same], at[same]))
    return out, np.bincount(row, minlength=len(texts))


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
                  max_words: int = MAX_WORDS) -> np.ndarray:
    """How many runs of the whole table fall into each bucket (``buckets`` numbers)."""
    T.bound_batches(texts.sparkSession)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in _slices(b["text"]):
                for bucket, _ in runs(part, buckets, max_words)[0]:
                    total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The integer gain of each bucket from both tables' counts."""
    k, s_all, t_all = float(len(corpus)), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight."""
    T.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    box = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = box.value
        for b in batches:
            each = []
            for part in _slices(b["text"]):
                found, words = runs(part, len(gain), max_words)
                n, w = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for bucket, row in found:
                    # rows are in order: a segmented sum by the running total at their limits
                    total = np.concatenate([[0], np.cumsum(gain[bucket])])
                    limits = np.searchsorted(row, np.arange(len(part) + 1))
                    n += np.diff(limits)
                    w += np.diff(total[limits])
                each.append(np.stack([words, n, w]))
            cols = np.concatenate(each, axis=1) if each else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c) for c in cols]],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id and the seed alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``weighed`` with score and rank (1, 2, ... of the drawn; null for the others).

    Of the N documents with at least ``min_words`` words the floor(percent N /
    100) highest scores are drawn; ties go to the smaller id.
    """
    ready = (weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
             .withColumn("ready", F.col("n_words") >= min_words))
    ready = T.materialize(ready, "scored")
    n_ready = ready.where("ready").count()
    order = [F.desc("ready"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    # the place is (partition, row in the partition); written once, so that it cannot change
    placed = ready.orderBy(*order).withColumn("place", F.monotonically_increasing_id())
    placed = T.materialize(placed, "ranked")
    part = F.shiftright("place", 33)
    first = (placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("before", F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).drop("rows"))
    # one row for each partition of the sort
    out = placed.join(F.broadcast(first), part == F.col("part"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    drawn = F.col("ready") & (rank <= n_ready * percent // 100)
    return out.select(*weighed.columns, "score", F.when(drawn, rank).alias("rank"))


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
           buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """Per document of ``docs``: doc_id, n_words, n_features, weight, score, rank."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    return draw(weigh(docs, gain, id_col, text_col), percent, min_words, seed)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns (rows of one id are drawn together)."""
    drawn = (ranked(docs, target, id_col=id_col, **options).where("rank is not null")
             .select(F.col("doc_id").alias("__drawn_id")).distinct())
    return docs.join(drawn, docs[id_col].eqNullSafe(drawn["__drawn_id"]), "left_semi")
