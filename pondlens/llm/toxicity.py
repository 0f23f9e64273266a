"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each present or absent: 64-bit hashes of its words, of the
words' first 4, 5 and 6 bytes, of neighbouring pairs and of pairs with one word
between. Words are runs of letters and digits after lower-casing A-Z.

Training reads at most ``MAX_TRAIN_DOCS`` labelled rows (in expectation; they
are chosen by a hash of the id). They are dealt to shards of about
``ROWS_PER_SHARD`` rows; each runs FTRL-proximal with per-coordinate rates,
and the L1 term leaves few weights that are not zero. Shard weights are averaged. The result is a
sorted table of (hash, weight) that is broadcast: its size is bounded by the
sample, not by the corpus. Scoring is one narrow pass over all texts.

Labels that are null are no labels; of repeated labels for an id the largest
counts, and repeated rows of a document each count. Without both classes among
the labels every score is 0. Null and empty texts have no features: their
score is the model's base rate. An empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pondlens.llm import textops as T

MAX_TRAIN_DOCS = 20_000
ROWS_PER_SHARD = 2_500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.1
MIN_DOCS = 2
THRESHOLD = 0.3
FILTER_BITS = 20

_KINDS = [np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F,
                                 0xFF51AFD7ED558CCD, 0x85EBCA77C2B2AE63)]


@dataclass
class Model:
    """Sorted feature hashes, their weights, the intercept; ``base`` is the score of no features."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float
    trained: bool = True


def features(block: T.Block) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every feature occurrence in a block."""
    low = T.lowered(block)
    starts, ends, ranges = T.words(low, T.PLAIN_WORD)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(block)), np.diff(ranges))
    w = T.word_hashes(low.data, starts, ends)
    out, at = [T.mix64(w ^ _KINDS[0])], [rows]
    for kind, n in zip(_KINDS[1:4], (4, 5, 6)):
        long = np.flatnonzero(ends - starts > n)
        out.append(T.mix64(T.word_hashes(low.data, starts[long], starts[long] + n) ^ kind))
        at.append(rows[long])
    for kind, gap in zip(_KINDS[4:], (1, 2)):
        same = np.flatnonzero(rows[gap:] == rows[:-gap])
        out.append(T.mix64(w[same] * kind + w[same + gap]))
        at.append(rows[same])
    return np.concatenate(out), np.concatenate(at)


def ftrl(docs: list[np.ndarray], labels: np.ndarray, n_features: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and intercept; ``docs`` hold each row's distinct feature numbers."""
    z, n = np.zeros(n_features + 1), np.zeros(n_features + 1)
    rng = np.random.default_rng(seed)

    def weight(i):
        zi = z[i]
        # the last coordinate is the intercept, which has no L1 term
        l1 = np.where(i == n_features, 0.0, L1)
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for d in rng.permutation(len(docs)):
            i = np.append(docs[d], n_features)
            w = weight(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[d]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    every = np.arange(n_features + 1)
    w = weight(every)
    return w[:-1], float(w[-1])


def train_shard(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(hash, weight) of the weights that are not zero, and the intercept."""
    each: list[np.ndarray] = []
    for b in T.blocks(texts):
        h, row = features(b)
        order = np.argsort(row, kind="stable")
        cut = np.searchsorted(row[order], np.arange(len(b) + 1))
        h = h[order]
        each += [np.unique(h[x:y]) for x, y in zip(cut[:-1], cut[1:])]
    flat = np.concatenate(each) if each else np.zeros(0, np.uint64)
    keys, count = np.unique(flat, return_counts=True)
    keys = keys[count >= MIN_DOCS]
    docs = []
    for h in each:
        i = np.searchsorted(keys, h)
        i[i == len(keys)] = 0
        docs.append(i[keys[i] == h] if len(keys) else np.zeros(0, np.int64))
    w, intercept = ftrl(docs, labels, len(keys))
    keep = w != 0
    return keys[keep], w[keep], intercept


def _sample(labelled: DataFrame, n: int, bound: int) -> DataFrame:
    """Of ``n`` rows at most ``bound`` in expectation, chosen by a hash of the id."""
    space = 1 << 40
    limit = space if n <= bound else space * bound // n
    return labelled.where(F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(space)) < limit)


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Fit on the texts of ``labelled`` (columns: the id and ``label`` 0 or 1)."""
    labels = (labelled.select(F.col(id_col).alias("doc_id"), F.col("label").cast("double").alias("label"))
              .where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))
    n = labels.count()
    sample = _sample(labels, n, max_docs)
    shards = -(-min(n, max_docs) // ROWS_PER_SHARD) or 1
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample is bounded by max_docs rows of two numbers
    rows = texts.join(F.broadcast(sample), F.col("id") == F.col("doc_id"))
    rows = rows.select("text", "label", F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(shards)).alias("shard"),
                       F.xxhash64("id", "text").alias("nth"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("nth", kind="stable", ignore_index=True)
        y = frame["label"].to_numpy()
        keys, w, b = train_shard(pa.array(frame["text"], type=pa.large_string(), from_pandas=True), y)
        return pd.DataFrame({"keys": [keys.tobytes()], "weights": [w.tobytes()], "intercept": [b],
                             "n": [len(y)], "positive": [float(y.sum())]})

    parts = rows.groupBy("shard").applyInPandas(
        fit, "keys binary, weights binary, intercept double, n long, positive double").collect()
    n, positive = sum(p.n for p in parts), sum(p.positive for p in parts)
    if not 0 < positive < n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, trained=False)
    keys = np.concatenate([np.frombuffer(p["keys"], np.uint64) for p in parts])
    w = np.concatenate([np.frombuffer(p["weights"], np.float64) for p in parts])
    merged, where = np.unique(keys, return_inverse=True)
    return Model(merged, np.bincount(where, w, len(merged)) / len(parts), sum(p.intercept for p in parts) / len(parts))


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    """The score of each text."""
    out = np.zeros(len(texts))
    if not model.trained:
        return out
    mask = np.uint64((1 << FILTER_BITS) - 1)
    maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
    maybe[model.keys & mask] = True
    for b in T.blocks(texts):
        h, row = features(b)
        hit = np.flatnonzero(maybe[h & mask])
        h, row = h[hit], row[hit]
        i = np.searchsorted(model.keys, h)
        i[i == len(model.keys)] = 0
        real = model.keys[i] == h if len(model.keys) else np.zeros(0, bool)
        # a feature counts once in a text
        pairs = np.unique(np.stack([row[real], i[real]], axis=1), axis=0)
        sums = np.bincount(pairs[:, 0], model.weights[pairs[:, 1]], len(b)) if len(pairs) else np.zeros(len(b))
        out[b.first:b.first + len(b)] = 1.0 / (1.0 + np.exp(-np.clip(sums + model.intercept, -35, 35)))
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``."""
    spark = docs.sparkSession
    T.bound_batches(spark)
    box = T.share(spark, model)

    def run(batches):
        fitted = T.shared(box)
        for b in batches:
            s = pa.array(score_texts(fitted, b[text_col]))
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
