"""MinHash near-duplicates with SetSketch registers.

A document's set is its distinct 5-word shingles. Its sketch has ``REGISTERS``
SetSketch registers: the smallest of the set's exponential hash values,
truncated to powers of ``BASE``. Registers merge by maximum, and the
probability that two sets agree in one grows with their Jaccard similarity, so
bands of ``ROWS`` registers are locality-sensitive keys.

1. Documents with equal sets form a class; all later steps are on classes, so
   thousands of copies cost one row.
2. Classes that share a band are candidates. At the threshold a pair shares
   none of the bands with probability (1 - 0.75^4)^40 < 3e-7.
3. A candidate's similarity is estimated from all registers jointly, by the
   likelihood of the counts of larger, equal and smaller registers given both
   set sizes; estimates ``MARGIN`` (five standard deviations) under the
   threshold are dropped.
4. The rest is verified on the full sets: a link has
   100 * intersection >= 75 * union.
5. Components of links by alternating stars.

No bucket is expanded into all its pairs: see ``linking``.

Null texts and texts without words have an empty set and are linked with
nothing. Repeated rows are one class. Rows with a null id never name a
component unless all its ids are null. An empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import bloom
from pondlens.llm import textops as T
from pondlens.llm.linking import PERCENT, band_rows, linked_components, shared_members

SHINGLE = 5
ROWS, BANDS = 4, 40
REGISTERS = ROWS * BANDS
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2    # of the registers: base b, rate a, limit q
MARGIN = 0.17

_RNG = np.random.default_rng(20210119)
_A = (_RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32)
_CHUNK = 1 << 15


def minima(hashes: np.ndarray, limits: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """The least of ``count`` 32-bit hash functions over each range of ``hashes`` (no hashes: the largest value)."""
    rows = len(limits) - 1
    low = np.full((count, rows), 0xFFFFFFFF, dtype=np.uint32)
    h = (T.mix64(hashes) >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(limits) > 0)
    x, y = np.empty(_CHUNK, np.uint32), np.empty(_CHUNK, np.uint32)
    for lo in range(0, len(h), _CHUNK):
        part = h[lo:lo + _CHUNK]
        n = len(part)
        # rows that have hashes here, and where these begin
        first = np.searchsorted(limits[full + 1], lo, side="right")
        last = np.searchsorted(limits[full], lo + n, side="left")
        here = full[first:last]
        begin = np.maximum(limits[here] - lo, 0)
        xv, yv = x[:n], y[:n]
        for i in range(count):
            np.multiply(part, _A[i], out=xv)
            np.add(xv, _B[i], out=xv)
            np.right_shift(xv, 15, out=yv)
            np.bitwise_xor(xv, yv, out=xv)
            np.multiply(xv, np.uint32(0x2C1B3C6D), out=xv)
            np.minimum(low[i, here], np.minimum.reduceat(xv, begin), out=yv[:len(here)])
            low[i, here] = yv[:len(here)]
    return low.T


def registers(hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """SetSketch registers of each range of ``hashes`` (no hashes: zeros)."""
    u = (minima(hashes, limits).astype(np.float64) + 0.5) / 2.0 ** 32
    value = np.floor(1.0 - np.log(-np.log1p(-u) / RATE) / np.log(BASE))
    out = np.clip(value, 0, LIMIT + 1).astype(np.uint16)
    out[np.diff(limits) == 0] = 0
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches of sets of known sizes."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = REGISTERS - up - down
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    scale, log_b = (BASE - 1) / BASE, np.log(BASE)

    def prob(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * scale) / log_b

    def likelihood(j):
        p, q = prob(u - v * j), prob(v - u * j)
        tiny = 1e-300
        return up * np.log(p + tiny) + down * np.log(q + tiny) + same * np.log(np.clip(1 - p - q, tiny, 1.0))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):      # the likelihood is concave in the similarity
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        right = likelihood(x) < likelihood(y)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n (set size), h1, h2 (the set's identity), registers."""
    T.bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))

    def run(batches):
        for b in batches:
            size, h1, h2, regs = [], [], [], []
            for x in T.blocks(b["text"]):
                sets = T.shingle_sets(x, SHINGLE)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                size.append(n)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                limits = np.concatenate([[0], np.cumsum(n)])
                for out, key in ((h1, 0x5851F42D4C957F2D), (h2, 0x14057B7EF767814F)):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(T.mix64(flat ^ np.uint64(key)))])
                    out.append(T.mix64(total[limits[1:]] - total[limits[:-1]]).view(np.int64))
                regs += [r.tobytes() for r in registers(flat, limits)]
            cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (size, h1, h2)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_key"], *map(pa.array, cols), pa.array(regs, type=pa.binary())],
                                             names=["doc_id", "text_key", "n", "h1", "h2", "registers"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, n bigint, h1 bigint, h2 bigint, registers binary")


def class_sets(docs: DataFrame, wanted: DataFrame, text_col: str = "text") -> DataFrame:
    """(c, registers, items): the full sets of the classes in ``wanted`` (c, text_key, registers).

    Texts that no class needs are skipped before the shuffle, and equal texts
    are merged in the map tasks.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("k"), text.alias("text"))
    texts = bloom.reduced(texts, "k", wanted, "text_key").groupBy("k").agg(F.first("text").alias("text"))
    rows = texts.join(wanted, F.col("k") == F.col("text_key")).select("c", "registers", "text")

    def run(batches):
        for b in batches:
            sets = [s.view(np.int64) for x in T.blocks(b["text"]) for s in T.shingle_sets(x, SHINGLE)]
            yield pa.RecordBatch.from_arrays([b["c"], b["registers"], T.list_array(sets, pa.int64())],
                                             names=["c", "registers", "items"])

    return rows.mapInArrow(run, "c bigint, registers binary, items array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links; ``sets``: (c, registers, items).

    Sizes and the estimate from the registers come first; what they leave is
    verified on the full sets.
    """
    both = (pairs.join(sets.select(F.col("c").alias("b"), F.col("registers").alias("r_b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("c").alias("a"), F.col("registers").alias("r_a"), F.col("items").alias("x")), "a"))
    both = both.where(f"100 * least(size(x), size(y)) >= {PERCENT} * greatest(size(x), size(y))")

    def run(batches):
        for t in batches:
            if t.num_rows == 0:
                continue
            a, b = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            n_a, n_b = (pc.list_value_length(t[c]).to_numpy().astype(np.float64) for c in ("x", "y"))
            likely = np.flatnonzero(estimate(a, b, n_a, n_b) >= PERCENT / 100 - MARGIN)
            keep = []
            for i in likely.tolist():
                x, y = t["x"][i].values.to_numpy(), t["y"][i].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                    keep.append(i)
            keep = pa.array(keep, type=pa.int64())
            yield pa.RecordBatch.from_arrays([t["a"].take(keep), t["b"].take(keep)], names=["a", "b"])

    return both.select("a", "b", "r_a", "r_b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, group (number of the component), text_key."""
    rows = T.materialize(sketches(docs, id_col, text_col), "sketches")
    classes = (rows.where("n > 0").groupBy("h1", "h2")
               .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("text_key").alias("text_key"),
                    F.first("registers").alias("registers")).withColumn("c", F.monotonically_increasing_id()))
    # written once: the numbers stay
    classes = T.materialize(classes, "classes")
    members = shared_members(band_rows(classes, 2 * ROWS, BANDS))
    wanted = classes.join(members.select("c").distinct(), "c", "left_semi").select("c", "text_key", "registers")
    sets = T.materialize(class_sets(docs, T.materialize(wanted, "wanted"), text_col), "sets")
    found = T.materialize(linked_components(members, sets.select("c", "items"), lambda pairs: verified(pairs, sets)), "components")
    ids = (classes.select("c", "doc_id", "h1", "h2").join(found, F.col("c") == F.col("node"), "left")
           .withColumn("group", F.coalesce("component", "c")))
    lowest = ids.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(lowest, "group").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "component_id", "group")
    out = rows.drop("registers").join(named, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "group", "text_key")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: its smallest id (null last).

    Texts without words are in no group and stay.
    """
    found = near_duplicates(docs, id_col, text_col).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    keep = found.groupBy("group").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("i"), F.col("first.text_key").alias("k"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the row travels as one struct, so its names clash with none of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("doc_id"),
                       F.xxhash64(text).alias("text_key"), text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    first = rows.where("worded").join(keep, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
    one = first.dropDuplicates(["i", "k"]).select("doc")
    return one.unionByName(rows.where("NOT worded").select("doc")).select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
