"""Mixing sources to target weights with a splitting tree of exact block quotas.

1. Sources in code-point order (null last) weigh 1, 2, 3, repeating. They
   share all words by weight; a target stops at ``max_epochs`` times its
   source's size and the excess is shared again until none is above.
2. Every document has a position, a hash of 30 bits; its first 10 bits are the
   block of its source it lies in. The mix takes each block of a source
   ``floor(target / size)`` times and a prefix of the positions once more. The
   prefix ends where the target is met: three levels of 1,024 children are
   descended, each time only into the child in which the end lies, so the work
   after the first level is on one block of each source. The documents on the
   end itself give the missing words in proportion to their size (usually one
   document, cut at a word).
3. The block copies of each source are dealt to output shards: a shard range
   is halved again and again, and the left half draws its blocks of all
   sources from the multivariate hypergeometric distribution. The leaves are
   exact quotas. Each shard takes the next ``quota`` blocks of the source's
   permuted blocks, so draws are disjoint, and is ordered by hash inside.

All randomness is hashing with a fixed seed, so reruns agree whatever the
partitioning. Rows that repeat (same source, id and text) share a position and
get equal shares. Null texts and texts without words have size 0 and are not
emitted by ``mix``; null sources form one source, as does the empty string. An
empty table gives an empty result. Only columns that are named are read;
others (of any name) pass through ``mix`` untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pondlens.llm import textops as T

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20240917
LEVEL_BITS = 10
LEVELS = 3
N_SHARDS = 64
#: Sources whose shard quotas one tree draws; more sources form more trees.
SOURCES_PER_TREE = 10_000


def word_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per document: id, source, size in words, position."""
    T.bound_batches(docs.sparkSession)
    pos = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "source", "doc_id", "text"), 64 - LEVEL_BITS * LEVELS)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
            .select("doc_id", "source", "text", pos.alias("pos")))
    kind = dict((f.name, f.dataType.simpleString()) for f in rows.schema)

    def count(batches):
        for b in batches:
            n = [np.diff(T.words(x, T.WS_WORD)[2]) for x in T.blocks(b["text"])]
            size = np.concatenate(n).astype(np.int64) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["source"], b["pos"], pa.array(size)],
                                             names=["doc_id", "source", "pos", "size"])

    return rows.mapInArrow(count, f"doc_id {kind['doc_id']}, source {kind['source']}, pos long, size long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: size in words, weight, target (a double).

    Sources are ranked by a distributed sort. Each round of sharing takes two
    sums over the sources to the driver, nothing else.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.orderBy(F.col("source").cast("binary").asc_nulls_last())
    schema = f"source {per.schema['source'].dataType.simpleString()}, source_size long, rank long"
    ranked = spark.createDataFrame(per.rdd.zipWithIndex().map(lambda r: (r[0][0], int(r[0][1]), r[1])), schema)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = T.materialize(ranked.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * MAX_EPOCHS
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    # words per unit of weight: a capped source never comes back, so the share only grows
    while True:
        open_ = F.col("weight") * share < cap
        left, w = ranked.agg(F.lit(total) - F.sum(F.when(~open_, cap).otherwise(0)),
                             F.sum(F.when(open_, F.col("weight")).otherwise(0.0))).first()
        if not w or left / w <= share:
            break
        share = float(left) / w
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(share)))


def _children(rows: DataFrame, level: int) -> DataFrame:
    """Words of each child block."""
    shift = LEVEL_BITS * (LEVELS - level)
    child = F.shiftright("pos", shift).bitwiseAND((1 << LEVEL_BITS) - 1)
    return rows.groupBy("source", child.alias("child")).agg(F.sum("size").alias("words"))


def cut_positions(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: epochs (whole passes), cut (positions below it are taken once
    more), and of the documents at the cut the words ``leaf`` and of these the
    part ``rest`` to take."""
    target = F.round("target").cast("long")
    base = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    plan = (targets.withColumn("epochs", F.least(base, F.lit(MAX_EPOCHS).cast("long")))
            .withColumn("rest", F.greatest(target - F.col("epochs") * F.col("source_size"), F.lit(0).cast("long")))
            .withColumn("cut", F.lit(0).cast("long")).withColumn("leaf", F.lit(0).cast("long")))
    plan = T.materialize(plan, "plan")
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        path = plan.where("rest > 0").select(F.col("source").alias("s"), "rest", "cut")
        rows = sizes
        if level > 1:
            up = LEVEL_BITS * (LEVELS - level + 1)
            rows = sizes.join(path, F.col("source").eqNullSafe(F.col("s"))
                              & (F.shiftright("pos", up) == F.shiftright("cut", up)), "left_semi")
        before = Window.partitionBy("source").orderBy("child").rowsBetween(Window.unboundedPreceding, -1)
        kids = (_children(rows, level).join(path, F.col("source").eqNullSafe(F.col("s")))
                .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))))
        hit = (kids.where("rest > before and rest <= before + words")
               .select(F.col("source").alias("s"), "child", "before", F.col("words").alias("w")))
        plan = T.materialize(
            plan.join(hit.withColumnRenamed("rest", "r"), F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("cut", F.coalesce(F.col("cut") + F.shiftleft(F.col("child").cast("long"), shift), "cut"))
            .withColumn("rest", F.coalesce(F.col("rest") - F.col("before"), "rest"))
            .withColumn("leaf", F.coalesce("w", "leaf")).drop("s", "child", "before", "w"), "plan")
    return plan


def _taken(size: Column) -> Column:
    part = F.when(F.col("leaf") > 0, F.floor(size * F.col("rest") / F.col("leaf"))).otherwise(0)
    once = F.when(F.col("pos") < F.col("cut"), size).when(F.col("pos") == F.col("cut"), part).otherwise(0)
    return (F.col("epochs") * size + once).cast("long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, source, pos."""
    sizes = T.materialize(word_sizes(docs, id_col, text_col, source_col), "sizes")
    plan = cut_positions(sizes, source_targets(sizes))
    per = plan.select(F.col("source").alias("s"), "source_size", "target", "epochs", "cut", "leaf", "rest")
    out = sizes.join(per, F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", _taken(F.col("size")).alias("taken"), "source", "pos")


def shard_quotas(block_counts: pd.DataFrame, n_shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns).

    The shard range is halved from the top; the left half's blocks are drawn
    from the multivariate hypergeometric distribution of what the node has.
    """
    out = np.zeros((len(block_counts), n_shards), np.int64)
    todo = [(block_counts["blocks"].to_numpy(np.int64), 0, n_shards)]
    while todo:
        have, lo, hi = todo.pop()
        if hi - lo == 1:
            out[:, lo] = have
            continue
        mid, total = (lo + hi) // 2, int(have.sum())
        draw = total * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(have, draw, method="marginals")
        todo += [(left, lo, mid), (have - left, mid, hi)]
    return out


def shard_blocks(plan: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED) -> DataFrame:
    """Per source, block and copy: the output shard. ``plan``: rows of ``mix_plan``."""
    top = F.shiftright("pos", LEVEL_BITS * (LEVELS - 1))
    # a copy of a block exists if any of its documents is taken that often (in whole or in part)
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)
    blocks = (plan.where("taken > 0").groupBy("source", top.alias("block")).agg(F.max(copies).cast("int").alias("n"))
              .select("source", "block", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")))
    blocks = T.materialize(blocks, "blocks")
    counts = blocks.groupBy("source").agg(F.count("*").alias("blocks"))
    trees = -(-counts.count() // SOURCES_PER_TREE) or 1

    def quotas(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("source", na_position="last", ignore_index=True)
        got = shard_quotas(frame, n_shards, seed)
        return pd.DataFrame({"s": frame["source"], "ends": list(np.cumsum(got, axis=1))})

    kind = counts.schema["source"].dataType.simpleString()
    tree = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(trees))
    ends = counts.groupBy(tree.alias("tree")).applyInPandas(quotas, f"s {kind}, ends array<long>")
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "block", "copy"), "block", "copy")
    ranked = blocks.withColumn("nth", F.row_number().over(order))
    return (ranked.join(ends, F.col("source").eqNullSafe(F.col("s")))
            .select("source", "block", "copy", F.size(F.filter("ends", lambda e: e < F.col("nth"))).alias("shard")))


def _deals(plan: DataFrame, n_shards: int) -> DataFrame:
    """Per source: for each block the shards of its copies, in order (at most 2^LEVEL_BITS blocks)."""
    blocks = (shard_blocks(plan, n_shards).groupBy("source", "block")
              .agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("deal")))
    shards = F.transform("deal", lambda x: x["shard"])
    return (blocks.groupBy(F.col("source").alias("s"))
            .agg(F.collect_list(F.struct("block", shards.alias("shards"))).alias("blocks")))


def _own_shards(size: Column, taken: Column) -> Column:
    """The shards of a document's copies, from its source's ``blocks``."""
    block = F.shiftright("pos", LEVEL_BITS * (LEVELS - 1))
    deal = F.get(F.filter("blocks", lambda x: x["block"] == block), 0)["shards"]
    return F.slice(deal, F.lit(1), F.ceil(taken / size).cast("int"))


def mix_table(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """``mix_plan`` and, per document, the output shard of each of its copies (an array)."""
    plan = T.materialize(mix_plan(docs, id_col, text_col, source_col), "taken")
    out = plan.join(_deals(plan, n_shards), F.col("source").eqNullSafe(F.col("s")), "left")
    mine = F.when(F.col("taken") > 0, _own_shards(F.col("size"), F.col("taken"))).otherwise(F.array().cast("array<int>"))
    return out.select(*plan.columns, mine.alias("shards"))


def mix(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixed corpus: the columns of ``docs``, and mix_copy, mix_words, mix_shard
    (with underscores added where ``docs`` has columns of these names).

    A document appears once for each copy; the copy on the cut is shortened to
    its part. Texts are shuffled once, by output shard, and each shard is
    ordered by hash.
    """
    sizes = T.materialize(word_sizes(docs, id_col, text_col, source_col), "sizes")
    plan = cut_positions(sizes, source_targets(sizes))
    per = plan.select(F.col("source").alias("s"), "epochs", "cut", "leaf", "rest")
    here = F.col("source").eqNullSafe(F.col("s"))
    taken = sizes.join(per, here).select("size", "source", "pos", _taken(F.col("size")).alias("taken"))
    deals = _deals(taken, n_shards).withColumnRenamed("s", "d")
    rules = T.materialize(per.join(deals, F.col("s").eqNullSafe(F.col("d"))).drop("d"), "rules")
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    pos = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(source_col), F.col(id_col), F.col(text_col)),
                               64 - LEVEL_BITS * LEVELS)
    # the row travels as one struct, so its names clash with none of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text_col).alias("text"),
                       F.col(source_col).alias("source"), pos.alias("pos"), size.cast("long").alias("size"))
    rows = rows.where("size > 0").join(rules, here).withColumn("taken", _taken(F.col("size"))).where("taken > 0")
    copies = F.posexplode(_own_shards(F.col("size"), F.col("taken"))).alias("nth", "shard")
    rows = rows.select("doc", "text", "size", "taken", "pos", copies)
    rows = rows.withColumn("words", F.least("size", F.col("taken") - F.col("nth") * F.col("size")))
    part = F.array_join(F.slice(F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+"),
                                F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") < F.col("size"), part).otherwise(F.col("text"))
    keep = [text.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return (rows.repartition(n_shards, "shard").sortWithinPartitions("shard", F.xxhash64(F.lit(SEED), "pos", "nth"))
            .select(*keep, (F.col("nth") + 1).alias(T.free_name(docs, "mix_copy")),
                    F.col("words").alias(T.free_name(docs, "mix_words")), F.col("shard").alias(T.free_name(docs, "mix_shard"))))
