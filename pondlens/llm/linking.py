"""Components of classes that share band keys, without all pairs of a bucket.

``bands`` has a row (bucket, c) for each class and band; classes in a bucket
are candidates. They are tested in three rounds:

1. each class with the one bucket minimum it shares most buckets with;
2. each class with the best linked class it shares a bucket with;
3. classes in buckets that then still hold several components form groups (buckets that share a
   class belong together). What lies outside a group's largest component - the
   strays - is compared with the group's members of other components, a block
   of strays against a block of members at a time, by the exact counts of
   shared shingles that an inverted index of the block gives. Only one link
   for each stray, component and block is returned.

A pair inside one component cannot change the result, and every other
candidate pair is compared in the third round at the latest, so no link
between different components is lost. No pair is a row before it is a link.
Minima and maxima are partial aggregates, joins on buckets are plain
equi-joins whose skewed partitions Spark splits, and blocks are bounded by
their number of shingles, so a hot group becomes many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import bloom
from pondlens.llm import textops as T
from pondlens.llm.components import components

PERCENT = 75
BLOCK_SHINGLES = 1_000_000
#: Counters and counted shingles that are held in one step of a comparison, beside those of one stray.
WORK = 500_000

def band_rows(classes: DataFrame, width: int, bands: int) -> DataFrame:
    """(bucket, c) of classes with ``registers`` (binary) in bands of ``width`` bytes."""
    # written out: Spark compiles no lambda
    keys = [F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(bands)]
    return classes.select(F.explode(F.array(*keys)).alias("bucket"), "c")


def shared_members(bands: DataFrame) -> DataFrame:
    """(bucket, c, lo) of the buckets that hold several classes; ``lo`` is the smallest."""
    shared = bands.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket", "lo")
    shared = T.materialize(shared, "buckets")
    # most buckets hold one class: the bitmap keeps these out of the second shuffle
    return T.materialize(bloom.reduced(bands, "bucket", shared, "bucket").join(shared, "bucket"), "members")


def linked_components(members: DataFrame, sets: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of all classes with links.

    ``sets``: (c, items) of all members; ``verified`` keeps the pairs (a, b) that are links.
    """
    best = (members.where("c > lo").groupBy("c", "lo").agg(F.count("*").alias("n"))
            .groupBy("c").agg(F.max_by("lo", F.struct(F.col("n"), -F.col("lo"))).alias("lo")))
    first = T.materialize(verified(best.select(F.col("lo").alias("a"), F.col("c").alias("b"))), "links")
    degree = (first.select(F.col("a").alias("c")).unionAll(first.select(F.col("b").alias("c")))
              .groupBy("c").agg(F.count("*").alias("degree"), (-F.first("c")).alias("order")))
    hub = F.struct("degree", "order")
    hubs = members.join(degree, "c").groupBy("bucket").agg(F.max(hub).alias("hub"))
    nearest = members.join(hubs, "bucket").groupBy("c").agg((-F.max("hub")["order"]).alias("hub"))
    second = nearest.where("c != hub").select(F.least("c", "hub").alias("a"), F.greatest("c", "hub").alias("b")).distinct()
    links = first.unionByName(T.materialize(verified(second), "links"))
    whole = T.materialize(components(links), "components")
    open_ = _mixed(members, whole)
    strays = T.materialize(stray_links(open_, sets), "links")
    stars = whole.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(strays))


def _mixed(members: DataFrame, whole: DataFrame) -> DataFrame:
    """(bucket, c, lo, component) of the buckets that hold several components."""
    labelled = members.join(whole.withColumnRenamed("node", "c"), "c", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "c"))
    mixed = (labelled.groupBy("bucket").agg(F.min("component").alias("l"), F.max("component").alias("h"))
             .where("l < h").select("bucket"))
    return T.materialize(labelled.join(mixed, "bucket", "left_semi"), "open")


def stray_links(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different components of each group of buckets."""
    groups = components(open_.select(F.col("c").alias("a"), F.col("lo").alias("b"))).select(
        F.col("node").alias("c"), F.col("component").alias("g"))
    n = sets.select("c", F.size("items").alias("n"))
    rows = open_.select("c", "component").distinct().join(groups, "c").join(n, "c")
    rows = T.materialize(rows, "residue")
    per = rows.groupBy("g", "component").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    total = per.groupBy("g").agg(F.max(F.struct("k", "component")).alias("main"), F.sum("n").alias("all"))
    largest = total.join(per.select("g", F.col("component").alias("m"), F.col("n").alias("own")), "g").where("m = main.component")

    def blocks(words):
        return F.ceil(words / BLOCK_SHINGLES).cast("int")

    largest = largest.select("g", F.col("m").alias("largest"), blocks(F.col("all") - F.col("own")).alias("stray_blocks"),
                             blocks(F.col("all")).alias("member_blocks"))
    rows = rows.join(largest, "g")
    block = F.xxhash64("c")
    strays = rows.where("component != largest").select(
        "g", "c", "component", F.lit(True).alias("stray"), F.pmod(block, F.col("stray_blocks")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)).alias("j"))
    whole = rows.select(
        "g", "c", "component", F.lit(False).alias("stray"), F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1)).alias("i"),
        F.pmod(block, F.col("member_blocks")).cast("int").alias("j"))
    both = strays.unionByName(whole.select(*strays.columns)).join(sets, "c")
    # most groups are small: a task takes its blocks in order and compares many at a time
    dealt = both.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return dealt.select("g", "i", "j", "c", "component", "stray", "items").mapInArrow(_compared, "a bigint, b bigint")


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All positions of the ranges [lo, hi)."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first does."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def whole_blocks(batches) -> Iterator[pa.Table]:
    """Tables of whole blocks (g, i, j), whose rows follow each other; only the last block, which may go on, is held back."""
    keys, held = ["g", "i", "j"], []
    for b in batches:
        if b.num_rows == 0:
            continue
        at = [b[n].to_numpy() for n in keys]
        last = int(np.flatnonzero(_heads(*at))[-1])
        if last or (held and any(held[-1][n][-1].as_py() != k[0] for n, k in zip(keys, at))):
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _compared(batches):
    """Links of the blocks (g, i, j), whose rows follow each other."""
    for rows in whole_blocks(batches):
        yield _links(rows)


def _links(rows: pa.Table) -> pa.RecordBatch:
    """One link (a, b) for each stray and other component among the members of its block; ``rows`` are whole blocks."""
    c, comp, stray = (rows[n].to_numpy() for n in ("c", "component", "stray"))
    block = np.cumsum(_heads(*(rows[n].to_numpy() for n in ("g", "i", "j")))) - 1
    items = rows["items"].combine_chunks()
    size, flat = items.value_lengths().to_numpy().astype(np.int64), items.flatten().to_numpy()
    own = np.repeat(np.arange(len(c)), size)
    # a shingle of a block as one number
    known, number = np.unique(flat, return_inverse=True)
    number = block[own] * len(known) + number
    member = ~stray[own]
    order = np.argsort(number[member], kind="stable")
    held, holder = number[member][order], own[member][order]
    # members of a block stand in a row of counters for each of its strays
    place = np.cumsum(~stray) - 1
    n_members = np.bincount(block, ~stray).astype(np.int64)
    place -= (np.cumsum(n_members) - n_members)[block]
    members = np.flatnonzero(~stray)
    first_member = np.cumsum(n_members) - n_members
    strays = np.flatnonzero(stray)
    need = -(-PERCENT * size // 100)
    asked, asker = number[~member], own[~member]
    lo, hi = (np.searchsorted(held, asked, side=side) for side in ("left", "right"))
    limits = np.concatenate([[0], np.cumsum(size[strays])])
    work = np.bincount(asker, hi - lo, len(c))[strays].astype(np.int64) + n_members[block[strays]]
    part = np.cumsum(work) // WORK
    cuts = np.append(np.flatnonzero(_heads(part)), len(strays))
    a, b = [], []
    for p, q in zip(cuts[:-1], cuts[1:]):
        at = np.arange(limits[p], limits[q])
        # a linked member lacks at most len - need of the shingles, so it holds one of the rarest len - need + 1
        rare = at[np.lexsort((hi[at] - lo[at], asker[at]))]
        rare = rare[at - np.repeat(limits[p:q], size[strays[p:q]]) <= (size - need)[asker[at]]]
        near, of = holder[_spread(lo[rare], hi[rare])], np.repeat(asker[rare], hi[rare] - lo[rare])
        some = np.zeros(len(c), dtype=bool)
        some[of[comp[near] != comp[of]]] = True
        at = at[some[asker[at]]]
        tested = strays[p:q][some[strays[p:q]]]
        if len(tested) == 0:
            continue
        width = n_members[block[tested]]
        start = np.zeros(len(c), np.int64)
        start[tested] = np.cumsum(width) - width
        near, of = holder[_spread(lo[at], hi[at])], np.repeat(asker[at], hi[at] - lo[at])
        shared = np.bincount(start[of] + place[near], minlength=width.sum())
        x, y = np.repeat(tested, width), members[_spread(first_member[block[tested]], first_member[block[tested]] + width)]
        linked = np.flatnonzero((shared > 0) & (100 * shared >= PERCENT * (size[x] + size[y] - shared)) & (comp[x] != comp[y]))
        x, y = x[linked], y[linked]
        order = np.lexsort((comp[y], x))
        x, y = x[order], y[order]
        one = _heads(x, comp[y])
        a.append(c[x[one]])
        b.append(c[y[one]])
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or none)), pa.array(np.concatenate(b or none))], names=["a", "b"])
