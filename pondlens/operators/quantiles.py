"""Exact quantiles (linear interpolation) without one task holding a group.

Spark's exact ``percentile``/``median`` keeps a value->count map per group and
merges all partial maps of a group in one task, so a global median over a
huge, high-cardinality column (or a hot group holding a third of the rows)
puts every distinct value into one task's memory. The operators here compute
the same exact value (``quantile_cont`` / pandas ``quantile``: position
``h = (n-1)q``, ``x[floor h] + (h - floor h)(x[ceil h] - x[floor h])``):

* ``column_quantiles`` / ``quantile_values`` - eager, by range refinement over
  the columns as they stand; only ``ranges x buckets`` numbers reach the driver
  (used for the cleaning statistics that are inlined as literals);
* ``exact_quantiles`` - the same over a long frame, one row for each value;
* ``quantile_table`` - grouped (used for per-group statistics): ranks by one
  distributed sort of the value counts and the row counts of its partitions.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pondlens.session import checkpoint_dir


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    vals = df.select(*[F.col(b) for b in by], *[F.col(c).cast("double").alias(c) for c in columns])
    if len(columns) == 1:
        c = columns[0]
        long = vals.select(*by, F.lit(c).alias("column"), F.col(c).alias("v"))
    else:
        long = vals.unpivot(by, columns, "column", "v")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def quantile_table(df: DataFrame, columns: list[str], probs: list[float],
                   by: list[str] | None = None, **earlier) -> DataFrame:
    """Exact quantiles of ``columns`` at ``probs``, optionally per ``by`` group.

    Returns ``by..., column, prob, n, value``; NULL values are ignored and an
    all-NULL group yields no row.
    """
    by = list(by or [])
    return quantile_table_long(_long(df, columns, by), probs, by, **earlier)


def quantile_table_long(long: DataFrame, probs: list[float], by: list[str] | None = None,
                        small_group: int | None = None, buckets: int | None = None,
                        passes: int | None = None) -> DataFrame:
    """``quantile_table`` over long input ``by..., column, v`` (``v`` double,
    NULL/NaN removed).

    1. Equal values of a group are counted (partial sums in the map tasks).
    2. The counts are sorted by (group, value) over range partitions, which cut
       a hot group wherever its values lie - by rows, not by width, so neither
       its size nor its spread nor an infinity matters - and written once with
       the number of their partition.
    3. A group's partitions, one row each, say in which of them a wanted rank
       lies; only there a running sum picks the value.

    There is one way for groups of every size; no task holds more of a group
    than one range partition. ``small_group``, ``buckets`` and ``passes`` are
    accepted from earlier callers and have no effect.
    """
    by = list(by or [])
    keys = by + ["column"]
    spark = long.sparkSession
    values = long.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("cnt"))
    path = os.path.join(checkpoint_dir(spark), "pondlens", uuid.uuid4().hex, "ranked")
    values.orderBy(*keys, "v").withColumn("__part", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    group = Window.partitionBy(*keys)
    parts = (placed.groupBy(*keys, "__part").agg(F.sum("cnt").alias("rows"))
             .withColumn("n", F.sum("rows").over(group))
             .withColumn("start", F.sum("rows").over(group.orderBy("__part")) - F.col("rows")))
    h = (F.col("n") - 1).cast("double")
    wanted = F.array(*[F.struct(F.lit(float(q)).alias("prob"), (h * F.lit(float(q)) - F.floor(h * F.lit(float(q)))).alias("frac"),
                                F.lit(side).alias("side"), f(h * F.lit(float(q))).cast("bigint").alias("rank"))
                       for q in probs for side, f in (("lo", F.floor), ("hi", F.ceil))])
    wanted = parts.select(*keys, "__part", "n", "start", "rows", F.explode(wanted).alias("t")).select(
        *[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], F.col("__part").alias("__at"), "n", "start", "rows", "t.*")
    wanted = wanted.where((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("rows"))).drop("rows")
    here = F.col("__part") == F.col("__at")
    for i, k in enumerate(keys):
        here = here & F.col(k).eqNullSafe(F.col(f"__{i}"))
    some = wanted.select("__at", *[f"__{i}" for i in range(len(keys))]).distinct()
    running = Window.partitionBy(*keys, "__part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.join(some, here, "left_semi").withColumn("upto", F.sum("cnt").over(running))
    local = F.col("rank") - F.col("start")
    hit = rows.join(wanted, here).where((F.col("upto") - F.col("cnt") <= local) & (local < F.col("upto")))
    out = hit.groupBy(*keys, "prob", "n", "frac").agg(F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("lo"),
                                                      F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    value = (F.when((lo == hi) | (lo == float("-inf")), lo).when(hi == float("inf"), hi)
             .otherwise(lo + F.col("frac") * (hi - lo)))
    # one row a group and quantile, read by every later use
    path = os.path.join(checkpoint_dir(spark), "pondlens", uuid.uuid4().hex, "quantiles")
    out = out.select(*keys, "prob", "n", value.alias("value"))
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def quantile_values(df: DataFrame, columns: list[str], probs: list[float]) -> dict[tuple[str, float], float | None]:
    """Global exact quantiles as Python numbers (``len(columns) x len(probs)``).

    Columns that are entirely NULL map to ``None``.
    """
    out: dict[tuple[str, float], float | None] = {(c, float(q)): None for c in columns for q in probs}
    if not columns:
        return out
    out.update(column_quantiles([(df, {c: F.col(c) for c in columns})], probs))
    return out


def column_quantiles(tables: list[tuple[DataFrame, dict[str, Column]]], probs: list[float],
                     moments: dict | None = None) -> dict[tuple[str, float], float | None]:
    """``exact_quantiles`` of expressions over wide tables: (table, name -> expression), names unique over all tables.

    1. One plain hash aggregate counts the values of every column by slot, a
       64th of an octave, with the slot's minimum and maximum.
    2. A slot that holds a wanted rank and a large share of the rows is split
       into ``REFINE_BUCKETS`` of equal width, until no such range is left.
    3. The values inside the ranges (a few per cent of the rows) are counted
       and written; these counts are narrowed as in ``exact_quantiles``.

    Slots are monotone in the value, so counts are exact. NULL and NaN are left
    out; a column without values has no entry.
    """
    parts = [(df, dict(list(c.items())[k:k + COLUMNS_AT_ONCE])) for df, c in tables for k in range(0, len(c), COLUMNS_AT_ONCE)]
    out: dict = {}
    # the scans are independent jobs
    with ThreadPoolExecutor(4) as pool:
        for found, stats in pool.map(lambda t: _columns(*t, probs, moments is not None), parts):
            out.update(found)
            if moments is not None:
                moments.update(stats)
    return out


#: Columns of a table that one scan looks at; an aggregate of many more is not compiled well.
COLUMNS_AT_ONCE = 7


#: A range with a larger share of a column's values, and more than this many, is split before its values are written.
INSIDE_SHARE, INSIDE_ROWS = 0.05, 100_000


def _columns(df: DataFrame, columns: dict[str, Column], probs: list[float], more: bool) -> tuple[dict, dict]:
    names, spark = list(columns), df.sparkSession
    at = {f"c{i}": i for i in range(len(names))}
    wide = df.select(*[F.nanvl(e.cast("double"), F.lit(None).cast("double")).alias(c) for c, e in zip(at, columns.values())])
    v = F.col("v")
    per: dict[int, list] = {}
    for r in (_unfolded(wide).groupBy("name", _slot(v).alias("b"))
              .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()):
        per.setdefault(at[r["name"]], []).append(r)
    stats = {}
    if more and per:
        row = wide.agg(*[f(f"c{i}").alias(f"{k}{i}") for i in per for k, f in (("mean", F.avg), ("std", F.stddev_samp))]).first()
        stats = {names[i]: {"column": names[i], "n": sum(r["c"] for r in s), "lo": min(r["lo"] for r in s), "hi": max(r["hi"] for r in s),
                            "mean": row[f"mean{i}"], "std": row[f"std{i}"]} for i, s in per.items()}
    plan, state, held = {}, {}, {}
    for i, s in per.items():
        p, ranges = _plan(i, s, probs)
        plan |= p
        state |= ranges
        size = {(r["lo"], r["hi"]): r["c"] for r in s}
        held |= {k: size[x[:2]] for k, x in ranges.items()}
    total = {i: sum(r["c"] for r in s) for i, s in per.items()}
    while wide_ranges := {k: s for k, s in state.items() if s[0] != s[1] and held[k] > max(INSIDE_SHARE * total[k[0]], INSIDE_ROWS)}:
        some = sorted({c for c, _ in wide_ranges})
        long = _unfolded(wide.select(*[f"c{i}" for i in some]))
        long = long.select(F.substring("name", 2, 8).cast("int").alias("column"), "v", F.lit(1).alias("c"))
        held |= _narrow(long, wide_ranges, REFINE_BUCKETS)
        state |= wide_ranges
    kept = {}
    for c, lo, hi in sorted({(c, s[0], s[1]) for (c, _), s in state.items() if s[0] != s[1]}):
        kept[c] = kept.get(c, F.lit(False)) | F.col(f"c{c}").between(F.lit(lo), F.lit(hi))
    small = None
    if kept:
        inside = wide.select(*[F.when(test, F.col(f"c{i}")).alias(f"c{i}") for i, test in kept.items()])
        path = os.path.join(checkpoint_dir(spark), "pondlens", uuid.uuid4().hex, "brackets")
        inside = _unfolded(inside).groupBy("name", "v").agg(F.count(F.lit(1)).alias("c"))
        inside.select(F.substring("name", 2, 8).cast("int").alias("column"), "v", "c").write.parquet(path)
        small = spark.read.schema("column int, v double, c bigint").parquet(path)
    return {(names[i], q): x for (i, q), x in _narrowed(small, plan, state, REFINE_BUCKETS).items()}, stats


def _unfolded(wide: DataFrame) -> DataFrame:
    """(name, v) of all values; one column needs no unfolding."""
    if len(wide.columns) == 1:
        return wide.select(F.lit(wide.columns[0]).alias("name"), F.col(wide.columns[0]).alias("v")).where("v IS NOT NULL")
    return wide.unpivot([], wide.columns, "name", "v").where("v IS NOT NULL")


# ---------------------------------------------------------------------------
# Eager exact quantiles by range refinement (plain codegen aggregates)
# ---------------------------------------------------------------------------

REFINE_BUCKETS = 1024
_INFINITE = 4000     # exponent slot of an infinite value


def _exponent(v) -> Column:
    """Monotone slot of a value: its sign and power of two, 0 for zero."""
    size = F.abs(v)
    slot = F.when(size == float("inf"), F.lit(_INFINITE)).otherwise(F.floor(F.log2(size)).cast("int") + 2000)
    return F.when(v == 0, F.lit(0)).when(v > 0, slot).otherwise(-slot)


SLOTS_AN_OCTAVE = 64


def _slot(v) -> Column:
    """Monotone slot of a value: its sign and its place among the ``SLOTS_AN_OCTAVE`` parts of an octave, 0 for zero."""
    size = F.abs(v)
    slot = F.when(size == float("inf"), F.lit(200_000)).otherwise(F.floor(F.log2(size) * F.lit(SLOTS_AN_OCTAVE)).cast("int") + 100_000)
    return F.when(v == 0, F.lit(0)).when(v > 0, slot).otherwise(-slot)


SKETCH_K = 800          # rank error of the sketch: about 0.5 %
SKETCH_ERROR = 0.012    # half width of a bracket, as a share of the rows


def exact_quantiles(long: DataFrame, probs: list[float], buckets: int = REFINE_BUCKETS,
                    moments: dict | None = None) -> dict[tuple[str, float], float | None]:
    """Exact ``quantile_cont`` values of every ``column`` of a long ``(column, v)`` frame, in two scans.

    1. One aggregate builds a mergeable quantile sketch of each column; it
       brackets every wanted rank between two values.
    2. One aggregate counts the rows below, between and inside the brackets;
       only values inside a bracket (a few per cent of the rows) keep their
       identity. These value counts are written to the shared checkpoint folder.
    3. The value counts are narrowed to the wanted ranks: first by sign and
       power of two, then in ``buckets`` equal-width buckets with exact counts,
       minimum and maximum, until the bucket that holds a rank has one value.

    Slots and buckets are monotone in the value, so counts are exact whatever
    the sketch says; a rank that the sketch misses is looked up in the whole
    frame in the same way. A range within a factor of two holds at most 2^52
    different doubles and each pass divides it by ``buckets``, so with 1,024
    buckets six passes end on any input; no rows are ever ranked in one task,
    and only ``ranges x buckets`` numbers reach the driver. ``moments`` (a
    dict), when given, receives each column's n/min/max/mean/std. NULL/NaN
    values must already be removed.
    """
    long = long.select("column", F.col("v").cast("double").alias("v"))
    at = _sketch_ranks(probs)
    more = [] if moments is None else [F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")]
    finite = F.when(F.abs("v") != float("inf"), F.col("v"))
    sketched = long.groupBy("column").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                                          F.kll_sketch_agg_double(finite, F.lit(SKETCH_K)).alias("sketch"), F.count(finite).alias("some"), *more)
    edges = F.when(F.col("some") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(x) for x in at])))
    found = sketched.select(*[c for c in sketched.columns if c != "sketch"], edges.alias("edges")).collect()
    if moments is not None:
        moments.update({r["column"]: {k: r[k] for k in ("column", "n", "lo", "hi", "mean", "std")} for r in found})
    if not found:
        return {}
    # a bracket reaches from one edge to the next; infinities and what the sketch cannot hold lie outside
    ranges = {r["column"]: sorted({*([] if r["edges"] is None else r["edges"]), r["lo"], r["hi"]}) for r in found}
    inner = {r["column"]: _brackets(probs, at, r["edges"]) for r in found}
    width = max(len(e) for e in ranges.values())
    spark, kind = long.sparkSession, long.schema["column"].dataType.simpleString()
    nan = float("nan")
    table = spark.createDataFrame(
        [(c, *(e + [nan] * (width - len(e))), *[any(lo <= x and y <= hi for lo, hi in inner[c]) for x, y in zip(e, e[1:])],
          *[False] * (width - len(e))) for c, e in ranges.items()],
        f"rcol {kind}, " + ", ".join([f"e{i} double" for i in range(width)] + [f"i{i} boolean" for i in range(width - 1)]))
    v = F.col("v")
    # 2 i + 1 on edge i, 2 i + 2 between it and the next
    slot, inside = F.lit(0), F.lit(False)
    for i in range(width):
        slot = slot + (v >= F.col(f"e{i}")).cast("int") + (v > F.col(f"e{i}")).cast("int")
    for i in range(width - 1):
        inside = inside | (F.col(f"i{i}") & (v > F.col(f"e{i}")) & (v < F.col(f"e{i + 1}")))
    rows = long.join(F.broadcast(table), F.col("column") == F.col("rcol"))
    rows = rows.select("column", slot.alias("slot"), "v", F.when(inside, v).alias("kept"))
    path = os.path.join(checkpoint_dir(spark), "pondlens", uuid.uuid4().hex, "brackets")
    rows.groupBy("column", "slot", "kept").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).write.parquet(path)
    small = spark.read.parquet(path)
    slots = (small.groupBy("column", "slot", F.when(F.col("kept").isNotNull(), _exponent(F.col("lo"))).otherwise(0).alias("x"))
             .agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count_if(F.col("kept").isNull()).alias("out")).collect())
    counts = [{"column": r["column"], "b": (r["slot"], r["x"]), "c": r["c"], "lo": r["lo"], "hi": r["hi"], "out": r["out"]} for r in slots]
    try:
        return _refined(small.where("kept IS NOT NULL").select("column", F.col("kept").alias("v"), "c"), probs, buckets, counts, True)
    except _Outside:
        per_slot = (long.groupBy("column", _exponent(F.col("v")).alias("b"))
                    .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        return _refined(long.withColumn("c", F.lit(1)), probs, buckets, per_slot)


class _Outside(Exception):
    """A wanted rank lies outside the sketch's brackets."""


def _sketch_ranks(probs) -> list[float]:
    return sorted({min(max(float(q) + d, 0.0), 1.0) for q in probs for d in (-SKETCH_ERROR, SKETCH_ERROR)})


def _brackets(probs, at, edges) -> list[tuple[float, float]]:
    if edges is None:
        return []
    where = dict(zip(at, edges))
    return [tuple(where[min(max(float(q) + d, 0.0), 1.0)] for d in (-SKETCH_ERROR, SKETCH_ERROR)) for q in probs]


def _ranges_join(long: DataFrame, rng: DataFrame) -> DataFrame:
    return long.join(F.broadcast(rng), (long["column"] == rng["rcol"]) & (long["v"] >= rng["lo"])
                     & (long["v"] <= rng["hi"]))


def _hit(counts: list[tuple], rank: int) -> tuple:
    """(lo, hi, rows before) of the (c, lo, hi) entry that holds the rank."""
    below = 0
    for c, lo, hi in counts:
        if rank < below + c:
            return lo, hi, below
        below += c
    raise ValueError(f"rank {rank} of {below} rows")


def _plan(column, slots, probs) -> tuple[dict, dict]:
    """A column's (column, q) -> ranks, and (column, rank) -> lo, hi, rows below lo, from counts by monotone slots."""
    counts = [(r["c"], r["lo"], r["hi"]) for r in sorted(slots, key=lambda r: r["b"])]
    plan, state, n = {}, {}, sum(c for c, _, _ in counts)
    for q in probs:
        h = (n - 1) * float(q)
        ranks = int(h // 1), int(-(-h // 1))
        plan[(column, float(q))] = (*ranks, h - ranks[0])
        for rank in ranks:
            state[(column, rank)] = _hit(counts, rank)
    return plan, state


def _refined(long, probs, buckets, slots, bracketed=False):
    """The quantiles from weighted values (column, v, c) and their counts by monotone slots."""
    per: dict[str, list] = {}
    for r in slots:
        per.setdefault(r["column"], []).append(r)
    plan, state = {}, {}
    for column, some in per.items():
        p, s = _plan(column, some, probs)
        plan |= p
        state |= s
    if bracketed:
        loose = {(r["column"], r["lo"], r["hi"]) for r in slots if r["out"] and r["lo"] != r["hi"]}
        if any((c, lo, hi) in loose for (c, _), (lo, hi, _) in state.items()):
            raise _Outside
    return _narrowed(long, plan, state, buckets)


def _narrow(long, state, buckets) -> dict:
    """Narrow every open range of ``state`` once, in place; the rows that the new ranges hold."""
    open_ = sorted({(c, *s) for (c, _), s in state.items() if s[0] != s[1]})
    kind = long.schema["column"].dataType.simpleString()
    # one row a range, from literals: no Python task
    ends = [F.struct(F.lit(i).alias("sid"), F.lit(c).cast(kind).alias("rcol"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                     F.lit(float(hi) / buckets - float(lo) / buckets).alias("width")) for i, (c, lo, hi, _) in enumerate(open_)]
    rng = long.sparkSession.range(1).select(F.inline(F.array(*ends)))
    # a width of 0 (neighbouring tiny doubles) leaves the two ends as buckets of their own
    b = F.when(F.col("width") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.nullif("width", F.lit(0.0))),
                                           F.lit(buckets - 1)))
    b = F.when(F.col("v") == F.col("hi"), F.lit(buckets)).otherwise(F.coalesce(b, F.lit(0))).alias("b")
    rows = (_ranges_join(long, rng).select("sid", "v", "c", b).groupBy("sid", "b")
            .agg(F.sum("c").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    found: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: r["b"]):
        found.setdefault(r["sid"], []).append((r["c"], r["lo"], r["hi"]))
    sid = {key: i for i, key in enumerate(open_)}
    held = {}
    for (c, rank), s in list(state.items()):
        if s[0] != s[1]:
            counts = found[sid[(c, *s)]]
            lo, hi, before = _hit(counts, rank - s[2])
            held[(c, rank)] = next(n for n, x, y in counts if (x, y) == (lo, hi))
            state[(c, rank)] = (lo, hi, s[2] + before)
    return held


def _narrowed(long, plan, state, buckets):
    """The quantiles once every wanted rank's range is down to one value."""
    while any(s[0] != s[1] for s in state.values()):
        _narrow(long, state, buckets)
    out = {}
    for (c, q), (a, b, frac) in plan.items():
        lo, hi = float(state[(c, a)][0]), float(state[(c, b)][0])
        if lo == hi or lo == float("-inf"):
            out[(c, q)] = lo
        else:
            out[(c, q)] = hi if hi == float("inf") else lo + frac * (hi - lo)
    return out
