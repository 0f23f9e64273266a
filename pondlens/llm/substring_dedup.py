"""Substring dedup: paragraph MinHash banding.

Paragraphs are lines of ``MIN_WORDS`` words or more. Paragraphs of the same
word sequence form a class; classes are banded by MinHash (``ROWS`` 32-bit minima
a band, ``BANDS`` bands: a pair at the threshold shares a band with
probability 1 - (1 - 0.75^3)^12 = 0.9986, at a similarity of 0.9 with
0.9999998), colliding classes are verified by the exact Jaccard similarity of
their 5-word shingles, and components of verified pairs are the clusters.

A passage that was pasted into the middle of a paragraph is no paragraph of
its own, so passages are found too, in two ways. From each sentence start, the
shortest run of whole sentences of one line with ``MIN_PASSAGE`` words or more.
And every run of ``MIN_RUN`` words or more, wherever it begins and ends, over
line breaks: each window of ``MIN_RUN`` words is led by its smallest
``GRAM``-word hash (winnowing), so equal windows have equal leaders. Windows
in a row with one leader form a piece. A leader that several documents hold is
looked at further: by its pieces if all of them are equal, else by each
of its windows. Equal runs, pieces or windows form a cluster; those inside a
clustered paragraph are not reported.

A cluster counts if it spans ``MIN_DOCS`` documents. Its first occurrence, by
document id (null last), text and position, is kept, the others are removed.
Paragraphs are decided first: an occurrence that overlaps a removed paragraph
keeps nothing, but stays itself if it lies before the keeper, as do all if
none may keep, and those that overlap the kept one. So each word of a
removed passage leads to the same word of an occurrence further ahead, and in
the end to one that stays. Overlapping passages of a text with one keeper are
merged into a span; ``cluster`` is that of its first passage.

A text's units travel in one row, and bitmaps of keys keep single ones out of
the joins; paragraph and passage texts are never shuffled but for the classes
that share a band. Null and empty texts have no paragraphs. Repeated rows are
one document. Rows with a null id are one document, whatever their texts. An
empty table gives an empty result.
Only the named columns are read; ``removed`` passes all others through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pondlens.llm import bloom
from pondlens.llm import textops as T
from pondlens.llm.linking import PERCENT, band_rows, linked_components, shared_members
from pondlens.llm.near_dup import minima

SHINGLE = 5
MIN_WORDS = 25
MIN_PASSAGE = 20
MIN_RUN, GRAM = 50, 25
MIN_DOCS = 2
ROWS, BANDS = 3, 12

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Lines:
    """The words of a block with the lines and sentences they lie in."""

    def __init__(self, block: T.Block):
        self.low = T.lowered(block)
        data = self.low.data
        self.starts, self.ends, self.rows = T.words(self.low, T.WS_WORD)
        self.hashes = T.word_hashes(data, self.starts, self.ends)
        n = len(self.starts)
        breaks = np.searchsorted(np.flatnonzero(data == 0x0A), self.starts)
        new = np.ones(n, dtype=bool)
        if n:
            new[1:] = breaks[1:] != breaks[:-1]
            heads = self.rows[:-1][np.diff(self.rows) > 0]
            new[heads] = True
        #: word limits of the lines
        self.limits = np.append(np.flatnonzero(new), n)
        last = data[self.ends - 1] if n else np.zeros(0, np.uint8)
        ended = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
        #: words at which a sentence begins; a sentence ends with its line at the latest
        begin = new.copy()
        if n:
            begin[1:] |= ended[:-1]
        self.sentences = np.append(np.flatnonzero(begin), n)
        power = np.full(n + 1, _STEP, dtype=np.uint64)
        back = np.full(n + 1, _BACK, dtype=np.uint64)
        power[0] = back[0] = 1
        power, self.back = np.cumprod(power), np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix64(self.hashes) * power[:n])])
        self.sums2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix64(self.hashes ^ _STEP) * power[:n])])

    def keys(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of the word sequences."""
        n = (end - begin).astype(np.uint64)
        return tuple(T.mix64((s[end] - s[begin]) * self.back[begin] + n).view(np.int64) for s in (self.sums, self.sums2))

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        begin, end = self.limits[:-1], self.limits[1:]
        keep = end - begin >= MIN_WORDS
        return begin[keep], end[keep]

    def passages(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs of whole sentences."""
        if len(self.starts) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = self.sentences[:-1]
        line = np.searchsorted(self.limits, begin, side="right") - 1
        at = np.searchsorted(self.sentences, begin + MIN_PASSAGE)
        end = self.sentences[np.minimum(at, len(self.sentences) - 1)]
        keep = (begin + MIN_PASSAGE <= self.limits[line + 1]) & (end <= self.limits[line + 1])
        return begin[keep], end[keep]

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leader, first and last window (of ``MIN_RUN`` words inside one text) of each piece."""
        n = len(self.starts) - MIN_RUN + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 3
        at = np.arange(len(self.starts) - GRAM + 1)
        grams = self.keys(at, at + GRAM)[0]
        lead = T.window_argmin(grams, MIN_RUN - GRAM + 1)
        windows = np.flatnonzero(at[:n] + MIN_RUN <= np.repeat(self.rows[1:], np.diff(self.rows))[:n])
        lead = lead[windows]
        new = np.ones(len(windows), dtype=bool)
        new[1:] = lead[1:] != lead[:-1]
        head = np.flatnonzero(new)
        return grams[lead[head]], windows[head], windows[np.append(head[1:], len(windows))[:len(head)] - 1]

    def owner(self, word: np.ndarray) -> np.ndarray:
        """The row of the block in which a word lies."""
        return np.searchsorted(self.rows, word, side="right") - 1


def _paragraph_sketches(batches):
    count = ROWS * BANDS
    for b in batches:
        for block in T.blocks(b["text"]):
            x = Lines(block)
            begin, end = x.paragraphs()
            h, out = T.windows(x.hashes, x.limits, SHINGLE)
            long = np.diff(x.limits) >= MIN_WORDS
            lo, hi = out[:-1][long], out[1:][long]
            picked = np.concatenate([h[p:q] for p, q in zip(lo, hi)]) if len(lo) else np.zeros(0, np.uint64)
            r = minima(picked, np.concatenate([[0], np.cumsum(hi - lo)]).astype(np.int64), count)
            k1, k2 = x.keys(begin, end)
            fixed = pa.Array.from_buffers(pa.binary(4 * count), len(begin), [None, pa.py_buffer(np.ascontiguousarray(r).tobytes())])
            ids = b["doc_id"].take(pa.array(x.owner(begin) + block.first))
            yield pa.RecordBatch.from_arrays([ids, pa.array(k1), pa.array(k2), fixed.cast(pa.binary())],
                                             names=["doc_id", "k1", "k2", "registers"])


def _unit_keys(batches):
    """Keys of the sentence runs (no piece) and leaders of the pieces."""
    for b in batches:
        for block in T.blocks(b["text"]):
            x = Lines(block)
            begin, end = x.passages()
            leader, first, last = x.pieces()
            ids = b["doc_id"].take(pa.array(x.owner(np.concatenate([begin, first])) + block.first))
            none = pa.nulls(len(begin), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.concatenate([x.keys(begin, end)[0], leader])),
                 pa.concat_arrays([none, pa.array(x.keys(first, last + MIN_RUN)[0])])], names=["doc_id", "k1", "piece"])


def _spread() -> list[Column]:
    """Aggregates that tell whether several documents hold something."""
    return [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max(F.col("doc_id").isNull()).alias("unnamed")]


SEVERAL = "lo < hi OR (unnamed AND lo IS NOT NULL)"


def paragraph_clusters(rows: DataFrame) -> DataFrame:
    """(k1, k2, cluster) of the paragraph classes whose cluster spans several documents.

    ``rows``: doc_id, text.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = rows.mapInArrow(_paragraph_sketches, f"doc_id {kind}, k1 bigint, k2 bigint, registers binary")
    classes = (seen.groupBy("k1", "k2").agg(*_spread(), F.first("registers").alias("registers"))
               .withColumn("c", F.monotonically_increasing_id()))
    classes = T.materialize(classes, "paragraphs")       # written once: the numbers stay
    members = shared_members(band_rows(classes, 4 * ROWS, BANDS))
    wanted = T.materialize(classes.join(members.select("c").distinct(), "c", "left_semi").select("c", "k1", "k2"), "wanted")
    sets = T.materialize(_paragraph_sets(rows, wanted), "sets")
    found = T.materialize(linked_components(members, sets, lambda pairs: verified(pairs, sets)), "components")
    named = (classes.join(found, F.col("c") == F.col("node"), "left")
             .select("k1", "k2", "lo", "hi", "unnamed", F.coalesce("component", "c").alias("cluster")))
    wide = named.groupBy("cluster").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("unnamed").alias("unnamed"))
    clusters = named.join(wide.where(SEVERAL).select("cluster"), "cluster", "left_semi").select("k1", "k2", "cluster")
    clusters = T.materialize(clusters, "clusters")
    T.release(classes, members, wanted, sets, found)
    return clusters


def _paragraph_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, items) of the wanted classes (c, k1, k2)."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom.bitmap(wanted, "k1"))

    def run(batches):
        found = shared.value
        for b in batches:
            for block in T.blocks(b["text"]):
                x = Lines(block)
                begin, end = x.paragraphs()
                k1, k2 = x.keys(begin, end)
                hit = np.flatnonzero(bloom.maybe(found, k1))
                h, out = T.windows(x.hashes, x.limits, SHINGLE)
                line = np.searchsorted(x.limits, begin[hit])
                # an equal sequence counts once in a block
                _, first = np.unique(np.stack([k1[hit], k2[hit]]), axis=1, return_index=True)
                hit, line = hit[first], line[first]
                sets = [np.unique(h[out[i]:out[i + 1]]).view(np.int64) for i in line.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), pa.array(k2[hit]), T.list_array(sets, pa.int64())],
                                                 names=["k1", "k2", "items"])

    sets = rows.select("text").mapInArrow(run, "k1 bigint, k2 bigint, items array<bigint>")
    return sets.groupBy("k1", "k2").agg(F.first("items").alias("items")).join(wanted, ["k1", "k2"]).select("c", "items")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard similarity reaches the threshold; ``sets``: (c, items)."""
    both = (pairs.join(sets.select(F.col("c").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("c").alias("a"), F.col("items").alias("x")), "a"))
    both = both.withColumn("shared", F.size(F.array_intersect("x", "y")))
    return both.where(f"100 * shared >= {PERCENT} * (size(x) + size(y) - shared)").select("a", "b")


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(k1, run, uniform) of the sentence runs (run) and leaders that several documents hold; uniform: with equal pieces everywhere."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    keys = rows.mapInArrow(_unit_keys, f"doc_id {kind}, k1 bigint, piece bigint")
    held = (keys.groupBy("k1", F.col("piece").isNull().alias("run"))
            .agg(*_spread(), F.min("piece").alias("least"), F.max("piece").alias("most")))
    return held.where(SEVERAL).select("k1", "run", (F.col("run") | (F.col("least") == F.col("most"))).alias("uniform"))


def text_units(rows: DataFrame, clusters: DataFrame, repeated: DataFrame) -> DataFrame:
    """Per text: doc_id, text_key, and the units that may be clustered as arrays: lines (start, end, k1, k2) and
    passages (start, end, key); starts and ends in code points.

    One scan; bitmaps let it leave out most units, exact joins follow.
    """
    context = rows.sparkSession.sparkContext
    maps = [context.broadcast(bloom.bitmap(keys, "k1"))
            for keys in (clusters, repeated.where("run"), repeated.where("NOT run AND uniform"), repeated.where("NOT uniform"))]
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["line_start", "line_end", "line_k1", "line_k2", "unit_start", "unit_end", "unit_key"]
    kinds = dict(zip(names, ["int", "int", "bigint", "bigint", "int", "int", "bigint"]))

    def run(batches):
        clustered, known, uniform, mixed = [m.value for m in maps]
        for b in batches:
            for block in T.blocks(b["text"]):
                x = Lines(block)
                points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])

                def place(begin, end):
                    zero = points[block.offsets[x.owner(begin)]]
                    return [(points[x.starts[begin]] - zero).astype(np.int32), (points[x.ends[end - 1]] - zero).astype(np.int32)]

                begin, end = x.paragraphs()
                hit = bloom.maybe(clustered, x.keys(begin, end)[0])
                begin, end = begin[hit], end[hit]
                own = x.owner(begin)
                columns = [*place(begin, end), *x.keys(begin, end)]
                limits = [np.searchsorted(own, np.arange(len(block) + 1))] * 4
                begin, end = x.passages()
                hit = bloom.maybe(known, x.keys(begin, end)[0])
                leader, first, last = x.pieces()
                each = bloom.maybe(mixed, leader)
                whole = bloom.maybe(uniform, leader) & ~each
                size = (last - first + 1)[each]
                window = np.repeat(first[each] - np.cumsum(size) + size, size) + np.arange(size.sum())
                begin = np.concatenate([begin[hit], first[whole], window])
                end = np.concatenate([end[hit], last[whole] + MIN_RUN, window + MIN_RUN])
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], end[order]
                own = x.owner(begin)
                k1, k2 = x.keys(begin, end)
                # both hashes tell units apart
                key = T.mix64(k1.view(np.uint64) * _STEP + k2.view(np.uint64)).view(np.int64)
                columns += [*place(begin, end), key]
                limits += [np.searchsorted(own, np.arange(len(block) + 1))] * 3
                some = pa.array(np.diff(limits[0]) + np.diff(limits[-1]) > 0)
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(c)) for c, at in zip(columns, limits)]
                rows_ = slice(block.first, block.first + len(block))
                yield pa.RecordBatch.from_arrays([b["doc_id"][rows_], b["text_key"][rows_], *lists],
                                                 names=["doc_id", "text_key", *names]).filter(some)

    lists = ", ".join(f"{n} array<{k}>" for n, k in kinds.items())
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, f"doc_id {kind}, text_key bigint, {lists}")


def line_spans(units: DataFrame, clusters: DataFrame) -> DataFrame:
    """doc_id, text_key, line (start, end, cluster, keeper, kept) of the clustered paragraphs."""
    each = units.select("doc_id", "text_key", F.inline(F.arrays_zip(
        F.col("line_start").alias("start"), F.col("line_end").alias("end"), F.col("line_k1").alias("k1"), F.col("line_k2").alias("k2"))))
    own = T.materialize(each.join(clusters, ["k1", "k2"]).select("doc_id", "text_key", "start", "end", "cluster"), "lines")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "start", "text_key")
    best = own.groupBy("cluster").agg(F.min(first).alias("first"), *_spread()).where(SEVERAL)
    # written, so that the join's sides are plain exchanges and a hot cluster can be split
    best = T.materialize(best.select(F.col("cluster").alias("c"), "first"), "first")
    line = F.struct("start", "end", "cluster", F.col("first.doc_id").alias("keeper"), (first == F.col("first")).alias("kept"))
    return own.join(best, F.col("cluster") == F.col("c")).select("doc_id", "text_key", line.alias("line"))


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each item of a list column, and the items."""
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), n), column.flatten()


def _place(batches):
    """Which units lie free: ``ok`` if clear of removed paragraphs, ``open`` if inside no clustered paragraph."""
    for b in batches:
        row, lines = _flat(b["lines"])
        start, end, kept = (lines.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "kept"))
        at, first = _flat(b["unit_start"])
        first, last = first.to_numpy(zero_copy_only=False).astype(np.int64), b["unit_end"].flatten().to_numpy(zero_copy_only=False)
        # lines of a text do not overlap: the last one that begins before a unit ends decides
        order = np.lexsort((start, row))
        row, start, end, gone = row[order], start[order], end[order], ~kept.astype(bool)[order]
        wide = np.int64(1) << 32
        key = row.astype(np.int64) * wide + start
        ok, open_ = np.ones(len(at), bool), np.ones(len(at), bool)
        if len(key):
            tail = row.astype(np.int64) * wide + end
            lo = np.searchsorted(tail, at * wide + first, side="right")     # the first line that ends behind the unit's start
            hi = np.searchsorted(key, at * wide + last, side="left")        # lines that begin before its end
            removed_before = np.concatenate([[0], np.cumsum(gone)])
            ok = (hi <= lo) | (removed_before[np.maximum(hi, lo)] == removed_before[lo])
            near = np.minimum(lo, len(key) - 1)
            open_ = ~((lo < hi) & (start[near] <= first) & (last <= end[near]))
        limits = pa.array(np.searchsorted(at, np.arange(b.num_rows + 1)).astype(np.int32))
        flags = [pa.ListArray.from_arrays(limits, pa.array(f)) for f in (ok, open_)]
        yield pa.RecordBatch.from_arrays([*b.columns, *flags], names=[*b.schema.names, "unit_ok", "unit_open"])


def placed_units(units: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per text: ``no`` (its place in the order of documents), its clustered lines and units."""
    own = ["doc_id", "text_key"]
    order = units.select(*own).distinct().orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    order = T.materialize(order.withColumn("no", F.monotonically_increasing_id()), "order")
    lists = ["unit_start", "unit_end", "unit_key"]
    parts = (units.select(*own, *lists).unionByName(lines, allowMissingColumns=True).unionByName(order, allowMissingColumns=True))
    texts = parts.groupBy(*own).agg(*[F.first(c, ignorenulls=True).alias(c) for c in lists], F.max("no").alias("no"),
                                    F.collect_set("line").alias("lines"))
    return texts.mapInArrow(_place, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in texts.schema]
                                              + ["unit_ok array<boolean>", "unit_open array<boolean>"]))


def _merged(batches):
    """Spans of each text: passages with one keeper, merged where they overlap."""
    names = ["doc_id", "text_key", "start", "end", "cluster", "keeper", "kept"]
    for b in batches:
        row, units = _flat(b["units"])
        if len(row) == 0:
            continue
        start, end, key, first, ok = (units.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "key", "first", "ok"))
        start, end = start.astype(np.int64), end.astype(np.int64)
        no = b["no"].to_numpy(zero_copy_only=False)[row]
        # removed ones always lead to an occurrence further ahead: what lies before the keeper stays, and what overlaps it
        order = np.lexsort((start, ~ok.astype(bool), key, row))
        r, k = row[order], key[order]
        head = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
        lead = np.empty(len(order), np.int64)
        lead[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        kept = (first < 0) | (no < first) | ((first == no) & (start < end[lead]))
        group = np.where(kept, -1, first)
        order = np.lexsort((end, start, group, row))
        r, g, s, e = row[order], group[order], start[order], end[order]
        head = np.concatenate([[True], (r[1:] != r[:-1]) | (g[1:] != g[:-1])])
        base = np.cumsum(head) << 32
        reach = np.maximum.accumulate(base + e)
        new = head.copy()
        new[1:] |= base[1:] + s[1:] >= reach[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(order)) - 1
        pick = order[at]
        ids = b["doc_id"].take(pa.array(row[pick]))
        keeper = pc.if_else(pa.array(kept[pick]), ids, units.field("keeper").take(pa.array(pick)))
        yield pa.RecordBatch.from_arrays(
            [ids, b["text_key"].take(pa.array(row[pick])), pa.array(s[at]), pa.array((reach - base)[last]), pa.array(key[pick]),
             keeper, pa.array(kept[pick])], names=names)


def _occurrences(batches):
    """A row for each unit; arrays unfold here at a fraction of what Spark's generators take."""
    for b in batches:
        row, key = _flat(b["unit_key"])
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays([b["doc_id"].take(at), b["no"].take(at), key, b["unit_ok"].flatten()],
                                         names=["doc_id", "no", "key", "ok"])


def _open_units(placed: DataFrame, best: DataFrame) -> DataFrame:
    """(no, start, end, key, ok) of the units inside no clustered paragraph, with few whose key is not among ``best`` (b)."""
    shared = placed.sparkSession.sparkContext.broadcast(bloom.bitmap(best, "b"))

    def run(batches):
        found = shared.value
        for b in batches:
            row, key = _flat(b["unit_key"])
            open_ = b["unit_open"].flatten().to_numpy(zero_copy_only=False).astype(bool)
            at = np.flatnonzero(open_ & bloom.maybe(found, key.to_numpy()))
            pick = pa.array(at)
            units = [b[f"unit_{n}"].flatten().take(pick) for n in ("start", "end", "key", "ok")]
            yield pa.RecordBatch.from_arrays([b["no"].take(pa.array(row[at])), *units], names=["no", "start", "end", "key", "ok"])

    return placed.select("no", *[f"unit_{n}" for n in ("start", "end", "key", "ok", "open")]).mapInArrow(
        run, "no bigint, start int, end int, key bigint, ok boolean")


def passage_spans(placed: DataFrame) -> DataFrame:
    """doc_id, text_key, start, end, cluster, keeper, kept of the repeated passages outside clustered paragraphs."""
    kind = placed.schema["doc_id"].dataType.simpleString()
    mine = F.when(F.col("ok"), F.col("doc_id"))
    units = placed.select("doc_id", "no", "unit_key", "unit_ok").mapInArrow(
        _occurrences, f"doc_id {kind}, no bigint, key bigint, ok boolean")
    best = (units.groupBy("key")
            .agg(*_spread(), F.min(F.when(F.col("ok"), F.col("no"))).alias("first"), F.min(mine).alias("keeper"))
            .where(SEVERAL).select(F.col("key").alias("b"), F.coalesce("first", F.lit(-1)).alias("first"), "keeper"))
    best = T.materialize(best, "passages")
    held = _open_units(placed, best).join(best, F.col("key") == F.col("b"))
    per = held.groupBy("no").agg(F.collect_list(F.struct("start", "end", "key", "ok", "first", "keeper")).alias("units"))
    per = per.join(placed.select(F.col("no").alias("n"), "doc_id", "text_key"), F.col("no") == F.col("n")).drop("n")
    return per.mapInArrow(_merged, f"doc_id {kind}, text_key bigint, start bigint, end bigint, cluster bigint, "
                                   f"keeper {kind}, kept boolean")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, passage, start, end, cluster, keeper (document that keeps it), kept: one row for each span
    of a text that also stands in another document."""
    T.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    clusters = paragraph_clusters(rows)
    repeated = T.materialize(repeated_keys(rows), "repeated")
    units = T.materialize(text_units(rows, clusters, repeated), "units")
    placed = T.materialize(placed_units(units, line_spans(units, clusters)), "placed")
    T.release(units, clusters, repeated)
    lines = placed.select("doc_id", "text_key", F.lit(False).alias("passage"), F.inline("lines"))
    lines = lines.withColumns({c: F.col(c).cast("bigint") for c in ("start", "end")})
    runs = passage_spans(placed).withColumn("passage", F.lit(True))
    return lines.unionByName(runs)


def _cut(batches):
    for b in batches:
        out = []
        for t, spans in zip(b["text"], b["spans"]):
            text = t.as_py()
            parts, at = [], 0
            for s in spans.as_py() or []:
                if s["end"] > at:
                    parts.append(text[at:max(at, s["start"])])
                    at = s["end"]
            out.append(text if text is None else "".join([*parts, text[at:]]))
        yield pa.RecordBatch.from_arrays([b["doc"], pa.array(out, type=pa.string())], names=["doc", "text"])


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` without the repeated spans that are kept elsewhere; no row goes, other rows stay as they are."""
    gone = (repeated_spans(docs, id_col, text_col).where("NOT kept").groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
            .select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "spans"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left")
    cut = rows.select("doc", "text", "spans").mapInArrow(_cut, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
    out = cut.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return out
