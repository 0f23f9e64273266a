"""Best-fit packing of tokenized documents, planned on the histogram of lengths.

1. Documents are encoded, ended by one id, and cut into pieces of at most
   ``size`` ids (only longer ones are cut). White space ends every token of the
   tokenizer, so each distinct stretch between white space is encoded once, until
   the stretches that a task remembers reach a bound and are forgotten. A piece
   carries its task and its number among the task's pieces of its length.
2. The plan needs only how many pieces there are of each length: at most
   ``size`` numbers reach the driver. Best fit decreasing runs over counts:
   equal pieces that meet equally full sequences are placed as one step, so the
   plan has one entry for each step, whatever the number of documents. A step
   says: pieces ``first`` to ``first + n`` of this length go, ``each`` at a
   time, into consecutive sequences from ``sequence`` on, at ``offset``.
3. A piece's rank within its length is its number in its task plus the counts
   of the tasks before; rank and length give its slot. Neither texts nor ids
   move for that, and no length, however common, is gathered.

Null texts count as empty; an empty text is the end id alone. Null ids and rows
that repeat are packed like any other row; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain, repeat
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pondlens.llm import textops as T
from pondlens.llm.token_alignment import byte_alphabet

SIZE = 2048
END_ID = 0
#: Distinct stretches of text whose ids a task remembers.
MAX_STRETCHES = 1_000_000
#: Stretches that are encoded as one text.
JOINED = 1000


class Encoder:
    """Ids of texts from a tokenizer that never joins tokens over white space."""

    def __init__(self, model: str, limit: int = MAX_STRETCHES):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.limit = Tokenizer.from_str(model), limit
        byte = byte_alphabet()
        special = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        names = [self.tokenizer.id_to_token(i).removesuffix("</w>") for i in range(self.tokenizer.get_vocab_size())]
        #: What an id stands for (a byte-level vocabulary, whose last piece of a word carries a mark).
        self.bytes = [special[i] if i in special else bytes(byte[c] for c in n) for i, n in enumerate(names)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _units(self, stretches: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Stretches (in a new order), their ids, and where each one's ids end.

        Joined stretches are told apart by the bytes that their normalised form
        should have; where the tokens are others, each stretch is encoded alone.
        """
        units = [stretches[k:k + JOINED] for k in range(0, len(stretches), JOINED)]
        joined = [" ".join(u) for u in units]
        first, alone, ids, ends, n = [], [], [], [], 0
        for unit, text, e in zip(units, joined, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            plain = normalize("NFC", text).lower()
            size = list(map(len, unit if plain.isascii() else (w.encode() for w in plain.split(" "))))
            own = e.ids
            if b"".join(map(self.bytes.__getitem__, own)) == plain.replace(" ", "").encode() and len(size) == len(unit):
                ends.append(np.searchsorted(np.cumsum(self.size[own]), np.cumsum(size)) + 1 + n)
                ids.append(own)
                n += len(own)
                first += unit
            else:
                alone += unit
        more = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        ends.append(n + np.cumsum([len(g) for g in more], dtype=np.int64))
        return first + alone, np.fromiter(chain.from_iterable(ids + more), np.uint32), np.concatenate(ends)

    def _learn(self, new: list[str]) -> None:
        for group in ([s for s in new if s.isascii()], [s for s in new if not s.isascii()]):
            group, ids, ends = self._units(group)
            self.place.update(zip(group, range(len(self.place), len(self.place) + len(group))))
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.append(self.ends, self.ends[-1] + ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and each text's range of ids (n + 1)."""
        if len(self.place) > self.limit:
            self.clear()
        parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        flat, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
        real = pc.not_equal(flat, "")
        flat, row = flat.filter(real), row.filter(real).to_numpy(zero_copy_only=False)
        enc = pc.dictionary_encode(flat)
        names = enc.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter(map(self.place.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(known < 0).tolist()
        if new:
            names = [names[k] for k in new]
            self._learn(names)
            known[new] = list(map(self.place.__getitem__, names))
        at = known[enc.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.int64)
        n = self.ends[at + 1] - self.ends[at]
        stops = np.cumsum(n)
        ids = self.ids[np.repeat(self.ends[at] - (stops - n), n) + np.arange(n.sum())]
        per_row = np.bincount(row, weights=n, minlength=len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_row)])


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, task, nth (and ids).

    ``nth`` counts the pieces of this length in the task from 0, so the table
    has to be written before it is used (``pack`` does).
    """
    spark = docs.sparkSession
    T.bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        box = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("task"))

    def run(batches):
        encoder, seen = Encoder(box.value), np.zeros(size + 1, np.int64)
        for b in batches:
            ids, ranges = encoder.encode(b["text"])
            total = np.diff(ranges) + 1
            count = -(-total // size)
            doc = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * size
            length = np.minimum(total[doc] - start, size)
            crc, own, nth = [], [], np.zeros(len(doc), np.int64)
            for k, (d, s, n) in enumerate(zip(doc.tolist(), start.tolist(), length.tolist())):
                got = ids[ranges[d] + s:min(ranges[d] + s + n, ranges[d + 1])]
                if len(got) < n:
                    got = np.append(got, np.uint32(end_id))
                crc.append(zlib.crc32(got.astype("<u4").tobytes()))
                nth[k] = seen[n]
                seen[n] += 1
                if with_ids:
                    own.append(got)
            cols = [b["doc_id"].take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), b["task"].take(pa.array(doc)), pa.array(nth)]
            if with_ids:
                cols.append(T.list_array([x.astype(np.int32) for x in own], pa.int32()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    schema += ", ids array<int>" if with_ids else ""
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(run, schema)


def plan(counts: dict[int, int], size: int = SIZE) -> np.ndarray:
    """Best fit decreasing over counts: rows (length, first, sequence, each, offset), by length and first.

    Sequences that are equally full are kept as ranges of numbers, by free
    space. A range is split only where a length runs out of pieces, so there are
    at most three new ranges a length.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    steps, opened = [], 0
    for length in range(size, 0, -1):
        n, first = counts.get(length, 0), 0

        def place(sequence: int, many: int, room: int) -> int:
            """Fill sequences with ``room`` left; returns how many got pieces."""
            nonlocal first
            each, used = room // length, 0
            for times, k in ((min(many, (n - first) // each), each), (1, (n - first) % each)):
                if times and k and used < many and first < n:
                    steps.append((length, first, sequence + used, k, size - room))
                    free[room - k * length].append((sequence + used, times))
                    first += times * k
                    used += times
            return used

        for room in range(length, size):
            while free[room] and first < n:
                sequence, many = free[room].pop()
                used = place(sequence, many, room)
                if used < many:
                    free[room].append((sequence + used, many - used))
            if first >= n:
                break
        if first < n:
            opened += place(opened, -(-(n - first) // (size // length)), size)
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def slots(steps: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks."""
    out_s, out_o = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    for n in np.unique(length):
        mine = steps[np.searchsorted(steps[:, 0], n):np.searchsorted(steps[:, 0], n, side="right")]
        at = np.flatnonzero(length == n)
        step = mine[np.searchsorted(mine[:, 1], rank[at], side="right") - 1]
        k = rank[at] - step[:, 1]
        out_s[at], out_o[at] = step[:, 2] + k // step[:, 3], step[:, 4] + k % step[:, 3] * n
    return out_s, out_o


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (a written table of ``pieces``) with sequence_id and offset in place of task and nth."""
    per_task = T.materialize(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    box = cut.sparkSession.sparkContext.broadcast(plan(counts, size))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    first = per_task.select(F.col("length").alias("l"), F.col("task").alias("t"), before.alias("first"))
    ranked = cut.join(first, (F.col("length") == F.col("l")) & (F.col("task") == F.col("t")))
    keep = [c for c in cut.columns if c not in ("task", "nth")]
    ranked = ranked.select(*keep, (F.col("first") + F.col("nth")).alias("rank"))

    def run(batches):
        steps = box.value
        for b in batches:
            s, o = slots(steps, b["length"].to_numpy(zero_copy_only=False), b["rank"].to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], pa.array(s), pa.array(o)],
                                             names=[*keep, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in keep)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    cut = T.materialize(pieces(docs, tokenizer_path, id_col, text_col, size, end_id, with_ids), "pieces")
    return place(cut, size)


def sequences(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """The packed sequences: sequence_id, ids (at most ``size``), and each piece's doc_id, start and length in order."""
    packed = pack(docs, tokenizer_path, with_ids=True, **options)
    rows = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"))
    part = F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"),
                                               x["length"].alias("length")))
    return rows.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), part.alias("pieces"))
