"""Aligning the tokens of two tokenizers, and the corpus-wide links between their ids.

A byte-level BPE (A) encodes a blank and the text, a piece model (B) encodes
the text and adds the blank itself, so both cover the same bytes. Offsets where
a token of A and one of B both end cut the tokens into groups; every A and B
token of a group are linked.

Groups come from the two arrays of token ends by diagonal run skipping: at the
current index shift, slices that double in length are compared until they
differ, so stretches of one-to-one tokens are jumped; the irregular group that
follows is closed by advancing the array that lags, which gives the new shift.

Neither tokenizer joins tokens over a single blank between two characters that
are no white space, and both end a token there. Texts are therefore cut at
these blanks, and each distinct stretch is encoded and aligned once, until the
stretches that a task remembers reach a bound and are forgotten.

1. One narrow pass encodes and aligns the texts and writes each document's sums,
   the hash of its groups, and its distinct linked pairs of ids.
2. The written pairs are counted: tasks send each pair once for many documents,
   Spark sums them and marks those with the highest count of their A id.
3. A pass over the written pairs adds the counts up for each document. The
   counts are broadcast if there are at most ``max_pairs``; beyond, the pairs
   are joined with them.

Texts that are null or empty, or that either tokenizer does not give back byte
by byte, have no tokens. Null ids and repeated rows are rows like any other; an
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pondlens.llm import textops as T

#: Distinct stretches, and links of theirs, that a task remembers.
MAX_STRETCHES = 250_000
MAX_LINKS = 4_000_000
#: Distinct pairs that a task counts before it sends them.
MAX_COUNTED = 4_000_000
#: Pairs of ids that are broadcast (17 bytes each); more are joined.
MAX_PAIRS = 4_000_000
#: Stretches that are encoded as one text, and that are learnt in one step.
JOINED = 500
STEP = 20_000
#: Groups of more links than this are multiplied out by distinct ids.
LARGE_GROUP = 4096
BLANK = re.compile(r"(?<=\S) (?=\S)")


def align_ends(a: list[int], b: list[int]) -> np.ndarray:
    """Groups of two strictly growing lists of ends with the same last one.

    Rows (i, j, n): n groups end before token i of ``a`` and j of ``b``, then
    before i + 1 and j + 1, and so on.
    """
    out: list[tuple[int, int, int]] = []
    i = j = 0
    n_a, n_b = len(a), len(b)
    while i < n_a and j < n_b:
        first_i, first_j, step = i, j, 1
        while True:
            x, y = a[i:i + step], b[j:j + step]
            if x != y or not x:
                break
            i, j, step = i + len(x), j + len(x), step * 2
        for u, v in zip(x, y):
            if u != v:
                break
            i, j = i + 1, j + 1
        if i > first_i:
            out.append((first_i + 1, first_j + 1, i - first_i))
        if i == n_a or j == n_b:
            break
        u, v = a[i], b[j]
        while u != v:
            if u < v:
                i += 1
                u = a[i]
            else:
                j += 1
                v = b[j]
        i, j = i + 1, j + 1
        out.append((i, j, 1))
    return np.array(out, np.int64).reshape(-1, 3)


def group_ends(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where each group ends, in tokens of ``a`` and of ``b``."""
    i, j, n = align_ends(a, b).T
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(i, n) + within, np.repeat(j, n) + within


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each of ``n`` steps."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def write_numbers(values: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The decimal numbers, each followed by its byte of ``after``, and where each of these ends."""
    digits = np.ones(len(values), np.int64)
    power = 10
    while len(values) and power <= values.max():
        digits += values >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = after
    for d in range(int(digits.max()) if len(digits) else 0):
        has = digits > d
        out[ends[has] - 2 - d] = 48 + values[has] // 10 ** d % 10
    return out.tobytes(), ends


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    hidden = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, and the aligned stretches a task remembers."""

    def __init__(self, model_a: str, model_b: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model_b)
        byte = byte_alphabet()
        special = set(self.a.get_added_tokens_decoder())
        names = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        self.bytes_a = [n.encode() if i in special or not all(c in byte for c in n) else bytes(byte[c] for c in n)
                        for i, n in enumerate(names)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.shift = len(pieces).bit_length()
        self.bits = self.shift + len(names).bit_length()
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.written: list[bytes] = []                  # the groups of each stretch
        self.sums = np.zeros((0, 5), np.int64)          # tokens of A and of B, groups, links, whole (0 or 1)
        self.ends = np.zeros(1, np.int64)               # limits of each stretch's links
        self.links, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.place) > MAX_STRETCHES or len(self.links) > MAX_LINKS

    def _encode(self, units: list[list[str]]) -> list[tuple[list[str], list[int], list[int]]]:
        """(stretches, ids of A, ids of B) of each unit; what is not given back byte by byte has no ids."""
        texts = ["".join(u) for u in units]
        in_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        in_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for unit, text, x, y in zip(units, texts, in_a, in_b):
            raw = text.encode()
            if b"".join(map(self.bytes_a.__getitem__, x)) == raw == b"".join(map(self.bytes_b.__getitem__, y)):
                out.append((unit, x, y))
            elif len(unit) > 1:
                out += self._encode([[s] for s in unit])
            else:
                out.append((unit, [], []))
        return out

    def _learn(self, new: list[str]) -> None:
        # a stretch that begins or ends with white space of its own stands alone
        plain, alone = [], []
        for s in new:
            (alone if s[-1].isspace() or s[1].isspace() else plain).append(s)
        units = [plain[k:k + JOINED] for k in range(0, len(plain), JOINED)] + [[s] for s in alone]
        got = self._encode(units)
        whole = [u for u in got if u[1]]
        bad = [s for u, x, _ in got if not x for s in u]
        stretches = [s for u, _, _ in whole for s in u]
        ids_a = np.fromiter(chain.from_iterable(u[1] for u in whole), np.int64)
        ids_b = np.fromiter(chain.from_iterable(u[2] for u in whole), np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        limits = np.cumsum(np.fromiter((len(s.encode()) for s in stretches), np.int64, len(stretches)))
        gi, gj = group_ends(ends_a.tolist(), ends_b.tolist())
        p, q = np.diff(gi, prepend=0), np.diff(gj, prepend=0)
        # groups of each stretch: both tokenizers end a token where a stretch ends
        group = np.searchsorted(ends_a[gi - 1], limits, side="right") if len(gi) else np.zeros(0, np.int64)
        n = np.diff(group, prepend=0)
        of_group = np.repeat(np.arange(len(stretches)), n)
        self._remember(stretches, bad, ids_a, ids_b, gi, gj, p, q, group, of_group)

    def _remember(self, stretches, bad, ids_a, ids_b, gi, gj, p, q, group, of_group) -> None:
        many = len(stretches)
        # in writing, a group's B tokens follow its A tokens
        at_a = np.arange(len(ids_a)) + np.repeat(gj - q, p)
        at_b = np.arange(len(ids_b)) + np.repeat(gi, q)
        values, after = np.zeros(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        values[at_a], values[at_b] = ids_a, ids_b
        after[at_a[gi - 1]], after[at_b[gj - 1]] = ord("|"), ord(";")
        text, ends = write_numbers(values, after)
        stops = ends[at_b[gj[group - 1] - 1]].tolist() if many else []
        starts = [0, *stops[:-1]]
        self.place.update(zip(stretches + bad, range(len(self.place), len(self.place) + many + len(bad))))
        self.written += [text[x:y - 1] for x, y in zip(starts, stops)] + [b""] * len(bad)
        cost = p * q
        per = [np.bincount(of_group, w, many).astype(np.int64) for w in (p, q, np.ones(len(p)), cost)]
        sums = np.stack([*per, np.ones(many, np.int64)], axis=1)
        self.sums = np.concatenate([self.sums, sums, np.zeros((len(bad), 5), np.int64)])
        small = np.flatnonzero(cost <= LARGE_GROUP)
        n = cost[small]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(q[small], n)
        left = ids_a[np.repeat((gi - p)[small], n) + nth // wide] if len(wide) else nth
        right = ids_b[np.repeat((gj - q)[small], n) + nth % wide] if len(wide) else nth
        owner, links, times = [np.repeat(of_group[small], n)], [left << self.shift | right], [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(cost > LARGE_GROUP).tolist():
            x, n_x = np.unique(ids_a[gi[g] - p[g]:gi[g]], return_counts=True)
            y, n_y = np.unique(ids_b[gj[g] - q[g]:gj[g]], return_counts=True)
            links.append((x[:, None] << self.shift | y).ravel())
            times.append((n_x[:, None] * n_y).ravel())
            owner.append(np.full(len(links[-1]), of_group[g]))
        owner, links, times = map(np.concatenate, (owner, links, times))
        order = np.argsort(owner, kind="stable")
        self.links, self.times = np.append(self.links, links[order]), np.append(self.times, times[order])
        n = np.append(np.bincount(owner, minlength=many).astype(np.int64), np.zeros(len(bad), np.int64))
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(n))

    def stretches(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's stretches, by their numbers; none if a text has no tokens."""
        cut = [[" " + s for s in BLANK.split(t)] if t else [] for t in texts]
        new = [s for s in dict.fromkeys(chain.from_iterable(cut)) if s not in self.place]
        for k in range(0, len(new), STEP):
            self._learn(new[k:k + STEP])
        out = [np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts)) for parts in cut]
        return [n if self.sums[n, 4].all() else n[:0] for n in out]

    def pairs(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, a, b, times) of the documents' distinct pairs, in order."""
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        flat = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        keys, many = np.unique(doc * max(len(self.place), 1) + flat, return_counts=True)
        doc, flat = keys // max(len(self.place), 1), keys % max(len(self.place), 1)
        n = self.ends[flat + 1] - self.ends[flat]
        at = _spread(self.ends[flat], n)
        key, times = np.repeat(doc, n) << self.bits | self.links[at], np.repeat(many, n) * self.times[at]
        order = np.argsort(key)
        key, times = key[order], times[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times, first) if len(first) else times
        key = key[first]
        pair = key & (1 << self.bits) - 1
        return key >> self.bits, pair >> self.shift, pair & (1 << self.shift) - 1, times


def _models(spark: SparkSession, path_a: str, path_b: str) -> Broadcast:
    """Both vocabulary files, for executors that lack them (a few MB)."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


_SUMS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
            written: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 ('' without tokens), and the distinct linked
    pairs of ids as three arrays: a, b and times.

    ``written`` adds groups: ``a1,a2|b1;a3|b2,b3`` with the ids in order.
    """
    T.bound_batches(docs.sparkSession)
    box = _models(docs.sparkSession, path_a, path_b)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        pair = Pair(*box.value)
        for b in batches:
            if pair.full():
                pair.clear()
            found = pair.stretches(b["text"].to_pylist())
            sums = np.array([pair.sums[d, :4].sum(axis=0) for d in found], np.int64).reshape(-1, 4)
            groups = [b";".join([pair.written[k] for k in d.tolist()]) for d in found]
            doc, *columns = pair.pairs(found)
            limits = pa.array(np.searchsorted(doc, np.arange(len(found) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(limits, pa.array(c, pa.int32())) for c in columns]
            sha = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string())
            more = [pa.array(groups, pa.binary()).cast(pa.string())] if written else []
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c) for c in sums.T.copy()], sha, *lists, *more], names=names)

    names = ["doc_id", *_SUMS, "groups_sha256", "a", "b", "times"] + ["groups"] * written
    kinds = [rows.schema["doc_id"].dataType.simpleString(), *["long"] * 4, "string", *["array<int>"] * 3, "string"]
    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _flat(b: pa.RecordBatch, column: str) -> np.ndarray:
    return b[column].flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per linked pair of ids: a, b, n (rows of ``pairs`` that hold it) and best (n is the highest of its a)."""
    def run(batches):
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            new, many = np.unique(_flat(b, "a") << 32 | _flat(b, "b"), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, many]), len(keys)).astype(np.int64)
            if len(keys) > MAX_COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])
                keys, n = keys[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    T.bound_batches(pairs.sparkSession)
    total = pairs.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    total = total.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")
    # a window holds the partners of one id: at most the vocabulary of B
    return total.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def _by_broadcast(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """``pairs`` with n_best and count_sum; ``counts`` (of a checked size) goes into every task."""
    table = counts.select(F.shiftleft(F.col("a"), 32).bitwiseOR(F.col("b")).alias("pair"), "n", "best").toArrow()
    order = np.argsort(table["pair"].to_numpy())
    known = pairs.sparkSession.sparkContext.broadcast(
        tuple(table[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")))
    keep = ["doc_id", *_SUMS, "groups_sha256"]

    def run(batches):
        keys, n, best = known.value
        for b in batches:
            place = np.searchsorted(keys, _flat(b, "a") << 32 | _flat(b, "b"))
            times, limits = _flat(b, "times"), np.append(0, np.cumsum(b["times"].value_lengths().to_numpy(zero_copy_only=False)))
            sums = [np.diff(np.append(0, np.cumsum(times * x[place]))[limits]) for x in (best, n)]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], *map(pa.array, sums)], names=[*keep, "n_best", "count_sum"])

    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in keep)
    return pairs.mapInArrow(run, f"{kinds}, n_best long, count_sum long")


def _by_join(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """``pairs`` with n_best and count_sum, by a join with ``counts`` of any size."""
    # the number of a row is written with it, so that it stays when a task is repeated
    each = T.materialize(pairs.withColumn("rid", F.monotonically_increasing_id()), "numbered")
    links = each.select("rid", F.explode(F.arrays_zip("a", "b", "times")).alias("x")).select("rid", "x.a", "x.b", "x.times")
    sums = links.join(counts, ["a", "b"]).groupBy(F.col("rid").alias("r")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    out = each.join(sums, F.col("rid") == F.col("r"), "left")
    return out.select("doc_id", *_SUMS, "groups_sha256", *zero)


def digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
           max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 ('' without tokens).

    n_best counts the links whose pair stands in as many documents as any pair
    of its A id; count_sum adds up the documents of all links' pairs.
    """
    pairs = T.materialize(aligned(docs, path_a, path_b, id_col, text_col), "pairs")
    counts = T.materialize(pair_counts(pairs), "pair_counts")
    found = (_by_broadcast if counts.count() <= max_pairs else _by_join)(pairs, counts)
    return found.select("doc_id", *_SUMS, "n_best", "count_sum", "groups_sha256")
