import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from pondlens.llm import importance as I
from pondlens.llm import queries as Q
from tests.llm.common import docs, lower

TEXTS = ["", None, " \n", "one", "two words", "a b c", "A-B_c D", "Déjà vu Déjà VU x", "0 00 zZ", "日本 語 語",
         "w " * 5000, "x" * 20000, "the cat " * 30, "\x00nul\x7fdel"]


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute(rows, targets):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(bucket(f) for f in features(text))
    for text in targets:
        t.update(bucket(f) for f in features(text))
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = {k: math.floor(1000 * math.log((t[k] + 1.0) * (S + 10000) / ((s[k] + 1.0) * (T + 10000)))) for k in range(10000)}
    out = []
    for i, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        out.append([i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    ready = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(ready[:len(ready) * 5 // 100]):
        r[5] = k + 1
    return sorted(map(repr, out))


def rows_of(df):
    return sorted(repr([r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]]) for r in df.collect())


def corpus():
    rng = np.random.default_rng(5)
    rows = list(enumerate(TEXTS))
    rows += [(100 + i, " ".join(f"w{x}" for x in rng.integers(0, 60, int(rng.integers(1, 120))))) for i in range(200)]
    rows += [(1000 + i, "copies of one text " * 8) for i in range(120)]
    rows += [(77, "a repeated row " * 9)] * 30 + [(None, "no id " * 20), (None, "no id " * 20)]
    return rows


def test_against_brute_force(spark):
    rows, targets = corpus(), ["w1 w2 w3 w4", None, "the cat the cat", "", "w5 w6 " * 50]
    df = docs(spark, [(i, t, "s") for i, t in rows])
    target = spark.createDataFrame([(t, 1) for t in targets], "text string, doc_id int")
    got = I.ranked(df.repartition(5), target)
    assert rows_of(got) == brute(rows, targets)


def test_empty_sides(spark):
    target = spark.createDataFrame([], "text string")
    df = docs(spark, [(1, "b " * 25, "s"), (2, None, "s")])
    assert rows_of(I.ranked(df, target)) == brute([(1, "b " * 25), (2, None)], [])
    assert I.ranked(docs(spark, []), df).count() == 0


def test_resample_returns_whole_rows(spark):
    rows = corpus()
    df = docs(spark, [(i, t, "s") for i, t in rows]).withColumnRenamed("words", "rank").withColumnRenamed("size", "__drawn_id")
    target = spark.createDataFrame([("w1 w2 w3 w4 w5",)], "text string")
    drawn = [r.doc_id for r in I.ranked(df, target).where("rank is not null").collect()]
    out = I.resample(df, target)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == set(drawn) and len(drawn) == len([1 for _, t in rows if len(words(t)) >= 20]) // 20


def test_rows_do_not_run_into_each_other():
    texts = pa.array(["a b", "c", "", "d e f g"], pa.large_string())
    found, n = I.runs(texts)
    want = [[(bucket(" ".join(w[i:i + k])), r) for r, w in enumerate([["a", "b"], ["c"], [], list("defg")])
             for i in range(len(w) - k + 1)] for k in (1, 2, 3)]
    assert [list(zip(*map(np.ndarray.tolist, x))) for x in found] == want and n.tolist() == [2, 1, 0, 4]


def test_slices_change_nothing(spark, monkeypatch):
    texts = pa.array([t for _, t in corpus()], pa.string())
    assert sum(len(x) for x in I._slices(texts)) == len(texts)
    monkeypatch.setattr(I, "SLICE_BYTES", 50)
    assert [t or "" for _, t in corpus()] == [t for x in I._slices(texts) for t in x.to_pylist()]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, sf, "documents").select("doc_id", "text").collect()]
    targets = [r.text for r in Q.table(spark, sf, "benchmark").collect()]
    assert rows_of(Q.QUERIES["op12_importance_draw"](spark, sf)) == brute(rows, targets)
