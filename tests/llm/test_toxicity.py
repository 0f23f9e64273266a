import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pondlens.llm import queries as Q
from pondlens.llm import toxicity as X
from tests.llm.common import docs, lower, write_tables

BAD = ["idiotic", "scumbag", "worthless"]


def corpus(n=1200, seed=1):
    rng = np.random.default_rng(seed)
    vocab = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        w = [vocab[j] for j in rng.integers(0, 300, rng.integers(5, 80))]
        if toxic:
            for _ in range(rng.integers(1, 4)):
                w.insert(int(rng.integers(0, len(w))), str(rng.choice(BAD)).title())
        rows.append((i, " ".join(w) + ".", "s"))
        labels.append((i, toxic))
    return rows, labels


def brute_features(text):
    import re
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    out = {("w", x) for x in w}
    for n in (4, 5, 6):
        out |= {(n, x.encode()[:n]) for x in w if len(x.encode()) > n}
    return out | {("pair", *p) for p in zip(w, w[1:])} | {("skip", *p) for p in zip(w, w[2:])}


def test_features_are_the_distinct_ngrams_and_skipgrams():
    texts = ["One two, TWO three", "", None, "éa" * 9 + " x", "one"]
    col = pa.array(texts, type=pa.string())
    for b in X.T.blocks(col):
        h, row = X.features(b)
        for k, t in enumerate(texts):
            assert len(set(h[row == k].tolist())) == len(brute_features(t or "")), t


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    rows, labels = corpus()
    rows += [(9001, None, None), (9002, "", "s"), (None, "idiotic scumbag", "s"), (9003, "fine " * 60000, "s"),
             (9004, "worthless idiotic", "s"), (9004, "worthless idiotic", "s")]
    lab = spark.createDataFrame([(i, 1, t) for i, t in labels] + [(3, 1, None), (None, None, 1)],
                                "doc_id long, quality int, toxic int")
    path = write_tables(tmp_path_factory.mktemp("tox"), spark, documents=docs(spark, rows), labels=lab)
    return Q.op8_toxicity(spark, path).toPandas(), dict(labels), len(rows), path


def test_held_out_accuracy(scored):
    got, labels, n, _ = scored
    assert len(got) == n and got["score"].between(0, 1).all()
    known = got[got["doc_id"].isin(labels.keys()) & got["held_out"]]
    y = known["doc_id"].map(labels)
    assert len(known) > 200 and (known["predicted"] == y).mean() > 0.97
    ids = got["doc_id"].dropna()
    assert (got.loc[ids.index, "held_out"] == [zlib.crc32(str(int(i)).encode()) % 4 == 2 for i in ids]).all()


def test_edge_rows(scored):
    got = scored[0]
    by = got.set_index("doc_id")["score"]
    assert by[9001] == by[9002] < X.THRESHOLD and by[9003] < X.THRESHOLD
    assert (by[9004] >= X.THRESHOLD).all() and len(by[9004]) == 2
    none = got[got["doc_id"].isna()].iloc[0]
    assert none["predicted"] == 1 and not none["held_out"]


def test_held_out_labels_do_not_matter(spark, scored, tmp_path):
    got, _, _, path = scored
    documents, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = Q.op8_toxicity(spark, write_tables(tmp_path, spark, documents=documents, labels=flipped)).toPandas()
    key = ["doc_id", "score", "predicted"]
    assert again[key].sort_values(key, ignore_index=True).equals(got[key].sort_values(key, ignore_index=True))


def test_no_labels_and_empty(spark):
    df = docs(spark, [(1, "idiotic", "s"), (2, "fine", "s")])
    none = spark.createDataFrame([], "doc_id long, label int")
    model = X.train(df, none)
    assert {r.score for r in X.score(df, model).collect()} == {0.0}
    assert X.score(docs(spark, []), model).count() == 0
