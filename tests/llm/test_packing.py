import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pondlens.llm import packing as P
from pondlens.llm import queries as Q
from tests.llm.common import docs

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "one", "Déjà vu  twice\n\nonce", "a b \x1c c\x85d", "<|endoftext|> and <|startoftext|>x", "é é ́x",
         "ΣΑΣ ΣΑΣ", "日本語 テキスト", "x" * 3000, "don't we'll 12345", "\t \n", "word " * 2047, "word " * 2048, "many words here " * 4000]


def corpus():
    rng = np.random.default_rng(11)
    rows = list(enumerate(TEXTS))
    rows += [(100 + i, " ".join(f"w{x}" for x in rng.integers(0, 99, int(rng.integers(1, 900)))), "s") for i in range(150)]
    rows += [(1000 + i, "the same short text", "hot") for i in range(200)]
    rows += [(7, "repeated row"), (7, "repeated row"), (None, "no id")]
    return [(r[0], r[1], "s") for r in rows]


def brute(rows, size=P.SIZE):
    t = Tokenizer.from_file(PATH)
    out = []
    for i, text, _ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), size):
            got = ids[k:k + size]
            out.append((i, k // size, k, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
    return out


def best_fit(lengths, size):
    """Best fit decreasing, piece by piece: how full each sequence is."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(size - n)
    return sorted(room)


def test_pieces_and_places(spark):
    rows = corpus()
    got = P.pack(docs(spark, rows), PATH).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    mine = got[key].astype(object).where(got[key].notna(), None)
    assert sorted(map(repr, ((None if i is None else int(i), *map(int, r)) for i, *r in mine.itertuples(index=False)))) == sorted(
        map(repr, brute(rows)))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= P.SIZE
    full = got.groupby("sequence_id")["length"].sum()
    assert sorted(P.SIZE - full) == best_fit(got["length"].tolist(), P.SIZE)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_piece_by_piece(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(5, 60))
    lengths = rng.integers(1, size + 1, int(rng.integers(1, 600)))
    if seed % 2:
        lengths = np.minimum(lengths, rng.geometric(0.2, len(lengths)))
    counts = Counter(lengths.tolist())
    steps = P.plan(counts, size)
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    length = np.repeat(list(counts), list(counts.values()))
    s, o = P.slots(steps, length, rank)
    room = []
    for k in np.unique(s):
        at = np.argsort(o[s == k], kind="stable")
        assert o[s == k][at].tolist() == [0, *np.cumsum(length[s == k][at]).tolist()[:-1]]
        room.append(size - int(length[s == k].sum()))
    assert sorted(room) == best_fit(lengths.tolist(), size)


def test_plan_does_not_grow_with_the_documents():
    counts = {n: 1 + 5000 // n for n in range(1, 200)}
    small, large = P.plan(counts), P.plan({n: 10_000 * c for n, c in counts.items()})
    assert len(large) < 3 * len(small) + 600
    assert P.plan({}).shape == (0, 5)


def test_sequences_give_the_documents_back(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    t = Tokenizer.from_file(PATH)
    found = {}
    for s in P.sequences(docs(spark, rows), PATH).collect():
        at = 0
        for p in s["pieces"]:
            found[(p["doc_id"], p["start"])] = s["ids"][at:at + p["length"]]
            at += p["length"]
        assert at == len(s["ids"]) <= P.SIZE
    for i, text, _ in rows:
        ids = [x for k in sorted(k for k in found if k[0] == i) for x in found[k]]
        assert ids == t.encode(text or "", add_special_tokens=False).ids + [0]


def test_forgetting_changes_nothing(spark, monkeypatch):
    rows = corpus()[:60]
    encoder = P.Encoder(open(PATH, encoding="utf-8").read(), limit=5)
    import pyarrow as pa
    for text in (r[1] for r in rows):
        ids, ranges = encoder.encode(pa.array([text, None], pa.string()))
        assert ids.tolist() == Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids if len(text or "") < 200 else True
        assert ranges.tolist() == [0, len(ids), len(ids)]


def test_empty_table(spark):
    assert P.pack(docs(spark, []), PATH).count() == 0


def test_registered_query(spark):
    got = Q.QUERIES["op11_best_fit_packing"](spark, "/root/testdata/sf0.001").toPandas()
    source = Q.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    want = brute([(r.doc_id, r.text, None) for r in source])
    assert sorted(zip(*[got[c].astype(int) for c in ("doc_id", "piece", "start", "length", "ids_crc32")])) == sorted(want)
    full = got.groupby("sequence_id")["length"].sum()
    assert sorted(P.SIZE - full) == best_fit(got["length"].tolist(), P.SIZE)
