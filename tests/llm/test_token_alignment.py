import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pondlens.llm import queries as Q
from pondlens.llm import token_alignment as A
from tests.llm.common import docs

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, "one", " lead", "trail ", "two  blanks", "tab\there", "line\n\nbreak \n mixed", "a b  c  d   e", " ", "\n",
         "<s> </s> <unk> <0x41> <|endoftext|>", "under▁score", "▁", "Déjà é", "日本語のテキスト です", "\U0001f600 \U0001f468‍\U0001f469 x",
         "\x00 nul\x00", "x\x1cy \x1c z\x85w \x85", "don't we'll 12345 3.14", "ThisIsCamelCase unbelievableness", "ﬁ ½ Å", "a" * 3000, "word " * 3000,
         "　full width", "\r\n crlf\r\n"]


def models():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATHS[1])


def groups_of(a, b, text):
    """Groups of whole texts, by sets of ends."""
    char = A.byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [bytes(char[c] for c in a.id_to_token(i)) for i in ids_a]
    parts_b = []
    for i in ids_b:
        p = b.id_to_piece(i)
        parts_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
    raw = (" " + text).encode()
    if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return []
    ends_a, ends_b = np.cumsum([len(p) for p in parts_a]), np.cumsum([len(p) for p in parts_b])
    both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
    return [([i for i, g in zip(ids_a, group_a) if g == k], [i for i, g in zip(ids_b, group_b) if g == k]) for k in range(len(both))]


def brute(rows):
    a, b = models()
    every = [groups_of(a, b, t) if t else [] for _, t in rows]
    links = [Counter((x, y) for p, q in g for x in p for y in q) for g in every]
    n = Counter(k for c in links for k in c)
    top = defaultdict(int)
    for (x, _), c in n.items():
        top[x] = max(top[x], c)
    out = []
    for (i, _), g, c in zip(rows, every, links):
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g)
        out.append((i, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), sum(c.values()),
                    sum(m for k, m in c.items() if n[k] == top[k[0]]), sum(m * n[k] for k, m in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(map(repr, out))


def corpus():
    rng = np.random.default_rng(2)
    names = ["alpha", "Βήτα", "gamma-ray", "dé", "un" + "der" * 3, "x1", "▁", "日本", "a  b", "\n"]
    p = [.2, .1, .1, .1, .1, .2, .01, .09, .05, .05]
    rows = list(enumerate(TEXTS))
    rows += [(100 + i, " ".join(rng.choice(names, int(rng.integers(1, 40)), p=p))) for i in range(80)]
    rows += [(500 + i, "the same text in many copies, unbelievably") for i in range(60)]
    return rows + [(7, "again"), (7, "again"), (None, "no id")]


@pytest.mark.parametrize("max_pairs", [A.MAX_PAIRS, 0])
def test_against_brute_force_by_broadcast_and_by_join(spark, max_pairs):
    rows = corpus()
    df = docs(spark, [(i, t, "s") for i, t in rows]).repartition(3)
    got = A.digest(df, *PATHS, max_pairs=max_pairs)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_forgetting_changes_nothing(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(A, "MAX_STRETCHES", 10)
    monkeypatch.setattr(A, "MAX_LINKS", 50)
    monkeypatch.setattr(A, "MAX_COUNTED", 50)
    monkeypatch.setattr(A, "LARGE_GROUP", 2)
    monkeypatch.setattr(A, "JOINED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    df = docs(spark, [(i, t, "s") for i, t in rows]).coalesce(1)
    assert sorted(repr(tuple(r)) for r in A.digest(df, *PATHS).collect()) == brute(rows)


@pytest.mark.parametrize("seed", range(20))
def test_groups_of_random_ends(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 400))
    # long one-to-one stretches between irregular ones
    cuts = np.sort(rng.choice(np.arange(1, size + 1), int(rng.integers(1, size + 1)), replace=False))
    a, b = ({*cuts[rng.random(len(cuts)) < keep].tolist(), size} for keep in (rng.uniform(.5, 1), rng.uniform(.5, 1)))
    a, b = sorted(a), sorted(b)
    both = sorted(set(a) & set(b))
    i, j = A.group_ends(a, b)
    assert list(zip(i.tolist(), j.tolist())) == [(a.index(e) + 1, b.index(e) + 1) for e in both]
    assert A.align_ends([], []).shape == (0, 3)


def test_one_to_one_stretches_are_jumped():
    ends = list(range(1, 100_001))
    assert A.align_ends(ends, ends).tolist() == [[1, 1, 100_000]]
    shifted = [e for e in ends if e != 50_000]
    assert A.align_ends(ends, shifted).tolist() == [[1, 1, 49_999], [50_001, 50_000, 1], [50_002, 50_001, 49_999]]


def test_written_groups(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    a, b = models()
    got = {r.doc_id: r for r in A.aligned(docs(spark, [(i, t, "s") for i, t in rows]), *PATHS, written=True).collect()}
    for i, t in rows:
        g = groups_of(a, b, t) if t else []
        assert got[i].groups == ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g), t


def test_no_piece_reaches_over_a_blank():
    _, b = models()
    assert not [p for p in map(b.id_to_piece, range(b.get_piece_size())) if "▁" in p.lstrip("▁")]


def test_empty_table(spark):
    assert A.digest(docs(spark, []), *PATHS).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sorted(repr(tuple(r)) for r in Q.QUERIES["op13_token_alignment"](spark, sf).collect()) == brute(rows)
