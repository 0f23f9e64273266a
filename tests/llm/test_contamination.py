import re

import pytest
from pyspark.sql import functions as F

from pondlens.llm import contamination as C
from tests.llm.common import docs, lower

ITEM = " ".join(f"alpha{i}" for i in range(24))
SHORT = "only three words"
ITEMS = [(1, ITEM), (2, SHORT), (3, None), (4, ""), (5, " ".join(f"b{i}" for i in range(60))), (5, " ".join(f"b{i}" for i in range(60))),
         (None, "null id item with six words"), (6, "five words make one shingle")]
FILL = " ".join(f"f{i % 997}" for i in range(30000))


def near(k):
    """The item with its last k words gone."""
    return " ".join(ITEM.split()[:24 - k])


DOCS = [(1, f"{FILL} {ITEM.upper()}, {FILL}", "a"), (2, near(5), "a"), (3, near(6), "a"), (4, None, None), (5, "", ""),
        (6, "Only, three... WORDS", "a"), (7, "only three words more", "a"), (8, FILL, "a"), (None, ITEM, None),
        (9, f"x {ITEM} y", "hot"), (9, f"x {ITEM} y", "hot"), (10, "null id item with six words", "a"),
        (11, "see five words\nmake one shingle here", "a"),
        (12, " ".join(f"b{i}" for i in range(60)) + " " + ITEM, "a")] + [(100 + i, ITEM + f" {i}", "hot") for i in range(20)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(rows, items):
    out = set()
    for d, t, _ in rows:
        for i, x in items:
            k = min(5, len(words(x)))
            s, y = shingles(words(t), k), shingles(words(x), k)
            if y and len(s & y) >= 0.75 * len(y):
                out.add((d, i, len(y), len(s & y), len(s & y) / len(y)))
    return sorted(out, key=str)


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("part", [C.PART_SHINGLES, 20])
def test_pairs_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(C, "PART_SHINGLES", part)      # with a small bound the index comes in several parts
    got = C.leaks(docs(spark, DOCS), items(spark)).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS)
    # 7 holds the three-word item among other words
    assert {r.doc_id for r in got} >= {1, 2, 6, 7, 9, 10, 11, 12} and not {r.doc_id for r in got} & {3, 8}


def test_decontaminate_keeps_clean_rows_whole(spark):
    df = docs(spark, DOCS)
    bad = {r[0] for r in brute(DOCS, ITEMS)}
    out = C.decontaminate(df, items(spark))
    assert out.columns == df.columns
    want = [tuple(r) for r in df.collect() if r.doc_id not in bad]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_empty_sides(spark):
    df = docs(spark, DOCS)
    assert C.leaks(df, items(spark, [])).count() == 0 and C.leaks(docs(spark, []), items(spark)).count() == 0
    assert C.decontaminate(df, items(spark, [])).count() == len(DOCS)
    assert C.leaks(df, items(spark, [(1, None), (2, " ")])).count() == 0


@pytest.mark.parametrize("kind,name", [("int", int), ("string", str), ("decimal(10,0)", int)])
def test_ids_of_any_type(spark, kind, name):
    some = items(spark).withColumn("item_id", F.col("item_id").cast(kind))
    df = docs(spark, DOCS).withColumn("doc_id", F.col("doc_id").cast(kind))
    got = C.leaks(df, some)
    assert dict(got.dtypes)["item_id"] == kind == dict(got.dtypes)["doc_id"]
    plain = [tuple(None if v is None else int(v) for v in r[:2]) for r in got.collect()]
    assert sorted(plain, key=str) == sorted([r[:2] for r in brute(DOCS, ITEMS)], key=str)


def test_short_items_stand_anywhere_and_one_part_is_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_SHINGLES", 20)
    alive, most, share = [0], [0], C.T.share

    class Box:
        def __init__(self, box):
            self.box, self.value = box, None

        def __reduce__(self):
            return self.box.__reduce__()

        def destroy(self):
            alive[0] -= 1
            self.box.destroy()

    def counted(session, value):
        alive[0] += 1
        most[0] = max(most[0], alive[0])
        return Box(share(session, value))

    monkeypatch.setattr(C.T, "share", counted)
    short = [(1, "the quick brown"), (2, "zebra"), (3, "a b c d"), (4, ITEM), (5, " ".join(f"b{i}" for i in range(60)))]
    rows = [(1, f"{FILL} The QUICK, brown {FILL}", "a"), (2, "quick brown the", "a"), (3, "x a b c d", "a"), (4, "a b c x d", "a"),
            (5, "zebra", "a"), (6, "zebras", "a"), (7, f"one zebra {ITEM}", "a")]
    got = C.leaks(docs(spark, rows), items(spark, short))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, short)
    assert {tuple(r)[:2] for r in got.collect()} == {(1, 1), (3, 3), (5, 2), (7, 2), (7, 4)}
    assert most[0] == 1
    assert {r.doc_id for r in C.decontaminate(docs(spark, rows), items(spark, short)).collect()} == {2, 4, 6}
