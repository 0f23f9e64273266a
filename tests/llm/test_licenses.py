import re

import pytest

from pondlens.llm import licenses as L
from tests.llm.common import docs, lower

MIT = L._GRANT + ("the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software")
TEXTS = [
    (1, "Intro. Licensed under the Apache License, Version 2.0. End", "a"),
    (2, "x under-the (MIT) license y UNDER THE MIT LICENSE", "a"),
    (3, "CC BY-NC, cc by nc", "a"), (4, None, None), (5, "", ""), (None, "Licensed under CC BY-NC 4.0.", None),
    (6, "This work is licensed under the GNU General Public License, version 3.", "a"),
    (7, MIT.replace("this software", "THIS\n* Software").capitalize(), "a"),
    (8, MIT.replace("without restriction", "with restriction"), "a"),
    (9, "under the mit  licenses; cc bync; apache license version 20 lizenz é", "a"),
    (10, "pad " * 70000 + "under the mit license", "a"), (10, "dup", "a"), (10, "dup", "a"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute(text):
    w = words(text)
    found = [(i, label) for p, label in L.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def test_base_matches_brute_force_and_templates_add(spark):
    got = L.digest(L.scan(docs(spark, TEXTS))).collect()
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted([(i, *brute(t)) for i, t, _ in TEXTS], key=str)
    by = {r.doc_id: r for r in got}
    assert [by[i].labels for i in (1, 2, 3, 6, 7, 8, 9)] == ["apache-2", "mit", "cc-by-nc", "gpl-3", "mit", "", ""]
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)
    assert by[7].score == 1.0 and by[5].score == 0.0


@pytest.mark.parametrize("text,label", [
    ("a b c d", True), ("a c d", True), ("a b b c d", False), ("a x y c", False), ("a b c", False), ("z a c d z", True)])
def test_optional_regions(text, label):
    auto = L.Automaton({"t": ["a [b] c d"]})
    assert bool(auto.matches(text.encode().split())) == label


@pytest.mark.parametrize("n,ok", [(0, True), (1, True), (3, True), (4, False)])
def test_replaceable_regions(n, ok):
    auto = L.Automaton({"t": ["name <3> end"]})
    got = auto.matches(b"name " .split() + [b"w"] * n + [b"end"])
    assert bool(got) == ok and (not ok or got == [("t", 0, n + 2)])


def test_longest_and_nested():
    auto = L.Automaton({"t": ["a [b [c | d]] "], "u": ["b"]})
    assert auto.matches(b"a b d b".split()) == [("t", 0, 3), ("u", 1, 2), ("u", 3, 4)]
    with pytest.raises(ValueError):
        L.Automaton({"t": ["a [b"]})


def test_anchor_loses_nothing():
    for label, texts in L.TEMPLATES.items():
        for t in texts:
            plain = re.sub(r"\[[^\]]*\]|<\d+>", "", t)
            assert L.ANCHOR.search(plain.encode()), (label, t)
    for phrase in L.BASE:
        assert L.ANCHOR.search(phrase.encode())


def test_empty(spark):
    assert L.digest(L.scan(docs(spark, []))).count() == 0
