import re

import numpy as np

from pondlens.llm import substring_dedup as S
from pondlens.llm import textops as T
from tests.llm.common import docs, lower, ws_words


def corpus():
    rng = np.random.default_rng(11)

    def prose(n, stops=True):
        out = []
        for k in range(n):
            w = f"t{rng.integers(0, 4000)}"
            out.append(w + "." if stops and rng.random() < 0.12 else w)
        return " ".join(out)

    rows = [(i, "\n".join(prose(int(rng.integers(3, 120))) for _ in range(int(rng.integers(1, 5)))), "s") for i in range(60)]
    para, inline = prose(55, False), "Begin here. " + prose(60) + " end."
    for i in range(100, 130):                     # whole paragraphs, some edited
        w = para.split()
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(0, 55))] = f"edit{i}"
        rows.append((i, prose(20) + "\n" + " ".join(w) + "\n" + prose(30), "s"))
    for i in range(200, 215):                     # passages inside a paragraph
        rows.append((i, prose(40) + ". " + inline + " " + prose(40), "s"))
    rows += [(300 + i, prose(12) + "\nLicensed under the Open License, version 9 of it.", "s") for i in range(5)]
    same = prose(30, False)
    rows += [(400, same + "\n" + same, "s")]      # repeats inside one document only
    rows += [(500, None, None), (501, "", ""), (502, "\n \n", "s"), (None, para, None), (None, "x. " * 30, None),
             (503, prose(40), "s"), (504, "long word é " * 20000, "s")]
    rows += [(505, rows[0][1], "s")] * 2 + [(506 + i, rows[1][1].upper(), "hot") for i in range(30)]
    return rows, para, inline


def shingles(w):
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """(doc, start, end) of the paragraphs whose cluster spans several documents."""
    units = []
    for d, t, _ in rows:
        at = 0
        for line in (t or "").split("\n"):
            w = ws_words(lower(line))
            if len(w) >= S.MIN_WORDS:
                m = list(re.finditer(r"[^\x20\x09-\x0D]+", line))
                units.append((d, at + m[0].start(), at + m[-1].end(), shingles(w)))
            at += len(line) + 1
    parent = list(range(len(units)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(units)):
        for j in range(i):
            both = len(units[i][3] & units[j][3])
            if 100 * both >= 75 * (len(units[i][3]) + len(units[j][3]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, u in enumerate(units):
        groups.setdefault(find(i), []).append(u)
    return {g: {u[:3] for u in us} for g, us in groups.items() if len({u[0] for u in us}) > 1}


def test_paragraph_clusters_match_brute_force(spark):
    rows, para, inline = corpus()
    got = S.repeated_spans(docs(spark, rows)).collect()
    want = brute(rows)
    mine = {}
    for r in got:
        if not r.passage:
            mine.setdefault(r.cluster, set()).add((r.doc_id, r.start, r.end))
    assert sorted(map(sorted_str, mine.values())) == sorted(map(sorted_str, want.values()))
    for r in got:
        if not r.passage:
            members = mine[r.cluster]
            first = min(members, key=lambda m: (m[0] is None, m[0] or 0, m[1]))
            assert r.keeper == first[0] and r.kept == ((r.doc_id, r.start) == first[:2] or r.doc_id == first[0] and r.start == first[1])


def sorted_str(x):
    return sorted(map(str, x))


def test_passages_inside_paragraphs_are_found_and_clean_documents_left_alone(spark):
    rows, para, inline = corpus()
    text = {i: t for i, t, _ in rows}
    got = S.repeated_spans(docs(spark, rows)).collect()
    copies = {0, 1, 505} | set(range(506, 536))      # their lines of less than MIN_WORDS words are passages too
    spans = [r for r in got if r.passage and r.doc_id not in copies]
    assert {r.doc_id for r in spans} == set(range(200, 215))
    for r in spans:
        part = text[r.doc_id][r.start:r.end]
        assert part in inline and len(part.split()) >= S.MIN_PASSAGE and r.keeper == 200 and r.kept == (r.doc_id == 200)
    covered = {i: sum(len(text[i][r.start:r.end].split()) for r in spans if r.doc_id == i) for i in range(200, 215)}
    assert min(covered.values()) > 40
    caught = {r.doc_id for r in got}
    assert not caught & ({400, 503, 504, 500, 501, 502} | set(range(2, 60)) | set(range(300, 305)))
    paragraphs = {u[0] for us in brute(rows).values() for u in us}
    assert caught >= paragraphs | set(range(200, 215)) and paragraphs >= {None} | set(range(506, 536)) and len(paragraphs) > 45


def test_removed_keeps_one_copy(spark):
    rows, para, inline = corpus()
    df = docs(spark, rows)
    out = S.removed(df, length_col="n_chars").collect()
    assert len(out) == len(rows)
    texts = [r.text or "" for r in out]
    assert sum(inline[30:200] in t for t in texts) == 1
    assert sum(" ".join(rows[1][1].split()[:26]).lower() in " ".join(t.split()).lower() for t in texts) <= 1
    by = {r.doc_id: r for r in out}
    assert by[500].text is None and by[503].text == dict((r[0], r[1]) for r in rows)[503]
    assert all(r.n_chars == len(r.text) for r in out if r.text is not None)


def test_empty(spark):
    assert S.repeated_spans(docs(spark, [])).count() == 0
    assert S.removed(docs(spark, [(1, None, None)])).count() == 1


def test_runs_are_found_wherever_they_begin_and_break(spark):
    rng = np.random.default_rng(5)

    def w(n):
        return [f"u{x}" for x in rng.integers(0, 10 ** 9, n)]

    def wrapped(words, n):
        return "\n".join(" ".join(words[i:i + n]) for i in range(0, len(words), n))

    plain, hard, one, near = w(60), w(70), w(30), w(49)
    texts = {
        1: " ".join(w(33) + plain + w(21)), 2: " ".join(w(8) + plain + w(90)),          # no sentence ends
        3: wrapped(w(5) + hard + w(9), 7), 4: wrapped(w(30) + hard + w(2), 11),         # short lines, broken elsewhere
        5: " ".join(w(7) + hard + w(40)).upper(),
        6: " ".join(w(40)) + "\n" + " ".join(one) + ".", 7: " ".join(w(30)) + ". " + " ".join(one) + ". " + " ".join(w(30)),
        8: " ".join(w(30) + near + w(30)), 9: " ".join(w(20) + near + w(30)),           # one word short
        10: " ".join(w(10) + plain[:30] + w(1) + plain[31:] + w(10)),
        11: " ".join(w(10) + plain[3:] + w(12)), 12: " ".join((w(3) + ["x", "y"] * 40)), 13: "x y " * 60}
    got = S.repeated_spans(docs(spark, [(i, t, "s") for i, t in texts.items()])).where("passage").collect()
    windows = {}
    for i, t in texts.items():
        m = list(re.finditer(r"\S+", t))
        for j in range(len(m) - S.MIN_RUN + 1):
            key = tuple(x[0].lower() for x in m[j:j + S.MIN_RUN])
            windows.setdefault(key, []).append((i, m[j].start(), m[j + S.MIN_RUN - 1].end()))
    want, have = {}, {}
    for at in windows.values():
        if len({i for i, _, _ in at}) > 1:
            for i, a, b in at:
                want.setdefault(i, set()).update(range(a, b))
    for r in got:
        have.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert {i: have.pop(i) for i in (6, 7)} == {6: set(range(texts[6].index(one[0]), len(texts[6]))),
                                               7: set(range(texts[7].index(one[0]), texts[7].index(one[-1]) + len(one[-1]) + 1))}
    assert set(want) == {1, 2, 3, 4, 5, 11, 12, 13} and have == want
    out = {r.doc_id: r.text for r in S.removed(docs(spark, [(i, t, "s") for i, t in texts.items()])).collect()}
    assert " ".join(plain) in out[1] and not any(x in out[2].split() for x in plain)
    assert out[10] == texts[10] and out[8] == texts[8] and out[9] == texts[9]


def test_a_passage_whose_other_copy_goes_with_its_paragraph_stays(spark):
    rng = np.random.default_rng(7)

    def w(n):
        return [f"v{x}" for x in rng.integers(0, 10 ** 9, n)]

    line, sentence = w(200), "Now " + " ".join(w(20)) + " end."
    first = " ".join(line[:100]) + ". " + " ".join(line[100:]) + "."
    texts = {1: first, 2: first.replace(". ", ". " + sentence + " ", 1), 3: " ".join(w(30)) + ". " + sentence + " " + " ".join(w(30))}
    df = docs(spark, [(i, t, "s") for i, t in texts.items()])
    spans = [r for r in S.repeated_spans(df).collect() if r.passage]
    assert [(r.doc_id, r.keeper, r.kept) for r in spans] == [(3, 3, True)]
    out = {r.doc_id: r.text for r in S.removed(df).collect()}
    assert out == {1: first, 2: "", 3: texts[3]}


def test_every_word_still_stands_somewhere(spark):
    rng = np.random.default_rng(23)
    pool = [f"p{i}" for i in range(3000)]
    runs = [pool[int(a):int(a) + int(n)] for a, n in zip(rng.integers(0, 2800, 40), rng.integers(30, 160, 40))]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            parts += [*[f"w{i}x{x}" for x in rng.integers(0, 10 ** 6, int(rng.integers(0, 30)))], *runs[int(rng.integers(0, 40))]]
            if rng.random() < 0.5:
                parts[-1] += "." if rng.random() < 0.5 else "\n"
        rows.append((None if i % 20 == 19 else i, " ".join(parts).replace("\n ", "\n"), "s"))
    rows += [(i, rows[i][1], "s") for i in (3, 4)] + [(5, rows[6][1], "s"), (90, "x y " * 60, "s"), (91, "z " + "x y " * 40, "s")]
    df = docs(spark, rows)
    spans = S.repeated_spans(df)
    text = {}
    for i, x, _ in rows:
        text.setdefault(i, []).append(x)
    found = spans.collect()
    words = {x.strip(".") for _, t, _ in rows for x in ws_words(t)}
    left = {x.strip(".") for r in S.removed(df).collect() for x in ws_words(r.text)}
    # a removed paragraph may differ from the kept one by some words; passages lose none
    lines = {x.strip(".") for r in found if not r.passage and not r.kept for t in text[r.doc_id] for x in ws_words(t[r.start:r.end])}
    assert sum(r.passage and not r.kept for r in found) > 40 and words - left <= lines
    exact = [r for r in S.repeated_spans(df.where("doc_id IN (90, 91)")).collect()]
    assert {(r.doc_id, r.keeper) for r in exact} == {(90, 90), (91, 90)}


def test_leader_of_a_window_is_its_first_smallest_value():
    rng = np.random.default_rng(5)
    for top in (3, 1 << 60):
        values = rng.integers(-top, top, 300)
        for k in (1, 2, 7, 26):
            assert T.window_argmin(values, k).tolist() == [i + int(values[i:i + k].argmin()) for i in range(len(values) - k + 1)]
