import numpy as np
import pyarrow as pa
import pytest

from pondlens.llm import linking
from pondlens.llm import near_dup as N
from pondlens.llm.components import components
from tests.llm.common import docs, lower, ws_words


def shingles(text):
    w = ws_words(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    out = []
    for i, (d, _, _) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def corpus():
    rng = np.random.default_rng(5)
    rows = []

    def text(n):
        return [f"v{x}" for x in rng.integers(0, 5000, n)]

    for _ in range(60):
        rows.append(text(int(rng.integers(1, 200))))
    for _ in range(12):                                   # groups near the threshold, on both sides of it
        base = text(int(rng.integers(30, 160)))
        rows.append(base)
        for _ in range(8):
            w = list(base)
            for _ in range(max(1, int(len(w) * rng.uniform(0.005, 0.05)))):
                w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 10 ** 6)}"
            rows.append(w)
    hub = text(120)                                       # a hot group of near copies whose only links lead to the hub
    rows.append(hub)
    for i in range(150):
        w = list(hub)
        for k in range(3):
            w[int(rng.integers(0, 120))] = f"h{i}x{k}"
        rows.append(w)
    rows += [hub] * 100                                   # a third of the rows are copies
    out = [(int(i), " ".join(w), "s") for i, w in zip(rng.permutation(len(rows)), rows)]
    out += [(9000, None, None), (9001, "", ""), (9002, " \t\n", "s"), (9003, "one two", "s"), (9004, "ONE  two", "s"),
            (9005, "one two three four five", "s"), (9006, "one two three four five", "s"), (9006, "one two three four five", "s"),
            (None, "no id here at all now", None), (9007, "long " * 30000 + "tail", "s")]
    return out


@pytest.mark.parametrize("block", [linking.BLOCK_SHINGLES, 2000])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(linking, "BLOCK_SHINGLES", block)      # with small blocks a hot group becomes many tasks
    rows = corpus()
    got = N.near_duplicates(docs(spark, rows)).collect()
    got = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got], key=str)
    want = brute(rows)
    assert got == want


def test_one_row_of_each_group_stays(spark):
    rows = corpus()
    df = docs(spark, rows)
    out = N.deduplicated(df)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    groups = {c for d, n, c, _ in brute(rows) if n}
    wordless = {9000, 9001, 9002}
    assert sorted(map(str, got)) == sorted(map(str, groups | wordless))


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 3000, dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    sets = [a, np.concatenate([a[:2500], b]), np.zeros(0, np.uint64), np.concatenate([a, b]), b[:1]]
    limits = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    r = N.registers(np.concatenate(sets), limits)
    one = [N.registers(s, np.array([0, len(s)]))[0] for s in sets]
    assert (r == np.stack(one)).all()
    assert (r[3] == np.maximum(r[0], N.registers(b, np.array([0, 1000]))[0])).all()      # a union's registers are the maxima
    n = np.array([3000.0]), np.array([3500.0])
    assert abs(N.estimate(r[:1], r[1:2], *n)[0] - 2500 / 4000) < 0.15
    assert N.estimate(r[:1], r[:1], n[0], n[0])[0] == pytest.approx(1.0, abs=1e-6)


def test_estimate_is_unbiased_enough():
    rng = np.random.default_rng(2)
    err = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        a, b = x[:430], x[70:]
        h = np.concatenate([a, b])
        r = N.registers(h, np.array([0, 430, 860]))
        err.append(N.estimate(r[:1], r[1:], np.array([430.0]), np.array([430.0]))[0] - 360 / 500)
    assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.05


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(spark):
    assert N.near_duplicates(docs(spark, [])).count() == 0
    assert [r.kept for r in N.near_duplicates(docs(spark, [(1, None, None)])).collect()] == [True]


@pytest.mark.parametrize("rows, work", [(3, 5), (50, 500_000)])
def test_many_blocks_are_compared_at_once(monkeypatch, rows, work):
    """One call takes the blocks of many groups, wherever batches cut them; links never cross blocks."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(linking, "WORK", work)
    names, records, want = ["g", "i", "j", "c", "component", "stray", "items"], [], set()
    for g in range(12):
        bases = [rng.choice(60, 12, replace=False) for _ in range(3)]
        members = []
        for k in range(10):
            items = set(bases[k % 3].tolist())
            items ^= set(rng.choice(60, int(rng.integers(0, 4)), replace=False).tolist())
            members.append((100 * g + k, int(rng.integers(0, 4)), sorted(items)))
        strays = [m for m in members if m[1]]
        records += [(g, 0, g % 2, *m[:2], True, m[2]) for m in strays] + [(g, 0, g % 2, *m[:2], False, m[2]) for m in members]
        for a, x, s in strays:
            for _, y, t in members:
                both = len(set(s) & set(t))
                if x != y and 100 * both >= 75 * (len(s) + len(t) - both):
                    want.add((a, g, y))
    table = pa.table({n: pa.array([r[k] for r in records]) for k, n in enumerate(names)})
    component = {r[3]: r[4] for r in records}
    got = [p for b in linking._compared(iter(table.to_batches(max_chunksize=rows))) for p in zip(*b.to_pydict().values())]
    assert want and sorted((a, b // 100, component[b]) for a, b in got) == sorted(want)


def test_blocks_are_not_compared_one_call_each(spark):
    open_ = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 1, 2)], "bucket long, c long, lo long, component long")
    sets = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 3])], "c long, items array<bigint>")
    links = linking.stray_links(open_, sets)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan
    assert [sorted((r["a"], r["b"])) for r in links.collect()] == [[1, 2]]
