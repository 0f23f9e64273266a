"""Tree learner: kernels, scalar trees, lockstep against one task, scoring against SQL."""
import heapq

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pondlens.operators import trees as T


def data(n=400, p=5, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 1)
    x[:, -1] = rng.integers(0, 3, n)
    y = 3 * x[:, 0] - x[:, 1] * x[:, 2] + rng.normal(0, .3, n)
    return x, y


def frame(spark, x, y, folds=3):
    rows = [(i, bool(i % 7), i % folds, float(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))]
    names = [f"f{k}" for k in range(x.shape[1])]
    return spark.createDataFrame(rows, "id long, train boolean, fold int, y_t double, " + ", ".join(f"{n} double" for n in names)), names


def scalar_tree(bins, g, w, s, scale, feats):
    """Recursive, one node at a time; the same rules, sums by plain loops. With a leaf limit: a queue of leaves."""
    def best(rows):
        found = None
        G, W, C = int((g * w)[rows].sum()), int(w[rows].sum()), len(rows)
        for f in feats:
            for b in sorted(set(bins[rows, f].tolist())):
                left = rows[bins[rows, f] <= b]
                gl, wl, cl = int((g * w)[left].sum()), int(w[left].sum()), len(left)
                if cl == C or cl < s.min_leaf or C - cl < s.min_leaf or wl < s.min_weight or W - wl < s.min_weight:
                    continue
                a, z = gl / scale.unit, G / scale.unit
                gain = a * a / (wl + s.l2) + (z - a) * (z - a) / (W - wl + s.l2) - z * z / (W + s.l2)
                if gain > max(s.gamma, 1e-12 * W * scale.span ** 2) and (found is None or gain > found[0]):
                    found = (gain, f, b, left, rows[bins[rows, f] > b])
        return found

    def may(rows, depth):
        return (s.max_depth is None or depth < s.max_depth) and len(rows) >= max(s.min_split, 2 * s.min_leaf, 2)

    out = {}
    rows = np.flatnonzero(w > 0)
    if s.leaves is None:
        def visit(rows, depth, path):
            sp = best(rows) if may(rows, depth) else None
            if sp is None:
                out[path] = ("leaf", int((g * w)[rows].sum()), int(w[rows].sum()))
                return
            out[path] = (sp[1], sp[2])
            visit(sp[3], depth + 1, path + "L")
            visit(sp[4], depth + 1, path + "R")
        visit(rows, 0, "")
        return out
    count = 1
    leaves, heap, order = {"": (rows, 0)}, [], 0
    sp = best(rows) if may(rows, 0) else None
    if sp:
        heapq.heappush(heap, (-sp[0], 0, "", sp))
    while heap and count < s.leaves:
        _, _, path, sp = heapq.heappop(heap)
        depth = leaves.pop(path)[1]
        out[path] = (sp[1], sp[2])
        count += 1
        for side, r in (("L", sp[3]), ("R", sp[4])):
            order += 1
            leaves[path + side] = (r, depth + 1)
            new = best(r) if may(r, depth + 1) else None
            if new:
                heapq.heappush(heap, (-new[0], order, path + side, new))
    for path, (r, _) in leaves.items():
        out[path] = ("leaf", int((g * w)[r].sum()), int(w[r].sum()))
    return out


def paths(tree, s, scale):
    """The same form from a grown tree's arrays (a leaf's value is compared)."""
    out, todo = {}, [(0, "")]
    while todo:
        k, path = todo.pop()
        if tree["feature"][k] >= 0:
            out[path] = (int(tree["feature"][k]), int(tree["bin"][k]))
            todo += [(int(tree["left"][k]), path + "L"), (int(tree["right"][k]), path + "R")]
        else:
            out[path] = ("leaf", float(tree["value"][k]))
    return out


SETTINGS = {
    "forest": T.Settings("forest", trees=1, min_split=5, min_leaf=2),
    "second order": T.Settings("boost", rate=0.1, max_depth=4, gamma=0.5, min_weight=7, l2=1.0, subsample=0.7, colsample=0.6),
    "best first": T.Settings("boost", rate=0.1, max_depth=5, leaves=9, min_leaf=5),
    "best first, deep": T.Settings("boost", rate=0.1, leaves=14, min_leaf=2),
}


@pytest.mark.parametrize("name", SETTINGS)
@pytest.mark.parametrize("seed", range(3))
def test_trees_equal_scalar_trees(name, seed):
    s = SETTINGS[name]
    x, y = data(160, seed=seed)
    bins = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], axis=1).astype(np.uint8)
    scale = T.Scale(float(y.min()), float(y.max()))
    g = T._gradients(scale.middle, y, scale)
    w, feats = T.bag(np.arange(len(y)), seed, s), T.tree_features(seed, s, bins.shape[1])
    got, want = paths(T.grow(bins, g, w, s, scale, feats), s, scale), scalar_tree(bins, g, w, s, scale, feats)
    assert got.keys() == want.keys() and len(got) > 5
    for path, v in want.items():
        if v[0] == "leaf":
            value = -v[1] / scale.unit / (v[2] + s.l2)
            value = (value + scale.middle) / s.trees if s.kind == "forest" else value * s.rate
            assert got[path][1] == pytest.approx(value, rel=1e-12)
        else:
            assert got[path] == v
    if s.leaves:
        assert sum(v[0] == "leaf" for v in got.values()) <= s.leaves


def test_both_ways_to_split_agree(monkeypatch):
    x, y = data(3000, 6, 4)
    bins = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], axis=1).astype(np.uint8)
    scale = T.Scale(float(y.min()), float(y.max()))
    g, at = T._gradients(scale.middle, y, scale) / scale.unit, np.random.default_rng(1).integers(0, 40, len(y))
    feats = np.array([0, 2, 3, 5])
    for s in SETTINGS.values():
        w = np.maximum(T.bag(np.arange(len(y)), 3, s), 1).astype(float)
        for weight, gradient in ((w, g * w), (None, g)):
            a = T.splits_of_sums(s, scale, *T.sums(bins[:, feats], at, gradient, weight, 40), feats)
            for block in (1 << 16, 10):
                monkeypatch.setattr(T, "BLOCK", block)
                assert a == T.splits_by_sums(s, scale, bins[:, feats], at, gradient, weight, 40, feats)
                assert a == T.splits_by_sorting(s, scale, bins[:, feats], at, gradient, weight, 40, feats)


def test_deeper_than_thirty():
    """A chain: the target grows threefold with the bin, so each split takes one row off."""
    n = 40
    bins, g = np.arange(n, dtype=np.uint8)[:, None], -(3 ** np.arange(n, dtype=np.int64))
    scale = T.Scale(0.0, 1.0)
    scale.span, scale.unit = 0.0, 1.0
    s = T.Settings("boost", min_leaf=1)
    tree = T.grow(bins, g, np.ones(n, np.int64), s, scale, np.array([0]))
    shallow = T.grow(bins, g, np.ones(n, np.int64), T.Settings("boost", max_depth=30), scale, np.array([0]))

    def depth(t):
        todo, out = [(0, 0)], 0
        while todo:
            k, d = todo.pop()
            out = max(out, d)
            todo += [(int(t[c][k]), d + 1) for c in ("left", "right")] if t["feature"][k] >= 0 else []
        return out

    assert depth(tree) > 32 and depth(shallow) == 30


def fits():
    return [T.Fit(0, "t", T.Settings("forest", trees=3, min_split=5, min_leaf=2)),
            T.Fit(1, "t", T.Settings("boost", trees=4, rate=0.3, max_depth=3, gamma=0.1, min_weight=3, l2=1.0, subsample=0.8, colsample=0.8)),
            T.Fit(2, "t", T.Settings("boost", trees=3, rate=0.3, max_depth=4, leaves=6, min_leaf=5), fold=1)]


def sorted_paths(df):
    """Per tree: what each path of splits leads to."""
    rows = {(r["fit"], r["tree"], r["node"]): r for r in df.collect()}
    out, todo = [], [(f, t, 0, "") for f, t in {k[:2] for k in rows}]
    while todo:
        f, t, k, path = todo.pop()
        r = rows[(f, t, k)]
        out.append((f, t, path, r["feature"], r["threshold"] if r["feature"] >= 0 else None, r["value"], r["rows"]))
        todo += [(f, t, r["left"], path + "L"), (f, t, r["right"], path + "R")] if r["feature"] >= 0 else []
    assert len(out) == len(rows)
    return sorted(out, key=lambda x: x[:3])


def test_lockstep_gives_the_trees_of_one_task(spark):
    x, y = data(300)
    df, names = frame(spark, x, y)
    m = T.bin_table(df.repartition(3), names, ["t"])
    m.rows = T.stored(m.rows, "binned")
    one, many = sorted_paths(T.fit_nodes(m, fits())), sorted_paths(T.fit_nodes(m, fits(), row_bound=60))
    assert len(one) == len(many) > 50
    for a, b in zip(one, many):
        assert a[:5] == b[:5] and a[6] == b[6] and a[5] == pytest.approx(b[5], rel=1e-12)


def test_scores_by_broadcast_joins_and_sql(spark, tmp_path):
    x, y = data(200)
    df, names = frame(spark, x, y)
    m = T.bin_table(df, names, ["t"])
    m.rows = T.stored(m.rows, "binned")
    nodes, base = T.stored(T.fit_nodes(m, fits()), "nodes"), T.base_values(m, fits())
    nodes.coalesce(1).write.parquet(str(tmp_path / "nodes"))
    df.coalesce(1).write.parquet(str(tmp_path / "rows"))

    def values(b):
        return np.stack([b[n].to_numpy(zero_copy_only=False) for n in names], axis=1)

    for f in fits():
        mine = nodes.where(F.col("fit") == f.fit)
        a = {r["id"]: r["prediction"] for r in T.predict(df, mine, base[f.fit], values).collect()}
        b = {r["id"]: r["prediction"] for r in T.predict(df, mine, base[f.fit], values, max_nodes=0).collect()}
        c = {r["id"]: r["prediction"] for r in T.predict(m.rows, mine, base[f.fit], T.values_of_bins(m)).collect()}
        got = duckdb.sql(f"""
          WITH RECURSIVE nodes AS (SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet') WHERE fit = {f.fit}),
          x AS (SELECT id, [{', '.join(names)}] AS v FROM read_parquet('{tmp_path}/rows/*.parquet')),
          walk AS (
            SELECT id, tree, node, feature, threshold, "left", "right", value FROM x, nodes WHERE node = 0
            UNION ALL
            SELECT w.id, w.tree, n.node, n.feature, n.threshold, n."left", n."right", n.value
            FROM walk w JOIN x USING (id) JOIN nodes n ON n.tree = w.tree
              AND n.node = CASE WHEN x.v[w.feature + 1] <= w.threshold THEN w."left" ELSE w."right" END
            WHERE w.feature >= 0)
          SELECT id, {base[f.fit]!r}::DOUBLE + sum(value) FILTER (WHERE feature < 0) AS p FROM walk GROUP BY id""").fetchall()
        d = dict(got)
        assert a.keys() == b.keys() == c.keys() == d.keys() and len(a) == 200
        for i in a:
            assert a[i] == pytest.approx(b[i], rel=1e-9) and a[i] == pytest.approx(c[i], rel=1e-9) and a[i] == pytest.approx(d[i], rel=1e-9)


def test_held_out_predictions_leave_their_fold_out(spark):
    x, y = data(240)
    df, names = frame(spark, x, y)
    m = T.bin_table(df, names, ["t"])
    m.rows = T.stored(m.rows, "binned")
    many = [T.Fit(k, "t", T.Settings(kind, trees=8, rate=0.3, max_depth=4, min_leaf=2), fold=k % 3)
            for k, kind in enumerate(["forest"] * 3 + ["boost"] * 3)]
    got = {(r["fit"], r["id"]): r["prediction"] for r in T.held_out_predictions(m, many).collect()}
    assert {i for _, i in got} == {i for i in range(240) if i % 7} and len(got) == 2 * len({i for _, i in got})
    assert all(i % 3 == k % 3 for k, i in got)
    far = {(r["fit"], r["id"]): r["prediction"] for r in T.held_out_predictions(m, many, row_bound=40).collect()}
    assert got.keys() == far.keys()
    assert max(abs(got[k] - far[k]) for k in got) < 1e-9


def test_empty_and_constant(spark):
    df, names = frame(spark, *data(30))
    m = T.bin_table(df.withColumn("y_t", F.lit(2.5)), names, ["t"])
    nodes = T.fit_nodes(m, fits()).toPandas()
    assert (nodes["feature"] == -1).all() and len(nodes) == 10
    none = T.bin_table(df.where("false"), names, ["t"])
    assert (T.fit_nodes(none, fits()).toPandas()["feature"] == -1).all()
