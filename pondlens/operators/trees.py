"""Regression trees over a binned matrix: forests and second-order boosting (M7-M9).

MLlib's learners have no ``min_samples_split``, no gamma, no child weight in
Hessian units, no leaf limit and stop at depth 30. These trees have them.

* Every feature is cut into at most 255 bins once; a row is its id, its bins
  (one byte each), its labels and its fold. Bags are drawn by hashing the row
  id with the tree's number. Gradients are whole numbers (2^-30 of the label
  range), so sums do not depend on the order of rows or on the partitioning.
* ``Growth`` holds one tree while it grows level by level. With a leaf limit it
  is best first: a level's nodes are opened only if they are among the first
  ``leaves - 1`` in order of gain, given all that is known so far. Deeper nodes
  can only push others back, so nodes that fall out never return.
* Up to ``ROW_BOUND`` rows the matrix is broadcast (its size is checked) and the
  fits - or blocks of trees of a forest - are spread over the tasks.
* Beyond, trees of many fits grow in lockstep: each level is one aggregate by
  (tree, node, feature, bin) over the whole table, whose sums give the splits.
  Nodes of a forest that are down to ``ROW_BOUND`` rows are sent to one task
  each and finished there. Both ways give the same trees.

The result is a table of nodes: fit, tree, node, feature, threshold, left,
right, value, gain, rows. A row's prediction is its fit's base plus the sum of
the values of the leaves it reaches.
"""

from __future__ import annotations

import heapq
import math
import os
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from pondlens.session import checkpoint_dir

BINS = 256
#: Rows of a matrix that is broadcast, and of a forest's node that one task finishes.
ROW_BOUND = 100_000
#: Trees of a forest that one task grows.
TREES_PER_TASK = 25
#: Rows of a node table that is broadcast; larger ones are joined.
MAX_NODES = 4_000_000
NODE_SCHEMA = "fit int, tree int, node long, feature int, threshold double, left long, right long, value double, gain double, rows long"
_U = np.uint64
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass
class Settings:
    """How one ensemble grows."""
    kind: str                       # "forest" (mean of trees) or "boost" (sum of shrunk trees)
    trees: int = 200
    rate: float = 0.05              # boost: shrinkage
    max_depth: int | None = None
    min_split: int = 2              # rows of a node that may be split
    min_leaf: int = 1               # rows of a child
    min_weight: float = 0.0         # sum of Hessians of a child
    gamma: float = 0.0              # gain below which a split is not made
    l2: float = 0.0
    subsample: float = 1.0          # boost: share of the rows of a tree
    colsample: float = 1.0          # share of the features of a tree
    leaves: int | None = None       # best-first growth up to so many leaves
    seed: int = 42


@dataclass
class Fit:
    """One ensemble to fit: a label, its settings, and the fold that is left out (None: none)."""
    fit: int
    label: str
    settings: Settings
    fold: int | None = None


@dataclass
class Scale:
    """Range of a label over all training rows."""
    low: float
    high: float
    span: float = field(init=False)
    unit: float = field(init=False)

    def __post_init__(self):
        self.span = max(self.high - self.low, 1e-12)
        self.unit = 2.0 ** (30 - math.ceil(math.log2(self.span)))

    @property
    def middle(self) -> float:
        return (self.low + self.high) / 2


# ---------------------------------------------------------------- growing one tree

def uniform(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row of a tree."""
    h = ids.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15) + _U((tree + 1) * 0xC2B2AE3D27D4EB4F % 2 ** 64) + _U(seed)
    for _ in range(2):
        h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return (h >> _U(11)).astype(np.float64) / 2.0 ** 53


def bag(ids: np.ndarray, tree: int, s: Settings) -> np.ndarray:
    """How often each row is in the tree's sample."""
    u = uniform(ids, tree, s.seed)
    if s.kind == "forest":
        return np.searchsorted(_POISSON, u, side="right").astype(np.int64)
    return (u < s.subsample).astype(np.int64)


def tree_features(tree: int, s: Settings, n: int) -> np.ndarray:
    if s.colsample >= 1:
        return np.arange(n)
    return np.sort(np.random.default_rng([s.seed, tree]).choice(n, max(1, int(s.colsample * n)), replace=False))


class Growth:
    """One tree while it grows, with the sums of each node; ``open`` are the nodes to be split next."""

    def __init__(self, s: Settings, scale: Scale, g: float, w: float, c: int):
        self.s, self.scale = s, scale
        self.feature, self.bin, self.left, self.right, self.gain = [-1], [0], [0], [0], [0.0]
        self.g, self.w, self.c, self.depth = [g], [w], [c], [0]
        self.found: dict[int, tuple] = {}       # leaf limit: node -> (gain, split)
        self.open = [0] if self._may(0) else []

    def _may(self, node: int) -> bool:
        deep = self.s.max_depth is not None and self.depth[node] >= self.s.max_depth
        return not deep and self.c[node] >= max(self.s.min_split, 2 * self.s.min_leaf, 2)

    def take(self, splits) -> list[int]:
        """Splits (feature, bin, gain, g, w, c of the left child) of the open nodes, feature -1 if none; returns the nodes opened."""
        new = [(n, sp) for n, sp in zip(self.open, splits) if sp[0] >= 0]
        if self.s.leaves is not None:
            self.found.update({n: (sp[2], sp) for n, sp in new})
            chosen = set(self._best_first())
            new = [(n, sp) for n, sp in new if n in chosen]
        self.open = []
        for n, (f, b, gain, g, w, c) in new:
            self.feature[n], self.bin[n], self.gain[n] = int(f), int(b), float(gain)
            self.left[n], self.right[n] = len(self.g), len(self.g) + 1
            for x, y, z in ((g, w, int(c)), (self.g[n] - g, self.w[n] - w, self.c[n] - int(c))):
                self.g.append(x), self.w.append(y), self.c.append(z)
                self.depth.append(self.depth[n] + 1)
                self.feature.append(-1), self.bin.append(0), self.left.append(0), self.right.append(0), self.gain.append(0.0)
                if self._may(len(self.g) - 1):
                    self.open.append(len(self.g) - 1)
        return [n for n, _ in new]

    def _best_first(self) -> list[int]:
        """Nodes that are split, in order: always the leaf of the largest gain, the earlier one among equals."""
        heap, order = [(-self.found[0][0], 0)] if 0 in self.found else [], []
        while heap and len(order) < self.s.leaves - 1:
            n = heapq.heappop(heap)[1]
            order.append(n)
            for child in (self.left[n], self.right[n]) if self.left[n] else ():
                if child in self.found:
                    heapq.heappush(heap, (-self.found[child][0], child))
        return order

    def finish(self) -> dict[str, np.ndarray]:
        """The tree as arrays; nodes opened too early (leaf limit) are closed again."""
        keep = set(self._best_first()) if self.s.leaves is not None else None
        feature = np.array(self.feature)
        if keep is not None:
            feature = np.array([f if n in keep else -1 for n, f in enumerate(self.feature)])
        g, w = np.array(self.g, np.float64), np.array(self.w, np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            value = np.where(w > 0, -g / (w + self.s.l2), 0.0)
        if self.s.kind == "forest":
            value = (value + self.scale.middle) / self.s.trees
        else:
            value = value * self.s.rate
        return {"feature": feature, "bin": np.array(self.bin), "left": np.array(self.left), "right": np.array(self.right),
                "gain": np.where(feature >= 0, np.array(self.gain), 0.0), "value": value, "rows": np.array(self.c)}


def _scores(s: Settings, gl, wl, cl, g, w, c):
    """What a split leaves of the squared sums, -inf where it is not allowed; the gain is this less the node's own."""
    right = g - gl
    with np.errstate(invalid="ignore", divide="ignore"):
        score = gl * gl
        score /= wl + s.l2
        right *= right
        right /= w - wl + s.l2
    score += right
    least = max(s.min_leaf, 1)
    bad = (cl < least) | (cl > c - least)
    if s.min_weight > 0:
        bad = bad | (wl < s.min_weight) | (w - wl < s.min_weight)
    np.copyto(score, -np.inf, where=bad)
    return score


class _Best:
    """The best split of each node over blocks of features: the first of the largest score."""

    def __init__(self, n_nodes: int):
        self.score = np.full(n_nodes, -np.inf)
        self.feature, self.bin = np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
        self.g, self.w, self.c = (np.zeros(n_nodes) for _ in range(3))

    def add(self, score, feature, cut, g, w, c) -> None:
        new = score > self.score
        for mine, other in ((self.score, score), (self.feature, feature), (self.bin, cut), (self.g, g), (self.w, w), (self.c, c)):
            mine[new] = other[new]

    def splits(self, s: Settings, scale: Scale, g, w) -> list[tuple]:
        """(feature, bin, gain, and the left child's sums) of each node with these sums; feature -1 without a gain."""
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = self.score - g * g / (w + s.l2)
        feature = np.where(gain > np.maximum(s.gamma, 1e-12 * w * scale.span ** 2), self.feature, -1)
        return list(zip(feature.tolist(), self.bin.tolist(), gain.tolist(), self.g.tolist(), self.w.tolist(), self.c.tolist()))


def _add_sums(best: _Best, s: Settings, g: np.ndarray, w: np.ndarray, c: np.ndarray, feats: np.ndarray) -> None:
    """Candidates from sums by (node, feature, bin)."""
    gl, cl = np.cumsum(g, axis=2), np.cumsum(c, axis=2)
    wl = cl if w is c else np.cumsum(w, axis=2)
    score = _scores(s, gl, wl, cl, *(x[:, :, -1:] for x in (gl, wl, cl)))
    k = np.arange(len(g))
    f, b = np.divmod(score.reshape(len(g), -1).argmax(axis=1), g.shape[2])
    best.add(score[k, f, b], feats[f], b, gl[k, f, b], wl[k, f, b], cl[k, f, b])


def splits_of_sums(s: Settings, scale: Scale, g: np.ndarray, w: np.ndarray, c: np.ndarray, feats: np.ndarray) -> list[tuple]:
    """The best split of each node from its sums by (node, feature, bin)."""
    best = _Best(len(g))
    _add_sums(best, s, g, w, c, feats)
    return best.splits(s, scale, g[:, 0].sum(axis=1), w[:, 0].sum(axis=1))


def sums(bins: np.ndarray, at: np.ndarray, g: np.ndarray, w: np.ndarray | None, n_nodes: int) -> tuple[np.ndarray, ...]:
    """Sums of gradients and weights (None: all 1) and row counts by (node, feature, bin)."""
    n, p = bins.shape
    key = ((at[:, None] * p + np.arange(p)) * BINS + bins).ravel()
    size, shape = n_nodes * p * BINS, (n_nodes, p, BINS)
    c = np.bincount(key, minlength=size).reshape(shape)
    gs = np.bincount(key, np.repeat(g, p), size).reshape(shape)
    return gs, c if w is None else np.bincount(key, np.repeat(w, p), size).reshape(shape), c


#: Cells of sums, or sorted rows times features, that are looked at in one step (they stay in the cache).
BLOCK = 1 << 16


def splits_by_sums(s: Settings, scale: Scale, bins, at, g, w, n_nodes: int, feats: np.ndarray) -> list[tuple]:
    """The best split of each node, from rows: for few nodes of many rows."""
    best, step = _Best(n_nodes), max(1, BLOCK // (n_nodes * BINS))
    for k in range(0, len(feats), step):
        _add_sums(best, s, *sums(bins[:, k:k + step], at, g, w, n_nodes), feats[k:k + step])
    return best.splits(s, scale, np.bincount(at, g, n_nodes), np.bincount(at, w, n_nodes).astype(np.float64))


def splits_by_sorting(s: Settings, scale: Scale, bins, at, g, w, n_nodes: int, feats: np.ndarray) -> list[tuple]:
    """The same without empty bins, for many small nodes: rows sorted by (node, bin) for each feature."""
    n = len(at)
    best, step = _Best(n_nodes), max(1, BLOCK // n)
    bits = max(int(n - 1).bit_length(), 1)
    size = np.bincount(at, minlength=n_nodes)
    start = np.cumsum(size) - size
    node = np.repeat(np.arange(n_nodes), size)
    first, nodes = start[node], np.arange(n_nodes)
    cl = np.arange(n) - first + 1
    all_g = np.bincount(at, g, n_nodes)
    all_w = size if w is None else np.bincount(at, w, n_nodes)
    head = at.astype(np.int64) * BINS << bits | np.arange(n)
    for k in range(0, len(feats), step):
        key = np.sort(head + (bins[:, k:k + step].T.astype(np.int64) << bits), axis=1)
        row, cell = key & (1 << bits) - 1, key >> bits
        total = np.zeros((len(key), n + 1))
        np.cumsum(g[row], axis=1, out=total[:, 1:])
        gl = total[:, 1:] - total[:, first]
        wl = cl
        if w is not None:
            np.cumsum(w[row], axis=1, out=total[:, 1:])
            wl = total[:, 1:] - total[:, first]
        score = _scores(s, gl, wl, cl, all_g[node], all_w[node], size[node])
        score[:, :-1][cell[:, :-1] == cell[:, 1:]] = -np.inf
        tops = np.maximum.reduceat(score, start, axis=1)
        f = tops.argmax(axis=0)
        top = tops[f, nodes]
        spots = np.flatnonzero(score[f[node], np.arange(n)] == top[node])
        at_spot = np.full(n_nodes, n)
        np.minimum.at(at_spot, node[spots], spots)
        left_w = wl[at_spot] if w is None else wl[f, at_spot]
        best.add(top, feats[k:k + step][f], cell[f, at_spot] % BINS, gl[f, at_spot], left_w, cl[at_spot])
    return best.splits(s, scale, all_g, all_w)


def grow(bins: np.ndarray, g: np.ndarray, w: np.ndarray, s: Settings, scale: Scale, feats: np.ndarray,
         depth: int = 0) -> dict[str, np.ndarray]:
    """One tree from rows in memory; ``g`` are whole gradients, ``w`` how often a row counts."""
    rows = np.flatnonzero(w > 0)
    # multiples of one power of two: their sums are exact in any order
    b, g, w = bins[rows][:, feats], (g * w)[rows] / scale.unit, w[rows]
    t = Growth(s, scale, float(g.sum()), float(w.sum()), len(rows))
    w = None if (w == 1).all() else w.astype(np.float64)
    t.depth[0] = depth
    t.open = [0] if t._may(0) else []
    column = np.zeros(bins.shape[1], np.int64)
    column[feats] = np.arange(len(feats))
    node = np.zeros(len(rows), np.int64)
    while t.open:
        place = np.full(len(t.g), -1)
        place[t.open] = np.arange(len(t.open))
        at = place[node]
        keep = at >= 0
        if not keep.all():
            b, g, w, node, at = b[keep], g[keep], None if w is None else w[keep], node[keep], at[keep]
        way = splits_by_sums if len(t.open) * BINS <= 2 * len(node) else splits_by_sorting
        found = way(s, scale, b, at, g, w, len(t.open), feats)
        opened = t.take(found)
        into = np.zeros(len(t.g), bool)
        into[opened] = True
        keep = into[node]
        b, g, w, node = b[keep], g[keep], None if w is None else w[keep], node[keep]
        f, cut = column[np.array(t.feature)[node]], np.array(t.bin)[node]
        goes = b[np.arange(len(node)), f] <= cut
        node = np.where(goes, np.array(t.left)[node], np.array(t.right)[node])
    return t.finish()


def walk(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    inner = tree["feature"] >= 0
    while len(rows):
        rows = rows[inner[at[rows]]]
        n = at[rows]
        at[rows] = np.where(bins[rows, tree["feature"][n]] <= tree["bin"][n], tree["left"][n], tree["right"][n])
    return at


# ---------------------------------------------------------------- the binned matrix

@dataclass
class Matrix:
    """A binned table: columns id, train, fold, y_<label>, bins; edges of each feature and ranges of each label."""
    rows: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    scales: dict[str, Scale]
    n_train: int


def bin_table(frame: DataFrame, features: list[str], labels: list[str], accuracy: int = 20_000) -> Matrix:
    """``frame``: id, train, fold, y_<label> (null: row is not used for that label) and the features without nulls.

    Bin edges are approximate quantiles of the training rows (one aggregate);
    a feature of few values has an edge at each.
    """
    train = frame.where("train")
    probs = [k / (BINS - 1) for k in range(BINS)]
    aggs = [F.percentile_approx(f"`{c}`", probs, accuracy).alias(f"e{i}") for i, c in enumerate(features)]
    aggs += [F.struct(F.min(f"y_{y}"), F.max(f"y_{y}")).alias(f"y_{y}") for y in labels]
    got = train.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    edges = [np.unique(np.array(got[f"e{i}"] if got[f"e{i}"] is not None else [0.0], np.float64))[:-1] for i in range(len(features))]
    scales = {y: Scale(*(v if v is not None else 0.0 for v in got[f"y_{y}"])) for y in labels}
    keep = ["id", "train", "fold", *[f"y_{y}" for y in labels]]

    def cut(batches):
        for b in batches:
            x = np.stack([np.searchsorted(e, b[f].to_numpy(zero_copy_only=False), side="left") for e, f in zip(edges, features)],
                         axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=[*keep, "bins"])

    kinds = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)
    rows = frame.select(*keep, *[F.col(f"`{f}`") for f in features]).mapInArrow(cut, f"{kinds}, bins binary")
    return Matrix(rows, features, edges, scales, got["n"])


def _arrays(table, labels) -> dict:
    """Arrow columns of binned rows as arrays."""
    n = table.num_rows
    raw = b"".join(table["bins"].to_pylist())
    out = {"id": table["id"].to_numpy(zero_copy_only=False).astype(np.int64), "train": table["train"].to_numpy(zero_copy_only=False),
           "fold": table["fold"].to_numpy(zero_copy_only=False),
           "bins": np.frombuffer(raw, np.uint8).reshape(n, -1) if n else np.zeros((0, 1), np.uint8)}
    return out | {y: table[f"y_{y}"].to_numpy(zero_copy_only=False).astype(np.float64) for y in labels}


def _used(a: dict, fit: Fit) -> np.ndarray:
    """Rows that the fit learns from."""
    use = a["train"] & ~np.isnan(a[fit.label])
    return use if fit.fold is None else use & (a["fold"] != fit.fold)


def _gradients(pred, y: np.ndarray, scale: Scale) -> np.ndarray:
    return np.rint((pred - y) * scale.unit).astype(np.int64)


def base_of(y_sum: int, n: int, scale: Scale) -> float:
    """The mean label of a boosted fit's rows, from their summed gradients against the middle of the range."""
    return scale.middle - y_sum / scale.unit / n if n else scale.middle


def grow_trees(a: dict, fit: Fit, scale: Scale, first: int, n: int):
    """Trees ``first`` to ``first + n`` of a forest, or all of a boosted fit, and the base they add up to."""
    s, use = fit.settings, np.flatnonzero(_used(a, fit))
    ids, bins, y = a["id"][use], a["bins"][use], a[fit.label][use]
    start = _gradients(scale.middle, y, scale)
    if s.kind == "forest":
        for t in range(first, first + n):
            yield t, 0.0, grow(bins, start, bag(ids, t, s), s, scale, tree_features(t, s, bins.shape[1]))
        return
    base = base_of(int(start.sum()), len(y), scale)
    pred = np.full(len(y), base)
    for t in range(s.trees):
        tree = grow(bins, _gradients(pred, y, scale), bag(ids, t, s), s, scale, tree_features(t, s, bins.shape[1]))
        pred += tree["value"][walk(tree, bins)]
        yield t, base, tree


def _tasks(fits: list[Fit]) -> list[tuple[Fit, int, int]]:
    out = []
    for fit in fits:
        if fit.settings.kind == "forest":
            out += [(fit, k, min(TREES_PER_TASK, fit.settings.trees - k)) for k in range(0, fit.settings.trees, TREES_PER_TASK)]
        else:
            out.append((fit, 0, fit.settings.trees))
    # the longest first, so that the last tasks are short
    return sorted(out, key=lambda x: (x[0].settings.kind == "forest", -x[0].settings.trees))


def _node_frame(fit: int, tree: int, t: dict, edges: list[np.ndarray], offset: int | None = None) -> pd.DataFrame:
    """A tree as rows of the node table; ``offset``: the node of a larger tree that this one continues."""
    feature = t["feature"]
    cut = np.array([edges[f][b] if f >= 0 and b < len(edges[f]) else np.inf if f >= 0 else np.nan
                    for f, b in zip(feature.tolist(), t["bin"].tolist())], np.float64)
    names = np.arange(len(feature), dtype=np.int64)
    left, right = t["left"].astype(np.int64), t["right"].astype(np.int64)
    if offset is not None:
        names, left, right = (np.where(x == 0, offset, offset << 32 | x) for x in (names, left, right))
    inner = feature >= 0
    out = pd.DataFrame({"fit": np.int32(fit), "tree": np.int32(tree), "node": names, "feature": feature.astype(np.int32),
                        "threshold": cut, "left": np.where(inner, left, -1), "right": np.where(inner, right, -1),
                        "value": np.where(inner, 0.0, t["value"]), "gain": t["gain"], "rows": t["rows"].astype(np.int64)})
    # nodes that a leaf limit closed are not reachable
    if offset is None and (~inner & (t["left"] > 0)).any():
        reach, todo = np.zeros(len(feature), bool), [0]
        while todo:
            k = todo.pop()
            reach[k] = True
            todo += [int(t["left"][k]), int(t["right"][k])] if inner[k] else []
        out = out[reach]
    return out


def fit_nodes(m: Matrix, fits: list[Fit], row_bound: int = ROW_BOUND) -> DataFrame:
    """The node table of the fits."""
    return _nodes_by_task(m, fits) if m.n_train <= row_bound else _nodes_in_lockstep(m, fits, row_bound)


def base_values(m: Matrix, fits: list[Fit]) -> dict[int, float]:
    """What each fit's leaf values are added to (one aggregate)."""
    aggs = [F.lit(0).alias("_")]
    for f in fits:
        y, scale = F.col(f"y_{f.label}"), m.scales[f.label]
        use = F.col("train") & y.isNotNull() & ~F.isnan(y) & (F.lit(True) if f.fold is None else F.col("fold") != f.fold)
        g = F.rint((F.lit(scale.middle) - y) * F.lit(scale.unit)).cast("long")
        if f.settings.kind == "boost":
            aggs += [F.sum(F.when(use, g)).alias(f"g{f.fit}"), F.count(F.when(use, 1)).alias(f"n{f.fit}")]
    got = m.rows.agg(*aggs).first()
    return {f.fit: base_of(got[f"g{f.fit}"] or 0, got[f"n{f.fit}"], m.scales[f.label]) if f.settings.kind == "boost" else 0.0
            for f in fits}


def _shared(m: Matrix, fits: list[Fit]):
    """The whole matrix (at most ROW_BOUND training rows) in every task, and the tasks."""
    sc, labels = m.rows.sparkSession.sparkContext, sorted({f.label for f in fits})
    table = m.rows.where("train").select("id", "train", "fold", *[f"y_{y}" for y in labels], "bins").toArrow().combine_chunks()
    order = np.argsort(table["id"].to_numpy(), kind="stable")
    a = _arrays(table.take(pa.array(order)), labels)
    return sc.broadcast(a), _tasks(fits)


def _nodes_by_task(m: Matrix, fits: list[Fit]) -> DataFrame:
    spark = m.rows.sparkSession
    box, tasks = _shared(m, fits)
    scales, edges = m.scales, m.edges

    def run(batches):
        for part in batches:
            for k in part["id"]:
                fit, first, n = tasks[k]
                for t, _, tree in grow_trees(box.value, fit, scales[fit.label], first, n):
                    yield _node_frame(fit.fit, t, tree, edges)

    return spark.range(0, len(tasks), 1, len(tasks)).mapInPandas(run, NODE_SCHEMA)


def held_out_predictions(m: Matrix, fits: list[Fit], row_bound: int = ROW_BOUND) -> DataFrame:
    """Per fit with a fold: id, y and prediction of the fold's training rows."""
    if m.n_train > row_bound:
        nodes, base = stored(fit_nodes(m, fits, row_bound), "nodes"), base_values(m, fits)
        parts = []
        for f in fits:
            rows = m.rows.where(F.col("train") & (F.col("fold") == f.fold) & F.col(f"y_{f.label}").isNotNull())
            scored = predict(rows, nodes.where(F.col("fit") == f.fit), base[f.fit], values_of_bins(m))
            parts.append(scored.select(F.lit(f.fit).alias("fit"), "id", F.col(f"y_{f.label}").alias("y"), "prediction"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    spark = m.rows.sparkSession
    box, tasks = _shared(m, fits)
    scales = m.scales

    def run(batches):
        for part in batches:
            for k in part["id"]:
                fit, first, n = tasks[k]
                a = box.value
                out = np.flatnonzero(a["train"] & ~np.isnan(a[fit.label]) & (a["fold"] == fit.fold))
                bins, total, base = a["bins"][out], np.zeros(len(out)), 0.0
                for _, base, tree in grow_trees(a, fit, scales[fit.label], first, n):
                    total += tree["value"][walk(tree, bins)]
                yield pd.DataFrame({"fit": np.int32(fit.fit), "id": a["id"][out], "y": a[fit.label][out], "part": total + base})

    rows = spark.range(0, len(tasks), 1, len(tasks)).mapInPandas(run, "fit int, id long, y double, part double")
    return rows.groupBy("fit", "id").agg(F.first("y").alias("y"), F.sum("part").alias("prediction"))


# ---------------------------------------------------------------- lockstep over the whole table

#: Forest trees that grow in lockstep, and boosting rounds between two written states.
TREES_AT_ONCE = 50
ROUNDS_WRITTEN = 10


def _tree_rows(a: dict, pred, fit: Fit, t: int, at: int, scale: Scale):
    """(gradients, weights, rows) of the rows in the tree's sample."""
    use = np.flatnonzero(_used(a, fit))
    w = bag(a["id"][use], t, fit.settings)
    use, w = use[w > 0], w[w > 0]
    start = scale.middle if pred is None else pred[use, at]
    return _gradients(start, a[fit.label][use], scale), w, use


def _with_pred(batch, n: int):
    return batch["pred"].flatten().to_numpy(zero_copy_only=False).reshape(-1, n) if n else None


def _level(m: Matrix, rows: DataFrame, labels: list[str], growing: list[tuple], n_pred: int) -> None:
    """One aggregate: splits the open nodes of every growing tree (number, fit, tree, Growth, place of its prediction)."""
    state = [(k, fit, t, {x: np.array(getattr(gr, x)) for x in ("feature", "bin", "left", "right")}, gr.open, at)
             for k, fit, t, gr, at in growing if gr.open]
    if not state:
        return
    box = rows.sparkSession.sparkContext.broadcast(state)
    scales, width = m.scales, len(m.features)

    def add(batches):
        total: dict[int, list] = {}
        for b in batches:
            a, pred = _arrays(b, labels), _with_pred(b, n_pred)
            for k, fit, t, tree, nodes, at in box.value:
                g, w, use = _tree_rows(a, pred, fit, t, at, scales[fit.label])
                place = np.full(len(tree["feature"]), -1)
                place[nodes] = np.arange(len(nodes))
                of = place[walk(tree, a["bins"][use])]
                mine = np.flatnonzero(of >= 0)
                feats = tree_features(t, fit.settings, width)
                got = [np.rint(x).astype(np.int64) for x in sums(a["bins"][use[mine]][:, feats], of[mine], (g * w)[mine], w[mine], len(nodes))]
                total[k] = [x + y for x, y in zip(total[k], got)] if k in total else got
        for k, (g, w, c) in total.items():
            n, f, b = np.nonzero(c)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x.astype(np.int32)) for x in (np.full(len(n), k), n, f, b)], *[pa.array(x[n, f, b]) for x in (g, w, c)]],
                names=["k", "n", "f", "b", "g", "w", "c"])

    cells = rows.mapInArrow(add, "k int, n int, f int, b int, g long, w long, c long")
    cells = cells.groupBy("k", "n", "f", "b").agg(*[F.sum(x).alias(x) for x in "gwc"])
    settings = {k: (fit.settings, scales[fit.label], t) for k, fit, t, _, _ in growing}

    def best(key, part: pd.DataFrame) -> pd.DataFrame:
        s, scale, t = settings[int(key[0])]
        feats = tree_features(t, s, width)
        grid = [np.zeros((1, len(feats), BINS), np.int64) for _ in range(3)]
        for x, c in zip(grid, "gwc"):
            x[0, part["f"].to_numpy(), part["b"].to_numpy()] = part[c].to_numpy()
        grid[0] = grid[0] / scale.unit
        f, b, gain, g, w, c = splits_of_sums(s, scale, *grid, feats)[0]
        all_g, all_w, all_c = (float(x[0, 0].sum()) for x in grid)
        return pd.DataFrame([[*map(int, key), f, b, gain, g, w, int(c), all_g, all_w, int(all_c)]],
                            columns=["k", "n", "f", "b", "gain", "g", "w", "c", "all_g", "all_w", "all_c"])

    got = cells.groupBy("k", "n").applyInPandas(
        best, "k int, n int, f int, b int, gain double, g double, w double, c long, all_g double, all_w double, all_c long")
    found = {(r["k"], r["n"]): r for r in got.collect()}
    for k, _, _, gr, _ in growing:
        splits = []
        for n, node in enumerate(gr.open):
            r = found.get((k, n))
            if r is not None and node == 0:
                gr.g[0], gr.w[0], gr.c[0] = r["all_g"], r["all_w"], r["all_c"]
            splits.append(tuple(r)[2:8] if r is not None and gr._may(node) else (-1,) * 6)
        gr.take(splits)


def _new_growth(s: Settings, scale: Scale) -> Growth:
    """A tree whose root's sums the first level brings."""
    gr = Growth(s, scale, 0, 0, 0)
    gr.open = [0]
    return gr


def _nodes_in_lockstep(m: Matrix, fits: list[Fit], row_bound: int) -> DataFrame:
    parts = [_forest_in_lockstep(m, f, first, row_bound) for f in fits if f.settings.kind == "forest"
             for first in range(0, f.settings.trees, TREES_AT_ONCE)]
    boosted = [f for f in fits if f.settings.kind == "boost"]
    if boosted:
        parts.append(_boost_in_lockstep(m, boosted))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _forest_in_lockstep(m: Matrix, fit: Fit, first: int, row_bound: int) -> DataFrame:
    spark, s, scale, labels, edges = m.rows.sparkSession, fit.settings, m.scales[fit.label], [fit.label], m.edges
    growing = [(t, fit, t, _new_growth(s, scale), 0) for t in range(first, min(first + TREES_AT_ONCE, s.trees))]
    small: dict[int, list[int]] = {t: [] for t, *_ in growing}
    while any(gr.open for *_, gr, _ in growing):
        _level(m, m.rows, labels, growing, 0)
        for t, _, _, gr, _ in growing:
            if s.leaves is None:
                small[t] += [n for n in gr.open if gr.c[n] <= row_bound]
                gr.open = [n for n in gr.open if gr.c[n] > row_bound]
    tops = {t: gr.finish() for t, _, _, gr, _ in growing}
    # the upper parts hold about 2 x rows / row_bound nodes a tree
    upper = pd.concat([f[~f["node"].isin(small[t])] for t, f in ((t, _node_frame(fit.fit, t, x, edges)) for t, x in tops.items())])
    depth = {t: gr.depth for t, _, _, gr, _ in growing}
    box = spark.sparkContext.broadcast((tops, small))

    def send(batches):
        tops, small = box.value
        for b in batches:
            a = _arrays(b, labels)
            for t, tree in tops.items():
                if not small[t]:
                    continue
                g, w, use = _tree_rows(a, None, fit, t, 0, scale)
                at = walk(tree, a["bins"][use])
                mine = np.flatnonzero(np.isin(at, small[t]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), t, np.int32)), pa.array(at[mine]), pa.array(g[mine]), pa.array(w[mine]),
                     pa.array([x.tobytes() for x in a["bins"][use[mine]]], pa.binary())], names=["t", "node", "g", "w", "bins"])

    def end(key, part: pd.DataFrame) -> pd.DataFrame:
        t, node = map(int, key)
        bins = np.frombuffer(b"".join(part["bins"]), np.uint8).reshape(len(part), -1)
        feats = tree_features(t, s, bins.shape[1])
        tree = grow(bins, part["g"].to_numpy(), part["w"].to_numpy(), s, scale, feats, depth[t][node])
        return _node_frame(fit.fit, t, tree, edges, node)

    lower = m.rows.where("train").mapInArrow(send, "t int, node long, g long, w long, bins binary")
    lower = lower.groupBy("t", "node").applyInPandas(end, NODE_SCHEMA)
    return spark.createDataFrame(upper, NODE_SCHEMA).unionByName(lower)


def _boost_in_lockstep(m: Matrix, fits: list[Fit]) -> DataFrame:
    spark, labels = m.rows.sparkSession, sorted({f.label for f in fits})
    base = base_values(m, fits)
    start = F.array(*[F.lit(base[f.fit]) for f in fits])
    state = m.rows.where("train").select("id", "train", "fold", *[f"y_{y}" for y in labels], "bins", start.alias("pred"))
    frames, n_fits, kinds = [], len(fits), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema)
    for t in range(max(f.settings.trees for f in fits)):
        growing = [(k, f, t, _new_growth(f.settings, m.scales[f.label]), k) for k, f in enumerate(fits) if t < f.settings.trees]
        while any(gr.open for *_, gr, _ in growing):
            _level(m, state, labels, growing, n_fits)
        grown = {k: gr.finish() for k, _, _, gr, _ in growing}
        frames += [_node_frame(fits[k].fit, t, x, m.edges) for k, x in grown.items()]
        state = _next_state(m, state, grown, n_fits, kinds, t)
    return spark.createDataFrame(pd.concat(frames), NODE_SCHEMA)


def _next_state(m: Matrix, state: DataFrame, grown: dict, n_fits: int, kinds: str, t: int) -> DataFrame:
    """The rows with the new trees' values added to their predictions."""
    box = state.sparkSession.sparkContext.broadcast(grown)

    def add(batches):
        for b in batches:
            bins = np.frombuffer(b"".join(b["bins"].to_pylist()), np.uint8).reshape(b.num_rows, -1)
            pred = _with_pred(b, n_fits).copy()
            for k, tree in box.value.items():
                pred[:, k] += tree["value"][walk(tree, bins)]
            limits = pa.array(np.arange(0, pred.size + 1, n_fits), pa.int32())
            new = pa.ListArray.from_arrays(limits, pa.array(pred.ravel()))
            yield pa.RecordBatch.from_arrays([new if c == "pred" else b[c] for c in b.schema.names], names=b.schema.names)

    out = state.mapInArrow(add, kinds)
    if t % ROUNDS_WRITTEN == ROUNDS_WRITTEN - 1:
        return stored(out, "boosting")
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    state.unpersist()
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again."""
    path = os.path.join(checkpoint_dir(df.sparkSession), "pondlens", uuid.uuid4().hex, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- applying node tables

def values_of_bins(m: Matrix):
    """A function from an Arrow batch of binned rows to values that fall into the same bins."""
    ends = [np.append(e, np.inf) for e in m.edges]

    def values(b) -> np.ndarray:
        bins = np.frombuffer(b"".join(b["bins"].to_pylist()), np.uint8).reshape(b.num_rows, len(ends))
        return np.stack([e[bins[:, f]] for f, e in enumerate(ends)], axis=1)

    return values


def _flat_trees(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """The node table as arrays, children by their places."""
    nodes = nodes.reset_index(drop=True)
    index = pd.MultiIndex.from_arrays([nodes["tree"], nodes["node"]])
    out = {c: nodes[c].to_numpy() for c in ("feature", "threshold", "value")}
    for side in ("left", "right"):
        out[side] = index.get_indexer(pd.MultiIndex.from_arrays([nodes["tree"], nodes[side]]))
    return out | {"roots": np.flatnonzero(nodes["node"].to_numpy() == 0)}


def _walk_values(flat: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The summed leaf values of each row, all trees at once."""
    at = np.tile(flat["roots"], (len(x), 1))
    row = np.broadcast_to(np.arange(len(x))[:, None], at.shape)
    while True:
        f = flat["feature"][at]
        inner = f >= 0
        if not inner.any():
            return flat["value"][at].sum(axis=1)
        n = at[inner]
        at[inner] = np.where(x[row[inner], f[inner]] <= flat["threshold"][n], flat["left"][n], flat["right"][n])


def predict(rows: DataFrame, nodes: DataFrame, base: float, values, name: str = "prediction", max_nodes: int = MAX_NODES) -> DataFrame:
    """``rows`` with the prediction of one fit's ``nodes``.

    ``values`` gives the features of an Arrow batch of ``rows`` as a matrix. Up
    to ``max_nodes`` nodes are broadcast; more are joined level by level.
    """
    schema = StructType([*rows.schema.fields, StructField(name, DoubleType())])
    if nodes.count() > max_nodes:
        return _predict_by_joins(rows, nodes, base, values, name)
    box = rows.sparkSession.sparkContext.broadcast(_flat_trees(nodes.select("tree", "node", "feature", "threshold", "left", "right", "value").toPandas()))

    def run(batches):
        for b in batches:
            total = _walk_values(box.value, values(b)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base + total)], names=[*b.schema.names, name])

    return rows.mapInArrow(run, schema)


def _predict_by_joins(rows: DataFrame, nodes: DataFrame, base: float, values, name: str) -> DataFrame:
    """Every (row, tree) moves one level with each join of the node table, until all stand on leaves."""
    schema = StructType([*rows.schema.fields, StructField("__x", ArrayType(DoubleType()))])

    def read(batches):
        for b in batches:
            x = values(b)
            limits = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(limits, pa.array(x.ravel()))],
                                             names=[*b.schema.names, "__x"])

    each = stored(rows.mapInArrow(read, schema).withColumn("__rid", F.monotonically_increasing_id()), "rows")
    roots = nodes.where("node = 0").select("tree")
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right", "value")
    at = each.select("__rid", "__x", F.lit(0).cast("long").alias("node")).join(roots)
    done = None
    while True:
        # one row for each (row, tree): the work of an ensemble, dealt by tree and node
        moved = stored(at.join(steps, ["tree", "node"]), "moved")
        ended = moved.where("feature < 0").groupBy("__rid").agg(F.sum("value").alias("value"))
        done = ended if done is None else done.unionByName(ended)
        left = moved.where("feature >= 0")
        if left.isEmpty():
            break
        to = F.when(F.get("__x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = left.select("__rid", "__x", "tree", to.alias("node"))
    total = done.groupBy("__rid").agg(F.sum("value").alias("__total"))
    out = each.join(total, "__rid")
    return out.select(*rows.columns, (F.lit(base) + F.col("__total")).alias(name))
