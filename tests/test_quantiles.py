import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pondlens.operators import quantiles as Q


def _np(vals, q):
    return float(np.quantile(np.array(vals, dtype=float), q, method="linear"))


def test_exact_quantiles_refinement_matches_numpy(spark):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.lognormal(3, 2, 20000), np.full(7000, 5.0), [1e9]])  # skew, hot value, outlier
    b = rng.integers(0, 50, 5000).astype(float)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b]
    long = spark.createDataFrame(rows, "column string, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = Q.exact_quantiles(long, probs, buckets=16)   # forces several refinement passes
    for col, vals in (("a", a), ("b", b)):
        for q in probs:
            assert got[(col, q)] == _np(vals, q), (col, q)


def test_grouped_quantile_table_both_paths(spark):
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.normal(0, 1, 3000)] + [("small", float(v)) for v in [4.0, 1.0, 2.0]] \
        + [("one", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = Q.quantile_table(df, ["v"], [0.25, 0.5, 0.9], by=["g"], small_group=100, buckets=8, passes=2).collect()
    vals = {"hot": [r[1] for r in rows if r[0] == "hot"], "small": [4.0, 1.0, 2.0], "one": [9.0]}
    assert len(out) == 9
    for r in out:
        assert abs(r["value"] - _np(vals[r["g"]], r["prob"])) < 1e-12


def test_all_null_column_gives_none(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    vals = Q.quantile_values(df, ["a", "b"], [0.5])
    assert vals[("a", 0.5)] is None and vals[("b", 0.5)] == 1.5


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.75, 1.0]))
def test_property_matches_numpy(spark, vals, q):
    long = spark.createDataFrame([("c", float(v)) for v in vals], "column string, v double")
    got = Q.exact_quantiles(long, [q], buckets=4)
    assert abs(got[("c", q)] - _np(vals, q)) <= 1e-9 * max(1.0, abs(_np(vals, q)))


def test_grouped_hot_group_with_hot_value(spark):
    rng = np.random.default_rng(11)
    hot = np.concatenate([rng.exponential(5.0, 4000), np.full(3000, 2.5)])      # a third of rows on one value
    rows = [(1, float(v)) for v in hot] + [(2, float(v)) for v in rng.normal(size=50)]
    df = spark.createDataFrame(rows, "g bigint, v double")
    out = Q.quantile_table(df, ["v"], [0.01, 0.5, 0.99], by=["g"], small_group=200, buckets=16, passes=3).collect()
    vals = {1: hot, 2: [r[1] for r in rows if r[0] == 2]}
    assert len(out) == 6
    for r in out:
        assert r["value"] == _np(vals[r["g"]], r["prob"]), (r["g"], r["prob"])


def test_any_spread_ends_in_few_passes(spark):
    rng = np.random.default_rng(5)
    spread = np.concatenate([10.0 ** rng.uniform(-300, 300, 400), -(10.0 ** rng.uniform(-300, 300, 400)), np.zeros(50),
                             [np.inf] * 3, [-np.inf] * 2, np.full(300, 7.25), [5e-324, 1e-323, 1.7e308, -1.7e308]])
    one = np.concatenate([rng.normal(size=500), [np.inf]])
    rows = [("s", float(v)) for v in spread] + [("o", float(v)) for v in one]
    long = spark.createDataFrame(rows, "column string, v double")
    probs = [0.001, 0.01, 0.3, 0.45, 0.5, 0.9, 0.999]
    seen = []
    join = Q._ranges_join
    Q._ranges_join = lambda *a: (seen.append(1), join(*a))[1]
    try:
        got = Q.exact_quantiles(long, probs)
    finally:
        Q._ranges_join = join
    assert len(seen) <= 6
    for c, vals in (("s", np.sort(spread)), ("o", np.sort(one))):
        for q in probs:
            h = (len(vals) - 1) * q
            a, b = vals[int(np.floor(h))], vals[int(np.ceil(h))]
            if a == b or a == -np.inf:
                want = a
            else:
                want = b if b == np.inf else a + (h - np.floor(h)) * (b - a)
            assert got[(c, q)] == want or abs(got[(c, q)] - want) <= 1e-12 * abs(want), (c, q)


def test_grouped_million_log_spread_rows_and_an_infinity(spark):
    """A hot group of a million rows over 600 decades, an infinity, ties, a NULL group and small groups."""
    from pyspark.sql import functions as F
    n = 1_000_000
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    hot = spark.range(0, n, 1, 8).select(F.lit("hot").alias("g"), F.pow(F.lit(10.0), u * 600 - 300).alias("v"))
    more = [("hot", float("inf")), ("hot", -float("inf"))] + [("tie", 3.5)] * 500 + [("tie", 4.5)] * 500 + [(None, 1.0), (None, 2.0), ("one", 7.0)]
    more += [("nan", float("nan")), ("nan", None)]
    df = hot.unionByName(spark.createDataFrame(more, "g string, v double"))
    probs = [0.0, 1e-6, 0.25, 0.5, 0.999999, 1.0]
    got = {(r["g"], r["prob"]): (r["n"], r["value"]) for r in Q.quantile_table(df, ["v"], probs, by=["g"]).collect()}
    values = {"hot": np.sort(df.where("g = 'hot'").select("v").toPandas()["v"].to_numpy()), None: np.array([1.0, 2.0]),
              "one": np.array([7.0]), "tie": np.array([3.5] * 500 + [4.5] * 500)}
    assert len(got) == len(values) * len(probs)
    for (g, q), (rows, value) in got.items():
        vals = values[g]
        h = (len(vals) - 1) * q
        a, b = vals[int(np.floor(h))], vals[int(np.ceil(h))]
        want = a if a == b or a == -np.inf else b if b == np.inf else a + (h - np.floor(h)) * (b - a)
        assert rows == len(vals) and value == want, (g, q)


def test_column_quantiles_keep_rows_whole_and_find_what_the_sketch_misses(spark, monkeypatch):
    """Wide columns: hot values, infinities, NULL, NaN and an empty column; with a sketch that points elsewhere too."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(17)
    n = 6000
    a = rng.lognormal(0, 3, n)
    b = rng.integers(0, 9, n).astype(float)
    c = np.where(rng.random(n) < 0.4, 7.5, rng.normal(size=n))
    c[:5], c[5:9] = np.inf, -np.inf
    rows = [(float(x), float(y), float(z), None if i % 3 else float(x), float("nan") if i % 2 else float(y), None)
            for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")
    want = {"a": a, "b": b, "c": c, "d": a[::3], "e": b[::2]}
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    joins = []
    join = Q._ranges_join
    monkeypatch.setattr(Q, "_ranges_join", lambda *x: (joins.append(1), join(*x))[1])
    # rows of all columns are never unfolded: the long form is for what the sketch misses
    monkeypatch.setattr(Q, "exact_quantiles", lambda *x: (_ for _ in ()).throw(AssertionError("long form")))
    stats = {}
    got = Q.column_quantiles([(df, {k: F.col(k) for k in "abcdef"})], probs, moments=stats)
    assert {k for k, _ in got} == set(want) == set(stats) and stats["d"]["n"] == len(want["d"])
    for k, vals in want.items():
        vals = np.sort(vals)
        for q in probs:
            h = (len(vals) - 1) * q
            lo, hi = vals[int(np.floor(h))], vals[int(np.ceil(h))]
            assert got[(k, q)] == (lo if lo == hi or lo == -np.inf else hi if hi == np.inf else lo + (h - np.floor(h)) * (hi - lo)), (k, q)
    monkeypatch.undo()
    monkeypatch.setattr(Q, "SKETCH_ERROR", -0.002)     # brackets that hold no wanted rank
    assert Q.column_quantiles([(df, {k: F.col(k) for k in "abd"})], [0.3])[("a", 0.3)] == _np(a, 0.3)
