"""Profiling counts on a tiny dirty catalog."""
from pondlens.config import PipelineConfig
from pondlens.operators import profile as P


def _cat(spark):
    farms = spark.createDataFrame([(1,), (2,)], "id bigint")
    ponds = spark.createDataFrame([(1, 1, -2.0, 0.0, 1.0), (2, 7, None, 3.0, 1.0), (3, None, 1.0, 1.0, 1.0)],
                                  "id bigint, farm_id bigint, length double, width double, deep double")
    sampling = spark.createDataFrame([(1, 0.0), (9, 1.0), (9, 2.0), (None, 3.0)],
                                     "cycle_id bigint, average_weight double")
    cycles = spark.createDataFrame([(1, 1)], "id bigint, pond_id bigint")
    return {"farms": farms, "ponds": ponds, "sampling": sampling, "cycles": cycles}


def test_issue_counts(spark):
    cat, cfg = _cat(spark), PipelineConfig()
    miss = {(r.dataset, r.column): (r["count"], r.percentage) for r in P.missing_profile(cat, cfg).collect()}
    assert miss[("ponds", "length")] == (1, 1 / 3 * 100) and miss[("sampling", "cycle_id")] == (1, 25.0)
    neg = {(r.dataset, r.column): r["count"] for r in P.value_checks(cat, cfg, "negative_values").collect()}
    assert neg == {("ponds", "length"): 1}
    zero = {(r.dataset, r.column): r["count"] for r in P.value_checks(cat, cfg, "zero_values").collect()}
    assert zero == {("ponds", "width"): 1}                      # average_weight zeros are not reported
    fk = {r.relation: r["count"] for r in P.fk_violations(cat, cfg).collect()}
    assert fk == {"ponds-farms": 1, "sampling-cycles": 1}      # NULL keys are not violations
    issues = P.dq_issues(cat, cfg).collect()
    assert {r.issue for r in issues} == {"missing_values", "negative_values", "zero_values", "invalid_foreign_key"}


def test_describe_matches_pandas(spark):
    import pandas as pd
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    r = P.describe_numeric(df, "t").first()
    d = pd.Series([1.0, 2.0, 4.0]).describe()
    assert r["count"] == 3 and abs(r.std - d["std"]) < 1e-12
    assert (r.q25, r.q50, r.q75) == (d["25%"], d["50%"], d["75%"])


def test_describe_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    rows = {r.column: r for r in P.describe_numeric(df, "t").collect()}
    assert rows["a"]["count"] == 0 and rows["a"].mean is None and rows["b"].q50 == 2.0
