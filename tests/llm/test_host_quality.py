import math
import re
import statistics
from collections import Counter, defaultdict

import pytest

from pondlens.llm import host_quality as H
from tests.llm.common import docs, ws_words

ROWS = ([(i, " ".join(f"w{i}x{j}" for j in range(60)), "good") for i in range(20)]
        + [(100 + i, "too short", "bad") for i in range(40)] + [(200, " ".join(f"v{j}" for j in range(55)), "bad")]
        + [(300, None, None), (301, "", ""), (302, "a b c a b c a b c " * 20, "good"), (None, "x y z", "good"),
           (303, "l1 x\nl1 x\n\n \nl1 x\nother\n", "good"), (304, "# * $$ %& |<> a", "good"),
           (305, "q r s " * 30000, "hot"), (306, "same", "good"), (306, "same", "good"),
           (307, "a b a b a b c d\r\x0b\x0c e " * 9, "good"), (308, " lead trail ", "good")])


def brute(text):
    text = text or ""
    w = ws_words(text)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if ws_words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(lines))


def verdicts(rows):
    host, out = defaultdict(lambda: [0, 0]), []
    for i, t, s in rows:
        n, chars, sym, dup, rep, lines = brute(t)
        base = n < 50 or 100 * rep > 50 * n
        host[s][0] += 1
        host[s][1] += base or sym > n or dup > 0.7 * lines
        out.append((i, n, chars, sym, dup, rep, base, s))
    rates = [x / d for d, x in host.values() if d > 1]
    mean, strength = (statistics.fmean(rates), H.MAX_STRENGTH) if rates else (statistics.fmean(x / d for d, x in host.values()), H.MAX_STRENGTH)
    if len(rates) > 1:
        between = statistics.variance(rates) - statistics.fmean(x / d * (1 - x / d) / (d - 1) for d, x in host.values() if d > 1)
        strength = min(strength, max(1, mean * (1 - mean) / between - 1)) if between > 0 else strength
    rate = {s: (x + mean * strength) / (d + strength) for s, (d, x) in host.items()}
    return sorted([(*r[:7], not (r[6] or rate[r[7]] > H.MAX_HOST_RATE)) for r in out], key=str), rate


def test_measures_and_verdicts_match_brute_force(spark):
    want, rate = verdicts(ROWS)
    got = H.judge(docs(spark, ROWS)).collect()
    assert sorted([tuple(r)[:8] for r in got], key=str) == want
    assert rate["bad"] > H.MAX_HOST_RATE > rate["good"]     # a good document of a bad host goes
    by = {r.doc_id: r for r in got}
    assert not by[200].base_failed and not by[200].kept and by[0].kept
    assert math.isclose(by[0].host_rate, rate["good"], rel_tol=1e-9)


def test_no_python_on_the_main_path(spark):
    plan = H.measures(docs(spark, ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_empty_and_single(spark, rows):
    assert H.judge(docs(spark, rows)).count() == len(rows)


@pytest.mark.parametrize("hosts,each", [(20, 500), (20, 50000), (2000, 500), (2000, 5), (3, 300000)])
def test_a_bad_host_keeps_its_verdict_as_the_others_grow(spark, hosts, each):
    others = spark.range(hosts * each).selectExpr(f"concat('h', id % {hosts}) AS host", "pmod(xxhash64(id), 100) < 15 AS failed")
    bad = spark.range(100).selectExpr("'bad' AS host", "true AS failed")
    few = spark.range(4).selectExpr("'few' AS host", "id < 3 AS failed")
    rates = H.host_rates(others.union(bad).union(few))
    assert [r.host for r in rates.where("rejected").collect()] == ["bad"]
