import hashlib
import re

from pondlens.llm import secrets as S
from tests.llm.common import docs

KEY = "AKIA" + "Q" * 16
HEXES = "0123456789abcdef01234567"
TEXTS = [
    (1, f'password = "hunter22x" and {KEY} é {HEXES}', "a"),
    (2, f'password = "hunter22x" and {KEY} é {HEXES}', "b"),
    (3, "token=secret=abcdef TOKEN: abc", "a"),
    (4, None, None), (5, "", "a"), (None, "api_key:abcdefg", None),
    (6, "é" * 30 + "Apikey' : 'zzzzzz9' AKIAQ" + "f" * 23, "a"), (6, "clean words only", "a"), (6, "clean words only", "a"),
    (7, "word " * 40000 + "secret=/very.long_tail-x", "hot"),
    (8, "-----BEGIN RSA PRIVATE KEY-----\nabcd\n-----END RSA PRIVATE KEY----- ghp_" + "a" * 36, "a"),
    (9, "paſſword=abcdefgh toKen=ABCDEFGH", "a"),
]


def brute(text):
    text = text or ""
    rules = [("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
             ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]
    out = []
    for k, (name, rx) in enumerate(rules):
        for m in rx.finditer(text):
            if name == "assign" and len(m[2]) < 6 or name == "access" and len(m[0]) < 20 or name == "hex" and len(m[0]) < 24:
                continue
            out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def expected(rows_):
    out = []
    for i, t, _ in rows_:
        b = brute(t)
        n = [sum(x[1] == k for x in b) for k in range(3)]
        joined = ",".join(x[2] for x in b)
        out.append((i, *n, hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def test_base_spans_match_brute_force(spark):
    got = S.digest(S.scan(docs(spark, TEXTS)))
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == expected(TEXTS)
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert "pem:0:" in spans[8] and "hub:" in spans[8]
    assert spans[5] == ""


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    first = docs(spark, TEXTS[:6])
    rows(S.scan(first, ledger=path))
    n = spark.read.parquet(path).count()
    assert n == 4   # null and empty are one blob, 1 and 2 are one blob, and so on
    got = rows(S.digest(S.scan(docs(spark, TEXTS), ledger=path)))
    assert len(got) == len(TEXTS)
    ledger = spark.read.parquet(path)
    assert ledger.count() == ledger.select("blob").distinct().count() == 9
    rows(S.scan(first, ledger=path, rule_version="2"))
    assert spark.read.parquet(path).where("rule_version = '2'").count() == 4


def test_a_ledger_with_repeated_rows_gives_one_row_per_document(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    want = rows(S.digest(S.scan(docs(spark, TEXTS), ledger=path)))
    # another run that met the same blobs at the same time
    spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema).write.mode("append").parquet(path)
    assert rows(S.digest(S.scan(docs(spark, TEXTS), ledger=path))) == want


def test_redaction_keeps_rows_and_columns(spark):
    df = docs(spark, TEXTS)
    out = S.redact(df, length_col="n_chars")
    assert out.columns == df.columns and out.count() == len(TEXTS)
    assert S.scan(out).where("size(findings) > 0").count() == 0
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text == 'password = "[ASSIGN]" and [ACCESS] é [HEX]'.replace('password = "[ASSIGN]"', '[ASSIGN]"')
    assert by[4].text is None and by[5].text == "" and by[1].n_chars == len(by[1].text)


def test_empty_table(spark):
    df = docs(spark, [])
    assert S.digest(S.scan(df)).count() == 0 and S.redact(df).count() == 0
