import re

import corpus_pipeline as P
import pytest
from pondlens.llm import mixing, secrets, toxicity
from tests.llm.test_near_dup import brute as near_groups
from tests.llm.test_contamination import brute as leaks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns on the documents, the stages called one after another."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in P.STAGES:
        docs = P.textops.materialize(stage(spark, docs, SF), name)
        out.append((name, docs))
    return [(n, d, d.collect()) for n, d in out]


def test_stages_and_columns(kept):
    assert [n for n, _, _ in kept] == ["documents", "toxicity", "near_dedup", "decontaminate", "secret_scan", "source_mix"]
    for _, d, _ in kept[:-1]:
        assert d.columns == kept[0][1].columns
    assert kept[-1][1].columns[:5] == kept[0][1].columns


def test_decisions_take_effect(spark, kept):
    rows = {n: r for n, _, r in kept}
    model = P.queries.toxicity_model(spark, kept[0][1], SF)
    scores = {r.doc_id: r.score for r in toxicity.score(kept[0][1], model).collect()}
    assert {r.doc_id for r in rows["toxicity"]} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}

    def triples(rs):
        return [(r.doc_id, r.text, r.source) for r in rs]

    want = {d for d, n, c, k in near_groups(triples(rows["toxicity"])) if k}
    assert sorted(r.doc_id for r in rows["near_dedup"]) == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {x[0] for x in leaks(triples(rows["near_dedup"]), items)}
    assert sorted(r.doc_id for r in rows["decontaminate"]) == sorted({r.doc_id for r in rows["near_dedup"]} - bad)
    assert [r.doc_id for r in sorted(rows["secret_scan"])] == [r.doc_id for r in sorted(rows["decontaminate"])]
    assert secrets.scan(kept[4][1]).where("size(findings) > 0").count() == 0
    clean = {r.doc_id: r for r in rows["decontaminate"] if not secrets.find_secrets(r.text or "")}
    assert all(r == clean[r.doc_id] for r in rows["secret_scan"] if r.doc_id in clean)
    assert all(r.n_chars == len(r.text) for r in rows["secret_scan"])
    plan = mixing.mix_plan(kept[4][1]).collect()
    assert sum(r.mix_words for r in rows["source_mix"]) == sum(r.taken for r in plan)
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.mix_words for r in rows["source_mix"])


NAMES = ["toxicity_score", "mix_copy", "mix_words", "leaks", "Score", "group", "kept", "taken", "findings"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
LONG = " ".join(f"w{i % 4000}" for i in range(60000))
ITEM = " ".join(f"item{i}" for i in range(30))


def folder(spark, tmp_path, rows, items=(), labels=()):
    out = str(tmp_path / "tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_empty_tables(spark, tmp_path):
    got = P.run(spark, folder(spark, tmp_path, []))
    assert got.count() == 0 and got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_nulls_repeats_long_texts_and_clashing_names(spark, tmp_path):
    more = tuple(f"own {n}" for n in NAMES)
    texts = [(1, None, None), (2, "", "a"), (3, "  \n ", "a"), (4, LONG, "a"), (4, LONG, "a"), (5, f"start {ITEM} end", "b"),
             (None, "a text without any id but with words of its own", None), (6, "one two three four five six seven eight", "b"),
             (7, "short", "b"), (8, "short", "c"), (9, "token = abcdef123456 stands here", "c")]
    rows = [(i, t, None, s, None if t is None else len(t), *more) for i, t, s in texts]
    sf = folder(spark, tmp_path, rows, [(1, ITEM), (2, None), (None, "")])
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in P.STAGES:
        docs = P.textops.materialize(stage(spark, docs, sf), name)
        seen[name] = docs.collect()
        if name != "source_mix":
            assert docs.columns == spark.read.parquet(f"{sf}/documents.parquet").columns
        assert all(r[n] == f"own {n}" for r in seen[name] for n in NAMES)
    ids = {n: sorted([r.doc_id for r in v], key=str) for n, v in seen.items()}
    assert len(ids["toxicity"]) == len(texts)                                  # no labels: everything stays
    assert ids["near_dedup"] == sorted([1, 2, 3, 4, 5, None, 6, 7, 9], key=str)    # 4 once, 8 is a copy of 7
    assert ids["decontaminate"] == ids["secret_scan"] == sorted([1, 2, 3, 4, None, 6, 7, 9], key=str)
    assert "abcdef123456" not in {r.doc_id: r for r in seen["secret_scan"]}[9].text
    assert docs.columns[-3:] == ["mix_copy_", "mix_words_", "mix_shard"]
    assert all(r.text.strip() for r in seen["source_mix"])
