"""Secret scans with an incremental blob ledger.

Texts are content-addressed: a blob is a distinct text, its id the SHA-256 of
the UTF-8 bytes. The ledger holds the findings of every (blob, rule version)
pair scanned so far; a run scans only the pairs the ledger lacks - a blob
with a thousand copies or versions once - appends them, and joins the findings
back to all documents (paths). Appending is one Parquet write; pairs that two
runs scanned at the same time, or that a failed run left behind, stand in the
ledger more than once and are read as one.

Rules: ``assign``, ``access`` and ``hex`` are the base kinds; ``pem``,
``jwt`` and ``hub`` (private-key blocks, signed web tokens and prefixed
access tokens) are the scanner's own. Matches are leftmost and non-overlapping
per kind; spans are in code points, the end exclusive.

A null text is the empty text and has no spans; a null id stays; rows that
repeat each get their findings; an empty table gives an empty result. Only
the id and text columns are read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

# The base rules. Minimum lengths are tested after matching.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")   # the same matches as runs of any length with shorter ones dropped
# The scanner's own kinds.
PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,40}PRIVATE KEY-----)?")
JWT = re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
HUB = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|glpat-[A-Za-z0-9_-]{20,})")
KINDS = (*BASE_KINDS, "pem", "jwt", "hub")
RULE_VERSION = "1"

FINDING = "struct<kind:int,start:int,end:int>"


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """All (kind index, start, end) of one text, by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [(3, m.start(), m.end()) for m in PEM.finditer(text)]
    if "eyJ" in text:
        out += [(4, m.start(), m.end()) for m in JWT.finditer(text)]
    if "_" in text or "-" in text:
        out += [(5, m.start(), m.end()) for m in HUB.finditer(text)]
    return sorted(out, key=lambda x: (x[1], x[0]))


def _scan(batches):
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t.as_py() or "")] for t in b["text"]]
        yield pa.RecordBatch.from_arrays([b["blob"], pa.array(found, type=kind)], names=["blob", "findings"])


def blob_id(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None,
         rule_version: str = RULE_VERSION) -> DataFrame:
    """Per document: the id, blob, and findings (array of kind, start, end).

    ``ledger``: folder of the ledger on shared storage; None starts a new one.
    """
    spark = docs.sparkSession
    T.bound_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    paths = texts.select("doc_id", blob_id(F.col("text")).alias("blob"))
    blobs = texts.select(blob_id(F.col("text")).alias("blob"), "text")
    fresh = ledger is None
    ledger = ledger or T.scratch_path(spark, "ledger")
    schema = f"blob binary, findings array<{FINDING}>, rule_version string"
    if not fresh:
        # a ledger not written yet has no rows
        spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
        seen = spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == rule_version)
        blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
    # one text for each blob; copies are dropped in the map tasks already
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    found = unseen.mapInArrow(_scan, f"blob binary, findings array<{FINDING}>")
    found.withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == rule_version)
    # two runs that met the same new blob, or a run that was repeated, leave equal rows
    hits = known.where(F.size("findings") > 0).groupBy("blob").agg(F.first("findings").alias("findings"))
    return (paths.join(hits, "blob", "left")
            .withColumn("findings", F.coalesce("findings", F.array().cast(f"array<{FINDING}>"))))


def _redacted(text: str, spans: list[dict]) -> str:
    parts, at = [], 0
    for s in spans:
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            parts += [text[at:s["start"]], "[", KINDS[s["kind"]].upper(), "]"]
        at = s["end"]
    return "".join([*parts, text[at:]])


def _redact(batches):
    for b in batches:
        texts, spans = b["text"], b["findings"]
        hit = [i for i, ok in enumerate(spans.is_valid().to_pylist()) if ok]
        if hit:
            out = texts.to_pylist()
            for i in hit:
                out[i] = _redacted(out[i], spans[i].as_py())
            texts = pa.array(out, type=pa.string())
        yield pa.RecordBatch.from_arrays([b["doc"], texts, spans], names=["doc", "text", "findings"])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
           ledger: str | None = None) -> DataFrame:
    """``docs`` with every finding replaced by its kind in brackets; no row goes.

    The findings of a text depend on the text alone, so they are joined by
    blob; texts are shuffled once for that join.
    """
    hits = (scan(docs, id_col, text_col, ledger).where(F.size("findings") > 0)
            .groupBy(F.col("blob").alias("hit")).agg(F.first("findings").alias("findings")))
    # the row travels as one struct, so its names clash with none of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text_col).alias("text"),
                       blob_id(F.col(text_col)).alias("blob"))
    found = rows.join(hits, F.col("blob") == F.col("hit"), "left").select("doc", "text", "findings")
    kind = found.schema["doc"].dataType.simpleString()
    done = found.mapInArrow(_redact, f"doc {kind}, text string, findings array<{FINDING}>")

    def column(c):
        old = F.col(f"doc.`{c}`")
        if c == text_col:
            return F.col("text").alias(c)
        if c == length_col:
            new = F.char_length("text").cast(docs.schema[c].dataType)
            return F.when(F.col("findings").isNotNull(), new).otherwise(old).alias(c)
        return old.alias(c)

    return done.select(*[column(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def shown(spans):
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def n(i):
        return F.size(F.filter("findings", lambda s: s["kind"] == i)).cast("long")

    base = F.filter("findings", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("findings")).alias("spans"))

