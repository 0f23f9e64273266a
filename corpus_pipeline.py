"""The corpus pipeline: stages over the documents table, each one operator of ``pondlens.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. A stage sees only what the one before kept.

Null and empty texts score like any text without words, are near-duplicates
and leaks of nothing, hold no secrets, and have no words that the mix could
take. Repeated rows are near-duplicates of each other, so one stays. Null ids
and sources are values like others. An empty table gives an empty result, an
empty ``labels`` a filter that keeps everything, an empty ``benchmark`` no
leaks. Further columns travel along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pondlens.llm import contamination, mixing, near_dup, queries, secrets, textops, toxicity


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above the threshold go."""
    name = textops.free_name(docs, "toxicity_score")
    scored = toxicity.score(docs, queries.toxicity_model(spark, docs, sf_dir), name=name)
    return scored.where(scored[name] < toxicity.THRESHOLD).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return contamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are replaced by their kind in brackets; every document stays."""
    return secrets.redact(docs, length_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each copy taken, dealt to output shards."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = textops.materialize(stage(spark, docs, sf_dir), name)
    return docs


#: SQL cannot express the trained filter, the sketches or the seeded draws.
ORACLE_SQL = None
