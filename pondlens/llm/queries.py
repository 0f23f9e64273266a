"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from pondlens.llm import (contamination, host_quality, html_text, importance, licenses, mixing, near_dup, packing, secrets, sql,
                          substring_dedup, token_alignment, toxicity, url_filter)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    kind = F.when(F.col("passage"), "passage").otherwise("paragraph")
    return spans.select("doc_id", F.col("start"), F.col("end"), kind.alias("kind"), "cluster", "keeper", "kept")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return secrets.digest(found)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from the labels of rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.train(docs, labels.select("doc_id", F.col("toxic").alias("label")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_table(table(spark, sf_dir, "documents"))
    shards = F.array_join(F.col("shards").cast("array<string>"), ",")
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", shards.alias("shards"))


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumn("host_rate", F.round("host_rate", 9))


def vocabulary(name: str) -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                  vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_passages": op1_repeated_passages,
    "op2_url_filter": op2_url_filter,
    "op3_secret_scan": op3_secret_scan,
    "op4_main_text": op4_main_text,
    "op5_license_scan": op5_license_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_benchmark_leaks": op7_benchmark_leaks,
    "op8_toxicity": op8_toxicity,
    "op9_source_mix": op9_source_mix,
    "op10_host_quality": op10_host_quality,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_importance_draw": op12_importance_draw,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op6_near_duplicates": sql.NEAR_DUPLICATES,
    "op7_benchmark_leaks": sql.CONTAMINATION,
    "op10_host_quality": sql.HOST_QUALITY,
    "op12_importance_draw": sql.IMPORTANCE,
}
