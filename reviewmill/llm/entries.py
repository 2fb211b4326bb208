"""The registered queries of the numbered operators, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import (
    alignment,
    fingerprints,
    html_text,
    impact_search,
    jaccard_join,
    language,
    mixing,
    packing,
    piece_tokens,
    quality_model,
    quality_rules,
    secrets,
    toxicity,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.digest(jaccard_join.join(table(spark, folder, "documents")))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.held_out_query(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.held_out_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(mixing.scheduled(table(spark, folder, "documents"), keep=["doc_id", "source"]))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.digest(packing.pack(table(spark, folder, "documents"), vocabulary, ranks))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(quality_rules.clean(table(spark, folder, "documents")))


def op10_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.held_out_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary, model = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.query(table(spark, folder, "documents"), vocabulary, model)


def op12_piece_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_tokens.digest(piece_tokens.encoded(table(spark, folder, "documents"), model, decoded="decoded"))


def op13_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    return impact_search.digest(impact_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language": op3_language,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_secrets": op8_secrets,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_model": op10_quality_model,
    "op11_alignment": op11_alignment,
    "op12_piece_tokens": op12_piece_tokens,
    "op13_impact_search": op13_impact_search,
}
ORACLES: dict[str, str] = {
    "op5_mixing": mixing.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op13_impact_search": impact_search.ORACLE,
}
