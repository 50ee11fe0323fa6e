"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_digest, secret_scan

    return secret_digest(secret_scan(_table(spark, sf_dir, "documents")))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, share=(90, 100))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import pseudo_likelihood

    return pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contained_items

    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract_pages

    return extract_pages(_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .tokens import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    docs, _ = mix_sources(_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, repair_conversations, repair_digest

    conversations = _table(spark, sf_dir, "conversations")
    return repair_digest(conversations, *repair_conversations(damaged(conversations)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import fill_in_middle, fim_digest

    return fim_digest(fill_in_middle(_table(spark, sf_dir, "documents")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_decontamination": op5_decontamination,
        "op10_html_extraction": op10_html_extraction,
        "op7_secret_scan": op7_secret_scan,
        "op9_license_scan": op9_license_scan,
        "op6_token_counts": op6_token_counts,
        "op8_mix_sources": op8_mix_sources,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_toxicity": op13_toxicity,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against plain versions."""
    from . import oracles

    return oracles.oracle_sql()
