"""The subpackage's registered queries: ``opN_<name>(spark, sf_dir)`` over the
whole tables, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, grades, jaccard, langid, licenses, mixing, phrases, pseudo_lm, repeats, rules, spelling, warc
from .keys import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.score_documents(_table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grades.grade_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(_table(spark, sf_dir, "documents"))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.pages_of(warc.read_archives(spark, path))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "rule")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_decontaminate, op2_license_scan, op3_suffix_dedup, op4_pseudo_likelihood, op5_mix_sources,
        op6_ordinal_quality, op7_language_id, op8_warc_salvage, op9_quality_rules, op10_jaccard_join,
        op11_spelling_variants, op12_phrase_collocations, op13_bpe)}


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE_SQL
    return ORACLE_SQL
