"""The registered query of each operator, and oracles where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import centroids, decontamination, fill_in_middle, licenses, line_dedup, ngram_join, oracles, packing, quality, recompression, rendering, tool_calls, toxicity, urls
from .tables import table


def op1_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.render_pages(table(spark, sf_dir, "pages"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compression_bands(table(spark, sf_dir, "documents"))


def op4_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(table(spark, sf_dir, "conversations"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_drake_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")).drop("output")


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents"))


def quality_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3 that SQL can express."""
    return op3_compression_bands(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def license_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can express."""
    return op8_license_notices(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can express."""
    return op9_url_model(spark, sf_dir).select("page_id", "host", "path", "rule")


_OPERATORS = (
    op1_gru_toxicity, op2_html_layout, op3_compression_bands, op4_hilbert_packing, op5_tool_calls,
    op6_spaced_seeds, op7_line_similarity, op8_license_notices, op9_url_model, op10_jaccard_regions,
    op11_drake_bounds, op12_fill_in_middle, op13_recompression,
)
QUERIES = {f.__name__: f for f in (*_OPERATORS, quality_base_columns, license_base_columns, url_rules)}
ORACLES: dict[str, str] = {
    "op5_tool_calls": oracles.OP5,
    "op7_line_similarity": oracles.OP7,
    "op11_drake_bounds": oracles.OP11,
    "op12_fill_in_middle": oracles.OP12,
    "op13_recompression": oracles.OP13,
    "quality_base_columns": oracles.QUALITY_BASE,
    "license_base_columns": oracles.LICENSE_BASE,
    "url_rules": oracles.URL_RULES,
}
