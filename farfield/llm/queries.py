"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farfield.llm.common import table
from farfield.llm.edit_counts import edit_counts
from farfield.llm.embedding_dedup import link_vectors
from farfield.llm.exact_dedup import exact_dedup
from farfield.llm.html_text import extract_pages
from farfield.llm.lm_score import lm_scores
from farfield.llm.minhash_dedup import near_classes
from farfield.llm.mixing import mix_sources
from farfield.llm.packing import pack
from farfield.llm.quality import judge
from farfield.llm.suffix_dedup import remove_repeats


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pack, op2_embedding_dedup, op3_minhash_dedup, op4_suffix_dedup, op5_mix, op6_html, op7_lm_score, op8_quality, op9_edit_counts, op10_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    }
