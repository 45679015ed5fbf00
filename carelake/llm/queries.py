"""The operators of this package as registered queries, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import exact, html_text, licences, lines, mixing, near, negatives, packing, pigeonhole, quality, secrets, simhash, spelling
from carelake.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where an installed public vocabulary lies; the same on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.drop("loss_tokens")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=negatives.relabelled())


def op13_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.near_components(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_licence_scan": op2_licence_scan,
        "op3_quality": op3_quality,
        "op4_near_dedup": op4_near_dedup,
        "op5_mixing": op5_mixing,
        "op6_secret_scan": op6_secret_scan,
        "op7_simhash": op7_simhash,
        "op8_line_dedup": op8_line_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_packing": op10_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_simhash_components": op13_simhash_components,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_mixing": mixing.ORACLE,
        "op6_secret_scan": secrets.ORACLE,
        "op9_exact_dedup": exact.ORACLE,
        "op12_hard_negatives": negatives.ORACLE,
    }
