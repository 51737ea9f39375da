"""The registered queries of the numbered operators, and the SQL for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversations,
    decontamination,
    html_text,
    inner_product,
    language,
    licenses,
    merkle,
    packing,
    pii,
    quality,
    simhash,
    warc,
)
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark, sf_dir):
    return inner_product.top_products(
        _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0
    )


def op3_language_id(spark, sf_dir):
    return language.languages(_table(spark, sf_dir, "documents"))


def op4_bpe(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark, sf_dir):
    return licenses.license_notices(_table(spark, sf_dir, "documents"))


def op6_pii(spark, sf_dir):
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality.quality_rules(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op8_html_extraction(spark, sf_dir):
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op9_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    return decontamination.digest(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op12_conversation_repair(spark, sf_dir):
    return conversations.repairs(_table(spark, sf_dir, "conversations"), defects=True)


def op13_merkle_manifest(spark, sf_dir):
    return merkle.verified(_table(spark, sf_dir, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_packing,
        op2_exact_top_k,
        op3_language_id,
        op4_bpe,
        op5_license_scan,
        op6_pii,
        op7_quality_rules,
        op8_html_extraction,
        op9_warc,
        op10_simhash_near_dedup,
        op11_decontamination,
        op12_conversation_repair,
        op13_merkle_manifest,
    )
}
