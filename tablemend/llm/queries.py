"""One query per operator, over the whole of its table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.llm import (
    bpe,
    collocations,
    decontaminate,
    filter_audit,
    jaccard,
    language,
    line_dedup,
    pii,
    quality,
    secret_scan,
    substring_dedup,
    token_files,
    topk,
)
from tablemend.llm.common import read, stored


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by host, their lines being the block elements of the HTML, which are worked out once and written."""
    pages = stored(
        read(spark, sf_dir, "pages").select(
            "page_id",
            line_dedup.host_of(F.col("url")).alias("host"),
            line_dedup.lines_of_html(F.col("html")).alias("text"),
        )
    )
    return line_dedup.drop_boilerplate(pages, F.col("host"), "page_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(read(spark, sf_dir, "documents"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(read(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(read(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"), support=10, longest=3, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontaminate": op2_decontaminate,
    "op3_lines": op3_lines,
    "op4_topk": op4_topk,
    "op5_quality": op5_quality,
    "op6_secrets": op6_secrets,
    "op7_jaccard": op7_jaccard,
    "op8_bpe": op8_bpe,
    "op9_substrings": op9_substrings,
    "op10_language": op10_language,
    "op11_token_files": op11_token_files,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}
