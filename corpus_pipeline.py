"""From documents to tokens: five stages, each an operator of ``tablemend.llm`` over all that the stage before kept.

All stages but the last return the columns they were given, whatever further ones there are, also such as the operators
use inside. Texts of any length are taken whole; an empty table stays empty. What else holds for a stage stands with it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.llm import bpe, decontaminate, jaccard, line_dedup, quality
from tablemend.llm.common import read, stored


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking, learnt from the labels, does not reject.

    A null text is scored as an empty one. Equal texts have equal scores, and a score at the threshold is kept, so
    repeated rows stay or go together. Without labels of both sorts none is rejected.
    """
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source repeats; ``n_chars`` follows the text. None is dropped.

    A null source is a source, a null text stays null, and repeated rows are a document each.
    """
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), "doc_id")
    return cleaned.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id: five words, similarity 0.8 or more.

    Of rows with one id one stays if their texts are alike. Documents without words, null texts included, are in no group
    and stay. A null id comes after all others.
    """
    return jaccard.keep_one(docs, words=5, num=80, den=100)


def drop_contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    A null or empty text holds none; repeated rows stay or go together; an empty benchmark drops nothing.
    """
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of them and of the text that they decode to.

    Every row gives one, also repeated ones and null ids; a null text has no ids.
    """
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good_documents),
    ("lines", drop_boilerplate_lines),
    ("near_copies", keep_one_of_each_group),
    ("decontamination", drop_contaminated_documents),
    ("tokens", encode_documents),
]

#: SQL can express neither the fitted ranking nor the encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
