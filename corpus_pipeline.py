"""Training-corpus pipeline over ``documents``: five stages, each one operator of ``llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of documents, the last one the digests of the token ids.

Defined for every stage: no rows give no rows; extra columns of documents pass through, whatever their names; very
long texts are worked on whole; what a stage does with nulls and repeated rows stands with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import decontaminate, nearjoin, pii, quality, tokenize
from llm.queries import BPE_RANKS, table
from tablewatch.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject.

    Null and empty texts score the share of good labels, as all documents do where a kind has fewer than
    four labelled documents; repeated rows and those without an id are judged by their text alone.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies.

    Null and empty texts are copies of nothing and stay; rows of one id stay or go together; rows without an id stay.
    """
    return nearjoin.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; rows of one id stay or go together; rows without an id stay.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars follows the text.

    Null texts stay null; every row stays, repeated ones and those without an id too.
    """
    return pii.redact(docs, pii.fit(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each text's token ids and of the bytes decoded from them.

    Null and empty texts have no ids; every row gives one.
    """
    return tokenize.op8(docs, BPE_RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", bpe_stage),
]

#: A trained classifier decides in the first stage, so SQL cannot give the rows; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage kept is written once before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
