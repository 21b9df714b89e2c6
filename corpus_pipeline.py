"""Corpus pipeline: five operators in a row over ``documents``.

run() applies the stages in order. Every stage takes (spark, docs, sf_dir),
and its result is written as Parquet and reread as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlens.llm import decontaminate, exact_dedup, minhash, quality, sentencepieces
from reviewlens.llm.common import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null texts are judged as empty ones, repeated rows alike."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays; null and empty texts are one group."""
    return exact_dedup.drop_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; texts without words are near to none."""
    return minhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``token_ids`` of their SentencePiece encoding and their number ``n_tokens``; columns of these names are replaced."""
    coded = sentencepieces.encode(docs.drop("n_tokens"))
    return coded.selectExpr("*", "size(token_ids) AS n_tokens")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", one_of_copies),
    ("near dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", tokenised),
]

#: Learned scores, edit distances and tokens are not SQL; tests/llm compares run() with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.

    An empty table gives no rows. doc_id is the key of documents; rows that
    repeat it stay or go together. Further columns are carried along, except
    token_ids and n_tokens, which the last stage writes.
    """
    docs = table(spark, sf_dir, "documents")
    for place, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
