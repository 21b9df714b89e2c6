"""Training rows of the learned operators: a bounded, repeatable sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def training_rows(docs: DataFrame, labels: DataFrame, target: str, parts: int, held_out: int, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents outside the held-out fold.

    The sample takes the ids that come first by hash, the same ones at every
    partitioning. Only its ids, bounded by ``limit``, are broadcast. Labels that
    are null, repeat an id or belong to no document are left out.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), parts) != held_out))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
