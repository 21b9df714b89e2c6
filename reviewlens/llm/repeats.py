"""What both repeated-span operators share: marking repeated units, and cutting spans out.

A span is (low, count): the windows that start at elements low .. low + count - 1
of a document stand earlier too, so elements low .. low + count + length - 2 go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.anchors import mixed, units
from reviewlens.llm.common import arrow_map, stage, texts_of

#: Texts to element codes: (codes, first element of each text and then their number).
Coder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, version and text. Rows with one doc_id and different texts are told apart by ``version``, a hash of the text."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.select("doc_id", F.xxhash64("text").alias("version"), "text")


def _after_first(group: np.ndarray, doc: np.ndarray, version: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Whether an entry's (doc, version, low) comes after the smallest one of its group."""
    order = np.lexsort((low, version, doc, group))
    head = np.ones(len(group), dtype=bool)
    head[1:] = group[order][1:] != group[order][:-1]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    out = np.empty(len(group), dtype=bool)
    out[order] = (doc[order] != doc[first]) | (version[order] != version[first]) | (low[order] != low[first])
    return out


def marked_units(docs: DataFrame, coder: Coder, length: int, k: int) -> DataFrame:
    """(doc_id, version, low, count, slot, covered) of the units that other units call into question, as a staged table.

    covered: all windows of the unit stand earlier too. Else the unit is the
    first with its text, and some unit with another text shares its anchor's
    k-gram (``slot``), so single windows may stand elsewhere. Units repeated
    inside a batch leave it as covered runs, so a frequent text reaches the
    shuffle once per batch.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codes, bounds = coder(texts_of(batch.column("text")))
        text, low, count, gram, whole = units(codes, bounds, length, k)
        if not len(text):
            return
        doc, version = (batch.column(name).to_numpy()[text] for name in ("doc_id", "version"))
        again = _after_first(gram ^ mixed(whole), doc, version, low)
        kept = np.flatnonzero(~again)
        yield _rows(doc[kept], version[kept], low[kept], count[kept], gram[kept], whole[kept], False)
        runs = np.flatnonzero(again)
        if len(runs):
            new = np.ones(len(runs), dtype=bool)
            new[1:] = (text[runs][1:] != text[runs][:-1]) | (low[runs][1:] != (low + count)[runs][:-1])
            head = np.flatnonzero(new)
            total = np.add.reduceat(count[runs], head)
            at = runs[head]
            # a run needs no partner, so its slot only spreads it
            yield _rows(doc[at], version[at], low[at], total, mixed(gram[at] ^ mixed(doc[at].astype(np.uint64))), whole[at], True)

    found = arrow_map(rows_of(docs).where("doc_id IS NOT NULL"), work,
                      "doc_id long, version long, low int, count int, slot long, whole long, covered boolean")
    # rank gives ties one place: a row of documents that repeats in full is not its own copy
    place = F.rank().over(Window.partitionBy("slot", "whole").orderBy("doc_id", "version", "low"))
    same_slot = Window.partitionBy("slot")
    found = found.repartition("slot").withColumn("covered", F.col("covered") | (place > 1))
    several = F.min("whole").over(same_slot) != F.max("whole").over(same_slot)
    return stage(found.withColumn("several", several).where("covered OR several").drop("whole", "several"), "units")


def _rows(doc, version, low, count, gram, whole, covered: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(version, pa.int64()), pa.array(low, pa.int32()), pa.array(count, pa.int32()),
         pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.full(len(doc), covered))],
        names=["doc_id", "version", "low", "count", "slot", "whole", "covered"])


def with_spans(docs: DataFrame, spans: DataFrame, how: str, *more: str) -> DataFrame:
    """doc_id, version, text and ``spans``, the document's (low, count, ...) entries; a document has no more of them than elements."""
    lists = spans.groupBy("doc_id", "version").agg(F.collect_list(F.struct("low", "count", *more)).alias("spans"))
    return rows_of(docs).join(lists, ["doc_id", "version"], how)


def span_arrays(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """For entries of all rows: the row, and each field."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), {f.name: flat.field(f.name).to_numpy() for f in flat.type}


def removed_elements(n: int, low: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Mask of the elements of a document that its spans cover."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, low, 1)
    np.subtract.at(change, np.minimum(low + count + length - 1, n), 1)
    return np.cumsum(change[:-1]) > 0
