"""Substring dedup on words by de Bruijn compaction.

An edge of the graph is a window of WINDOW words; it leads from the window's
first WINDOW - 1 words to its last ones. Edges that occur more than once stay;
through nodes with one edge in and one out, edges are joined into paths by
pointer doubling. Every occurrence of an edge has source coordinates; placed
on its path they give the repeated spans, and all but the first occurrence go.

Windows enter the graph only where they can repeat: units of windows (see
``anchors``) that occur once leave before, units that repeat as a whole are
paths already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.anchors import SpanHash
from reviewlens.llm.common import arrow_map, stage, texts_of
from reviewlens.llm.repeats import marked_units, removed_elements, span_arrays, with_spans
from reviewlens.llm.words import words_of

#: Words of a window, and of the anchors inside it.
WINDOW, ANCHOR = 20, 6


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts)
    return words.codes, words.bounds


def edges(docs: DataFrame, open_units: DataFrame) -> DataFrame:
    """(doc_id, version, place, edge, proof, tail, head) of every window of the open units; proof is a second hash of the window."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = words_of(texts_of(batch.column("text")))
        bounds = words.bounds
        row, spans = span_arrays(batch.column("spans"))
        count = spans["count"].astype(np.int64)
        place = np.repeat(spans["low"] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        row = np.repeat(row, count)
        at = bounds[row] + place
        first, second = SpanHash(words.codes), SpanHash(words.proofs)
        columns = [first(at, at + WINDOW), second(at, at + WINDOW), first(at, at + WINDOW - 1), first(at + 1, at + WINDOW)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), batch.column("version").take(pa.array(row)), pa.array(place, pa.int32()), *(pa.array(c.view(np.int64)) for c in columns)],
            names=["doc_id", "version", "place", "edge", "proof", "tail", "head"])

    rows = with_spans(docs, open_units, "inner")
    return arrow_map(rows, work, "doc_id long, version long, place int, edge long, proof long, tail long, head long")


def compacted(repeated: DataFrame) -> DataFrame:
    """(edge, proof, path, step): each edge's path, named by its first edge, and its place on it.

    An edge's predecessor is the one edge into its tail, if the tail has one
    edge in and one out. Doubling the pointers reaches every path's first edge
    in as many rounds as its length has binary digits; a circle without a
    first edge keeps the pointers it has and falls into single edges.
    """
    into = repeated.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("edge").alias("before"))
    out = repeated.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("n_out"), F.min("edge").alias("edge"))
    plain = into.where("n_in = 1").join(out.where("n_out = 1"), "node").where("before != edge").select("edge", "before")
    state = repeated.join(plain, "edge", "left").select(
        "edge", "proof", F.coalesce("before", "edge").alias("path"),
        F.when(F.col("before").isNotNull(), 1).otherwise(0).alias("step"))
    state, reach = stage(state, "paths"), 1
    longest = repeated.count()
    while reach < longest:
        far = state.select(F.col("edge").alias("path"), F.col("path").alias("farther"), F.col("step").alias("more"))
        moved = stage(state.join(far, "path").select(
            "edge", "proof", F.col("farther").alias("path"), (F.col("step") + F.col("more")).alias("step")), "paths")
        if not moved.join(far.where("more > 0").select("path"), "path", "left_semi").limit(1).count():
            state = moved
            break
        state, reach = moved, reach * 2
    circles = state.where("step > 0").join(
        state.where("step > 0").select(F.col("edge").alias("path")), "path", "left_semi").select("edge").distinct()
    on_circle = circles.withColumn("alone", F.lit(True))
    return state.join(on_circle, "edge", "left").select(
        "edge", "proof", F.when(F.col("alone"), F.col("edge")).otherwise(F.col("path")).alias("path"),
        F.when(F.col("alone"), 0).otherwise(F.col("step")).alias("step"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, version, low, count): runs of windows that stand earlier too."""
    units = marked_units(docs, _coded, WINDOW, ANCHOR)
    found = stage(edges(docs, units.where("NOT covered")), "edges")
    # an edge is a window's words: both hashes must agree
    repeated = stage(
        found.groupBy("edge", "proof").agg(F.min("tail").alias("tail"), F.min("head").alias("head"), F.count(F.lit(1)).alias("n"),
                                           F.min(F.struct("doc_id", "version", "place")).alias("first")).where("n > 1"), "repeated")
    paths = compacted(repeated.select("edge", "proof", "tail", "head"))
    placed = paths.join(repeated.select("edge", "proof", "first"), ["edge", "proof"])
    # source coordinates: an occurrence counts from its path's start; what does not stand there first, goes
    later = found.join(placed, ["edge", "proof"]).where(F.struct("doc_id", "version", "place") > F.col("first"))
    runs = later.groupBy("doc_id", "version", "path", (F.col("place") - F.col("step")).alias("origin")).agg(
        F.array_sort(F.collect_list("place")).alias("places"))
    # a run breaks where the path's first occurrence changes sides
    starts = F.filter("places", lambda p: ~F.array_contains("places", p - 1))
    ends = F.filter("places", lambda p: ~F.array_contains("places", p + 1))
    spans = runs.select("doc_id", "version", F.explode(F.arrays_zip(starts.alias("low"), ends.alias("last"))).alias("s")).select(
        "doc_id", "version", F.col("s.low").alias("low"), (F.col("s.last") - F.col("s.low") + 1).alias("count"))
    return stage(units.where("covered").select("doc_id", "version", "low", "count").unionByName(spans), "spans")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``, the words that stay joined by one space."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, found = span_arrays(batch.column("spans"))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(texts_of(batch.column("text"))):
            words = text.split()
            n_words.append(len(words))
            part = slice(ends[i], ends[i + 1])
            if ends[i] < ends[i + 1]:
                gone = removed_elements(len(words), found["low"][part], found["count"][part], WINDOW)
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return arrow_map(with_spans(docs, spans, "left"), work, "doc_id long, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept text for each row.

    Every word is removed that a window of 20 consecutive words covers which
    also starts earlier: in a document with a smaller doc_id, or earlier in the
    same one. Windows are judged on the input. Words are runs of bytes other
    than ``[\\x20\\x09-\\x0D]``; a null text has none. Rows that
    repeat in full are one document; of rows that share a doc_id and differ in
    text, each is a document of its own, ordered by a hash of the text. Rows
    without doc_id lose nothing and are no one's source. Other columns are not read.
    """
    return cut(docs, repeated_spans(docs))


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


