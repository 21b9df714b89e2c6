"""Hard negatives by a secondary-sort shuffle.

Blocks of anchors meet blocks of rows in tasks that score them. A pair's score
is packed into a key (anchor, descending score, kind, id); keys are partitioned
by anchor and sorted inside of partitions, so each anchor's rows arrive in
order of score. A streaming iterator opens a window for every positive and
gives negatives to the open windows; it holds a few windows, never an anchor's
rows. Blocks give only rows that can still be among the first, so a window's
list is whole while no anchor is ever listed against the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stage
from reviewlens.operators.blocks import in_blocks

POSITIVES, NEGATIVES = 5, 3
#: Hundredths of the positive's score between which a negative's score lies, both ends included.
LOW, HIGH = 50, 95
#: Keys: anchor, descending score, kind (0 same label, 1 another) and id, big-endian and unsigned, so that bytes sort as numbers do.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("other", ">u8")])
_FLIP = np.uint64(1 << 63)
#: Products up to this are exact in floating point.
_EXACT = 1 << 53


def complete(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, other: np.ndarray) -> np.ndarray:
    keys = np.empty(len(anchor), dtype=KEY)
    keys["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ _FLIP
    keys["score"] = ~(score.astype(np.int64).view(np.uint64) ^ _FLIP)
    keys["kind"] = kind
    keys["other"] = other.astype(np.int64).view(np.uint64) ^ _FLIP
    return keys


def unpacked(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Anchor, score, kind and other id of each key."""
    keys = np.frombuffer(b"".join(column.to_pylist()), dtype=KEY)
    number = lambda x: (x ^ _FLIP).view(np.int64)
    native = lambda name: keys[name].astype(np.uint64)
    return number(native("anchor")), number(~native("score")), keys["kind"], number(native("other"))


def _key_batch(keys: np.ndarray) -> pa.Table:
    # joined arrays come in the machine's order of bytes
    keys = keys.astype(KEY)
    rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return pa.table({"anchor_id": pa.array((keys["anchor"].astype(np.uint64) ^ _FLIP).view(np.int64)), "key": rows.cast(pa.binary())})


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; a shorter vector ends in zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def block_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, as exact integers."""
    most = max(np.abs(anchors).max(initial=0), np.abs(rows).max(initial=0))
    if int(most) ** 2 * anchors.shape[1] < _EXACT:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return anchors @ rows.T


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, row) of the ``k`` highest allowed scores of each line; of equal scores those of the first columns."""
    found = []
    low = np.iinfo(np.int64).min
    left = np.where(allowed, scores, low)
    lines = np.arange(len(scores))
    for _ in range(k):
        best = left.argmax(axis=1)
        there = allowed[lines, best] & (left[lines, best] > low)
        found.append((lines[there], best[there]))
        left[lines, best] = low
        if not there.any():
            break
    return tuple(np.concatenate(side) for side in zip(*found))


def keys_of_blocks(anchors: DataFrame, rows: DataFrame, work: Callable[[pa.Table, pa.Table], np.ndarray]) -> DataFrame:
    """(anchor_id, key) from ``work`` on every block of anchors with every block of rows, the latter in order of vec_id."""

    def run(some: pa.Table, others: pa.Table) -> pa.Table:
        empty = not some.num_rows or not others.num_rows
        return _key_batch(np.empty(0, dtype=KEY) if empty else work(some, others.sort_by("vec_id")))

    return in_blocks(anchors, rows, "vec_id", "vec_id", run, "anchor_id long, key binary")


def in_order(keys: DataFrame, handle: Callable[[Iterator[tuple[int, int, int, int]]], Iterator[tuple]], schema: str) -> DataFrame:
    """The secondary sort: keys partitioned by anchor and sorted inside of partitions; ``handle`` streams (anchor, score, kind, other)."""
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32()}[field.split()[1]] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(x.tolist() for x in unpacked(batch.column("key")))))
        held = []
        for row in handle(rows):
            held.append(row)
            if len(held) == 10_000:
                yield batch_of(held)
                held = []
        yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return keys.repartition("anchor_id").sortWithinPartitions("key").select("key").mapInArrow(run, schema)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of each anchor's hard negatives.

    ``rows`` has vec_id, label and an integer ``vector``; ``anchors`` is the
    condition that makes a row an anchor. Scores are inner products, higher
    ones first, ties by smaller vec_id. An anchor's positives are its first
    ``positives`` other rows of the same label; for each the first ``negatives``
    rows of another label come back that satisfy ``low * positive_score <=
    100 * negative_score <= high * positive_score``.

    Rows with a null vec_id, label, vector or component take no part. A vec_id
    that repeats is one row, the one with the smallest label, then vector. Of
    vectors of different lengths the shorter one counts as if it ended in
    zeros; an empty one scores 0. Scores are 64-bit numbers. Other columns are
    not read. ``high`` may be 100 at the most: windows open downwards.
    """
    if not low < high <= 100:
        raise ValueError("low must be less than high, and high 100 at the most")
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("vector").cast("array<long>").alias("vector"), anchors.alias("_anchor"))
    whole = plain.dropna(subset=["vec_id", "label", "vector"]).where(~F.exists("vector", lambda x: x.isNull()))
    one = whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "_anchor")).alias("_row")).select("vec_id", "_row.*")
    one = stage(one, "vectors")
    chosen = one.where("_anchor").drop("_anchor")
    width = one.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    one = one.drop("_anchor")

    def scored(some: pa.Table, others: pa.Table) -> tuple[np.ndarray, ...]:
        ids, other_ids = some["vec_id"].to_numpy(), others["vec_id"].to_numpy()
        labels = pa.chunked_array([*some["label"].chunks, *others["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        same = labels[: len(ids), None] == labels[None, len(ids) :]
        return ids, other_ids, same, block_scores(_matrix(some["vector"], width), _matrix(others["vector"], width))

    def near(some: pa.Table, others: pa.Table) -> np.ndarray:
        ids, other_ids, same, scores = scored(some, others)
        line, row = first_of(scores, same & (ids[:, None] != other_ids[None, :]), positives)
        return packed(ids[line], scores[line, row], 0, other_ids[row])

    def first_rows(keys: Iterator[tuple[int, int, int, int]]) -> Iterator[tuple]:
        current, seen = None, 0
        for anchor, score, _, other in keys:
            current, seen = anchor, seen + 1 if anchor == current else 1
            if seen <= positives:
                yield anchor, other, score

    opened = stage(in_order(keys_of_blocks(chosen, one, near), first_rows, "vec_id long, positive_id long, score long"), "positives")
    windows = opened.groupBy("vec_id").agg(F.array_sort(F.collect_set("score")).alias("windows"))

    def inside(some: pa.Table, others: pa.Table) -> np.ndarray:
        ids, other_ids, same, scores = scored(some, others)
        lists = some["windows"].combine_chunks()
        asked = _matrix(some["windows"], positives)
        there = np.arange(positives) < lists.value_lengths().to_numpy()[:, None]
        found = []
        for i in range(positives):
            p = asked[:, i : i + 1]
            fits = ~same & there[:, i : i + 1] & (low * p <= 100 * scores) & (100 * scores <= high * p)
            line, row = first_of(scores, fits, negatives)
            found.append(packed(ids[line], scores[line, row], 1, other_ids[row]))
        return np.unique(np.concatenate(found))

    def emit(keys: Iterator[tuple[int, int, int, int]]) -> Iterator[tuple]:
        current, open_windows = None, []
        for anchor, score, kind, other in keys:
            if anchor != current:
                current, open_windows = anchor, []
            if kind == 0:
                open_windows.append([other, score, 0])
                continue
            for window in open_windows:
                positive, at, given = window
                if given < negatives and low * at <= 100 * score <= high * at:
                    window[2] += 1
                    yield anchor, positive, given + 1, other, at, score

    offered = keys_of_blocks(stage(chosen.join(windows, "vec_id"), "windows"), one, inside)

    def positive_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, others, scores = (batch.column(name).to_numpy() for name in ("vec_id", "positive_id", "score"))
            yield from _key_batch(packed(ids, scores, 0, others)).to_batches()

    keys = opened.mapInArrow(positive_keys, "anchor_id long, key binary").unionByName(offered)
    return in_order(keys, emit, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
