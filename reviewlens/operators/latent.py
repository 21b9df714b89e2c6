"""Latent axes of vectors: what texts share without sharing a word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.operators.blocks import vector_sum
from reviewlens.session import materialize

LATENT_SIZE, LATENT_ROUNDS = 64, 8
#: Vectors that are worked on at once.
ROWS = 1024


def start_axes(size: int, latent: int) -> np.ndarray:
    """Axes that the iteration starts from: any fixed numbers without a pattern that texts could have."""
    line, column = np.arange(size)[:, None], np.arange(latent)[None, :]
    return (line * 7919 + column * 104729 + line * line * 31 * (column + 1)) % 1009 / 1009 - 0.5


def gram_schmidt(columns: np.ndarray) -> np.ndarray:
    """Columns of length one at right angles; one that is made up of those before it becomes zero."""
    out = np.zeros_like(columns)
    for c in range(columns.shape[1]):
        rest = columns[:, c].copy()
        whole = np.sqrt(rest @ rest)
        for before in range(c):
            rest -= (rest @ out[:, before]) * out[:, before]
        length = np.sqrt(rest @ rest)
        if length > 1e-9 * whole and length > 0:
            out[:, c] = rest / length
    return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def latent_axes(rows: DataFrame, vector: str, latent: int = LATENT_SIZE, rounds: int = LATENT_ROUNDS) -> np.ndarray:
    """The first ``latent`` axes of the vectors by block power iteration, one per column.

    Every round is one pass: a task multiplies its rows with the axes and adds
    up one matrix, whatever the number of rows. The sums and the axes, as many
    numbers as a vector is long times ``latent``, are what visits the driver.
    """
    vectors = materialize(rows.select(F.col(vector).alias("_v")).filter("_v IS NOT NULL AND size(_v) > 0"))
    first = vectors.select(F.size("_v")).first()
    size = first[0] if first else 0
    axes = gram_schmidt(start_axes(size, min(latent, size)))
    for _ in range(rounds if size else 0):
        def work(batches: Iterator[pa.RecordBatch], axes=axes) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(axes)
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS):
                    x = _matrix(batch.column("_v").slice(i, ROWS), size)
                    total += x.T @ (x @ axes)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["line", "entries"])

        sums = vectors.mapInArrow(work, "line int, entries array<double>").groupBy("line").agg(vector_sum("entries").alias("entries"))
        axes = gram_schmidt(np.array([row["entries"] for row in sums.orderBy("line").collect()]))
    return axes


def in_latent_space(df: DataFrame, vector: str, axes: np.ndarray) -> DataFrame:
    """The vectors seen along the axes, scaled to length one; one without a part along any axis is all zeros, a null one stays null."""
    width = axes.shape[1]

    # only the vectors visit Python; texts and other columns beside them stay in the JVM
    @F.arrow_udf("array<float>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([seen(batch.slice(i, ROWS)) for i in range(0, len(batch), ROWS)] or [seen(batch)])

    def seen(lists: pa.Array) -> pa.Array:
        there = lists.is_valid().to_numpy(zero_copy_only=False)
        places = _matrix(lists, len(axes)) @ axes if there.any() else np.zeros((0, width))
        length = np.sqrt(np.square(places).sum(axis=1, keepdims=True))
        places = np.divide(places, length, out=np.zeros_like(places), where=length > 1e-12)
        found = iter(places.astype(np.float32).tolist())
        return pa.array([next(found) if t else None for t in there.tolist()], pa.list_(pa.float32()))

    return df.withColumn(vector, place(F.col(vector).cast("array<float>")))
