"""Principal axes of every group at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.functions.vectors import as_vector, dot
from reviewlens.operators.blocks import per_block, point_blocks, points_of, vector_sum
from reviewlens.session import materialize

#: Share of a group's variance below which an axis has none.
NOTHING = 1e-12


def directed(axes: np.ndarray, variances: np.ndarray, n: int) -> list[list[float]]:
    """The first ``n`` axes, the largest loading of each made positive; one without variance is zero."""
    out = np.zeros((n, axes.shape[1]))
    for i, (axis, variance) in enumerate(zip(axes[:n], variances[:n])):
        if variance > NOTHING * max(variances.sum(), 1e-300) and variance > 0:
            out[i] = axis * (1 if axis[np.abs(axis).argmax()] >= 0 else -1)
    return out.tolist()


def axes_of_points(x: np.ndarray, n: int) -> tuple[list[float], list[list[float]]]:
    """Mean and axes of points that lie in one task."""
    mean = x.mean(axis=0)
    _, size, axes = np.linalg.svd(x - mean, full_matrices=False)
    # rounding of the values themselves is no spread
    size[size < 1e-12 * np.abs(x).max(initial=0) * np.sqrt(len(x))] = 0
    return mean.tolist(), directed(axes, size**2, n)


def principal_axes(points: DataFrame, by: Sequence[str], key: str, vector: str, n: int = 2) -> DataFrame:
    """(``by``…, mean, axes): mean and first ``n`` principal axes of each group's vectors.

    A group that is one block is solved in its task. Of a larger one every
    block gives the rows of its scatter matrix, which Spark adds up, so what
    meets in a task is one square matrix per group.
    """
    by = list(by)
    blocks = materialize(point_blocks(points, by, key, vector))
    small = per_block(blocks.filter("_blocks = 1"), by, lambda row: [axes_of_points(points_of(row), n)], mean="array<double>", axes="array<array<double>>")
    large = blocks.filter("_blocks > 1")
    sums = per_block(large, by, lambda row: [(len(row["_hashes"]), points_of(row).sum(axis=0).tolist())], n="long", total="array<double>")
    means = sums.groupBy(*by).agg(vector_sum("total").alias("total"), F.sum("n").alias("n"))
    means = means.select(*by, F.transform("total", lambda x: x / F.col("n")).alias("mean"))

    def scatter(row: dict) -> list[tuple]:
        x = points_of(row) - np.array(row["mean"])
        return list(enumerate((x.T @ x).tolist()))

    rows = per_block(large.join(means, by), by, scatter, line="int", entries="array<double>")
    rows = rows.groupBy(*by, "line").agg(vector_sum("entries").alias("entries")).join(means, by)
    kinds = dict(points.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), "mean array<double>, axes array<array<double>>"])

    def solve(lines: pa.Table) -> pa.Table:
        matrix = np.array(lines.sort_by("line")["entries"].to_pylist())
        variances, axes = np.linalg.eigh(matrix)
        found = directed(axes.T[::-1], np.maximum(variances[::-1], 0), n)
        group = {c: lines[c].slice(0, 1) for c in [*by, "mean"]}
        return pa.table(group | {"axes": pa.array([found], pa.list_(pa.list_(pa.float64())))})

    return small.unionByName(rows.groupBy(*by).applyInArrow(solve, schema))


def pca_2d(
    df: DataFrame, key: str, vector: str = "embedding", carry: Sequence[str] = (), by: Sequence[str] = (),
) -> DataFrame:
    """Centred vectors on the first two principal axes of their group, as ``pc1`` and ``pc2``.

    Without ``by`` all rows are one group. The largest loading of each axis is
    positive. A group without spread, such as a single row, lies at (0, 0).
    Rows with a null vector or group are left out; the vectors of a group have
    one length.
    """
    groups = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    chosen = list(dict.fromkeys([*groups, key, *carry]))
    points = materialize(rows.select(*chosen, as_vector(vector).alias("_x")).dropna(subset=[*groups, "_x"]))
    axes = principal_axes(points, groups, key, "_x").select(*groups, F.col("mean").alias("_mean"), F.col("axes").alias("_axes"))
    centred = F.zip_with("_x", "_mean", lambda x, m: x - m)
    places = [dot(centred, F.col("_axes")[i]).alias(f"pc{i + 1}") for i in range(2)]
    return points.join(axes, groups).select(*[c for c in chosen if c != "_all"], *places)
