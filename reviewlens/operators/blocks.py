"""Work on blocks of rows: two tables scored against each other, and the points of groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

#: Rows of either side in a block; a task holds one block of each.
BLOCK = 2048
#: Points of a group in a block.
POINTS = 16_384
#: Tasks asked for at the most; with more pairs of blocks a task works on several, one after the other.
MOST_TASKS = 100_000


def in_blocks(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``work`` on every block of ``left`` with every block of ``right``, both as Arrow tables.

    Rows with one key stay in one block. Every pair of blocks is a group of its
    own, so neither side is ever whole in a task; ``work`` gives what can still
    be wanted, such as the best few rows of each line, never the pairs. Both
    sides are counted and copied, so pass written tables.
    """
    down, across = (max(1, -(-side.count() // BLOCK)) for side in (left, right))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lines = left.withColumn("_down", block(left_key, down)).withColumn("_across", copies(across))
    columns = right.withColumn("_across", block(right_key, across)).withColumn("_down", copies(down))
    # sides of one origin need columns of their own
    columns = columns.select(*[F.col(c).alias(c) for c in columns.columns])
    keys = ["_down", "_across"]
    # the work counts, not the bytes: a number of partitions that is asked for is not reduced
    tasks = min(down * across, MOST_TASKS)
    grouped = [side.repartition(tasks, *keys).groupBy(*keys) for side in (lines, columns)]

    def run(some: pa.Table, others: pa.Table) -> pa.Table:
        return work(some.drop(keys), others.drop(keys))

    return grouped[0].cogroup(grouped[1]).applyInArrow(run, schema)


def point_blocks(points: DataFrame, by: Sequence[str], key: str, vector: str, hashed: Column | None = None) -> DataFrame:
    """Row per block of a group's points: the group, its number of blocks, and the block's keys, hashes and vectors in order of keys.

    A group of any size becomes blocks of about POINTS points, so its vectors
    are never whole in one task.
    """
    sizes = points.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / POINTS).cast("int").alias("_blocks"))
    chosen = points.select(*by, key, F.col(vector).alias("_x"), (F.lit(0) if hashed is None else hashed).cast("long").alias("_hash"))
    placed = chosen.join(sizes, list(by)).withColumn("_block", F.pmod(F.xxhash64(key), "_blocks").cast("int"))
    kinds = dict(points.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), f"_blocks int, _keys array<{kinds[key]}>, _hashes array<long>, _x binary"])

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(key)
        flat = rows["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        entry = lambda name: pa.array([rows[name].to_pylist()], pa.list_(rows.schema.field(name).type))
        group = {c: rows[c].slice(0, 1) for c in [*by, "_blocks"]}
        return pa.table(group | {"_keys": entry(key), "_hashes": entry("_hash"), "_x": pa.array([flat.astype(np.float64).tobytes()], pa.binary())})

    return placed.groupBy(*by, "_block").applyInArrow(pack, schema)


def points_of(row: dict) -> np.ndarray:
    """Vectors of a block, one per line."""
    return np.frombuffer(row["_x"], dtype=np.float64).reshape(len(row["_hashes"]), -1)


def per_block(blocks: DataFrame, by: Sequence[str], work: Callable[[dict], list[tuple]], **fields: str) -> DataFrame:
    """Rows that ``work`` makes of each block, behind the group's columns; the keys stay where they are."""
    kinds = dict(blocks.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), *(f"{name} {kind}" for name, kind in fields.items())])
    used = [c for c in blocks.columns if c not in (*by, "_keys")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in single_rows(batches):
            rows = work(one.select(used).to_pylist()[0])
            group = pa.array(np.zeros(len(rows), dtype=np.int64))
            made = [pa.array([r[i] for r in rows], _KINDS[kind]) for i, kind in enumerate(fields.values())]
            yield pa.RecordBatch.from_arrays([*(one.column(c).take(group) for c in by), *made], names=[*by, *fields])

    return blocks.mapInArrow(run, schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()),
          "array<array<double>>": pa.list_(pa.list_(pa.float64()))}


def single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows))


def vector_sum(vector: str) -> Column:
    """Sum of vectors, element by element, added up in the JVM before the shuffle."""
    return vector_to_array(Summarizer.sum(array_to_vector(F.col(vector))))
