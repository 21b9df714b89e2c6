"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows written once as Parquet below ``spark.checkpoint.dir``.

    Later jobs start from the table, so a lost executor costs no replay.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = {k: spark.conf.get(k, None) for k in _CLEANUP}
    for k in _CLEANUP:
        spark.conf.set(k, "true")
    try:
        df.write.parquet(path)
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    return spark.read.schema(df.schema).parquet(path)


#: Once a stage is written nothing reads its shuffle files again; with these settings they go when the write ends.
_CLEANUP = ("spark.sql.shuffleDependency.fileCleanup.enabled", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


#: Bits of the filter in ``thinned``; its table has at most a 64th as many rows, two megabytes.
FILTER_BITS = 1 << 23


def thinned(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be in the column ``key`` of ``ids``: all that are, and few others.

    A bit filter of fixed size is broadcast, so long texts that an exact join
    would leave out need not be shuffled. With very many ids it lets more rows
    through, never fewer.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    words = ids.select(bit.alias("_bit")).selectExpr("_bit div 64 AS _word", "shiftleft(1L, CAST(_bit % 64 AS INT)) AS _mask")
    words = words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    placed = rows.withColumn("_bit", bit).withColumn("_word", F.expr("_bit div 64"))
    found = placed.join(F.broadcast(words), "_word").where("shiftright(_mask, CAST(_bit % 64 AS INT)) & 1 = 1")
    return found.select(*rows.columns)


def of_ids(rows: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """The rows whose ``key`` is (``left_semi``) or is not (``left_anti``) in the one column of ``ids``; null equals null.

    All columns of the rows stay as they are, whatever their names.
    """
    # names that no column begins with, so that a struct column is never meant
    left, right = [x for x in (f"side{i}" for i in range(len(rows.columns) + 2)) if x not in rows.columns][:2]
    found = ids.distinct().toDF("key").alias(right)
    return rows.alias(left).join(found, F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.key")), how)


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on slices of at most ``SLICE_BYTES`` of Arrow data, so that long texts never pile up in one call."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from work(part)

    return df.mapInArrow(run, schema)


#: Arrow bytes handed to one call of an operator's work; a single longer row is a slice of its own.
SLICE_BYTES = 2_000_000


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    if batch.nbytes <= most or batch.num_rows < 2:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
