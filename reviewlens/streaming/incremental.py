"""Running counts, mergeable samples and resumable collection as streams.

Running results are upserted into buckets: a batch rewrites the buckets its
rows fall into and leaves all other files alone. Every bucket has two slots;
a batch writes the one that does not hold the bucket's state before it, so a
batch that is retried after a failure starts from the same state again.
Resumable collection keeps finished ids in Spark's state store, and each batch
only adds what it has found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from reviewlens import constants as K
from reviewlens.operators.consensus import merge_names, name_counts
from reviewlens.operators.joins import classify_responses
from reviewlens.operators.sampling import dedupe_sample, hash_sample, sample_rows, top_k_per_group


def open_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a file or folder as a stream, with the schema of what is there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a pattern lets the same call take single files and folders
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _run(stream: DataFrame, handle: Callable, target: str, mode: str = "append") -> None:
    """Process everything that is available, then stop; a later call goes on from there."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Buckets of a running result; one of very many rows takes more of them, from its first batch on.
BUCKETS = 64


def _states(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All rows below a target, with batch, bucket and slot."""
    extra = [StructField("_batch", LongType()), StructField("_bucket", IntegerType()), StructField("_slot", IntegerType())]
    return spark.read.schema(StructType([*schema.fields, *extra])).parquet(target)


def _newest(states: DataFrame) -> DataFrame:
    """Of every bucket the rows of its newest slot."""
    newest = states.groupBy("_bucket").agg(F.max("_batch").alias("_batch"))
    return states.join(F.broadcast(newest), ["_bucket", "_batch"])


def upsert(
    changed: DataFrame, target: str, number: int, keys: Sequence[str], buckets: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Write ``merge(state rows, changed rows)`` of the buckets that hold a changed row.

    Only these buckets are read and written; their numbers are all that visits
    the driver.
    """
    spark = changed.sparkSession
    rows = changed.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    rows.persist()
    try:
        touched = [row[0] for row in rows.select("_bucket").distinct().collect()]
        merged, slot = rows, F.lit(0)
        if number > 0 and touched:
            states = _states(spark, target, changed.schema)
            old = _newest(states.filter(F.col("_bucket").isin(*touched) & (F.col("_batch") < number)))
            used = [row[0] for row in old.filter("_slot = 0").select("_bucket").distinct().collect()]
            slot = F.col("_bucket").isin(*used).cast("int") if used else slot
            merged = merge(old.drop("_batch", "_slot"), rows)
        out = merged.withColumns({"_batch": F.lit(number).cast("long"), "_slot": slot})
        # a slot that is written again takes the place of what an earlier try left there
        out.repartition(max(1, len(touched)), "_bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_slot").parquet(target)
    finally:
        rows.unpersist()


def latest_state(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """A running result after its last batch."""
    return _newest(_states(spark, target, schema)).select(*schema.fieldNames())


def stream_item_counts(reviews: DataFrame, target: str, order: str = "review_id", buckets: int = BUCKETS) -> DataFrame:
    """Counts per item; the streaming state holds one row per item and name.

    A batch gives the new totals of the names it met, which replace the old ones.
    """
    keys = ["app_id", "app_name"]

    def replaced(old: DataFrame, fresh: DataFrame) -> DataFrame:
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
        rest = old.alias("o").join(fresh.select(*keys).alias("f"), same[0] & same[1], "left_anti")
        return rest.unionByName(fresh)

    def handle(batch: DataFrame, number: int) -> None:
        upsert(batch, target, number, ["app_id"], buckets, replaced)

    counts = name_counts(reviews, order)
    _run(counts, handle, target, "update")
    return merge_names(latest_state(reviews.sparkSession, target, counts.schema))


def stream_hash_sample(
    reviews: DataFrame, target: str, k: int = K.SAMPLE_PER_SENTIMENT, dedupe_rows: bool = True, buckets: int = BUCKETS, **options
) -> DataFrame:
    """The same sample as ``profile_sample`` of all rows, kept up to date batch by batch.

    Every (item, rating) keeps its ``k`` lowest priorities and no more. Those
    of old sample and new batch together are the lowest overall, so any split
    into batches gives the same rows; groups that a batch does not raise stay
    where they are.
    """
    keys = ["app_id", "recommended"]

    def lowest(old: DataFrame, fresh: DataFrame) -> DataFrame:
        return top_k_per_group(old.unionByName(fresh), ["_bucket", *keys], [F.col("_priority"), F.col("review")], k)

    def fresh(rows: DataFrame) -> DataFrame:
        return hash_sample(sample_rows(rows), k=k, **options)

    _run(reviews, lambda batch, number: upsert(fresh(batch), target, number, keys, buckets, lowest), target)
    sample = latest_state(reviews.sparkSession, target, fresh(reviews).schema)
    return dedupe_sample(sample) if dedupe_rows else sample


def stream_resume(
    responses: DataFrame, target: str, order: Sequence[Column], key: str = "review_id", leave_out: Sequence[str] = ()
) -> DataFrame:
    """Classify new responses only; ids finished in earlier batches are skipped.

    Finished ids are the keys of the stream's state: an id keeps the batch it
    was first met in and the last of its rows there by ``order``; later rows
    change nothing. A batch writes the ids that are new in it and reads nothing
    that earlier ones have written. ``leave_out`` names columns that neither
    state nor results need, such as the answer's body.
    """
    # the time of a batch, the same for all of its rows and when it is tried again
    now = F.unix_micros(F.current_timestamp())
    typed = classify_responses(responses.select("*", F.struct(*order).alias("_order"))).drop(*leave_out)
    columns = [c for c in typed.columns if c not in (key, "_order")]
    dated = typed.withColumn("_earlier", -now)
    chosen = dated.groupBy(key).agg(F.max(F.struct("_earlier", "_order", *columns)).alias("_row"))
    # of the ids that a batch has touched those it has met for the first time
    fresh = chosen.filter(F.col("_row._earlier") == -now).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/version={number}")

    _run(fresh, handle, target, "update")
    results = responses.sparkSession.read.schema(fresh.schema).parquet(target)
    return results.select(*[c for c in typed.columns if c != "_order"])
