"""Counts, shares and quality figures per item and per stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import boolean
from reviewlens.operators.joins import pivot_counts, with_sample_counts


def consensus(df: DataFrame, min_reviews: int = K.MIN_ITEM_REVIEWS) -> DataFrame:
    """Share of positive ratings per item, for items with enough ratings, best first."""
    liked = boolean(df, "recommended").cast("int")
    return (
        df.dropna(subset=["app_id", "app_name"])
        .groupBy("app_id", "app_name")
        .agg(F.count("review_id").alias("total_reviews"), F.coalesce(F.sum(liked), F.lit(0)).alias("total_positive"))
        .filter(F.col("total_reviews") >= min_reviews)
        .withColumn("steam_consensus", F.col("total_positive") / F.col("total_reviews"))
        .orderBy(F.desc("steam_consensus"), "app_id")
    )


def sorted_baseline(df: DataFrame, min_reviews: int = K.MIN_ITEM_REVIEWS) -> DataFrame:
    """The consensus table in the order of the item names, unnamed ones last."""
    return consensus(df, min_reviews).orderBy(F.col("app_name").asc_nulls_last(), "app_id")


def name_counts(df: DataFrame, order: str = "review_id") -> DataFrame:
    """Ratings per item and name. Plain counters, so Spark can aggregate by hashing."""
    return (
        df.withColumn("_liked", boolean(df, "recommended", "basic").cast("int"))
        .dropna(subset=["app_id", "_liked"])
        .groupBy("app_id", "app_name")
        .agg(
            F.count(F.lit(1)).alias("_ratings"), F.sum("_liked").alias("_liked"),
            F.min(order).alias("_first"),
        )
    )


def merge_names(counts: DataFrame) -> DataFrame:
    """Item table from counts per name; an item takes its first known name, else its id."""
    named = F.when(F.col("app_name").isNotNull(), F.col("_first"))
    return (
        counts.groupBy("app_id")
        .agg(
            F.min_by("app_name", named).alias("app_name"),
            F.sum("_ratings").alias("review_count"),
            F.sum("_liked").alias("positive_reviews"),
        )
        .withColumn("app_name", F.coalesce("app_name", F.col("app_id").cast("string")))
        .withColumn("negative_reviews", F.col("review_count") - F.col("positive_reviews"))
        .withColumn("recommendation_rate", F.lit(100.0) * F.col("positive_reviews") / F.col("review_count"))
    )


def item_counts(df: DataFrame, order: str = "review_id") -> DataFrame:
    """Ratings per item and the first known name; every rated row counts."""
    return merge_names(name_counts(df, order))


def item_profiles(counts: DataFrame, sample: DataFrame) -> DataFrame:
    """Item table with sample sizes, largest items first."""
    sized = with_sample_counts(counts, pivot_counts(sample))
    return sized.orderBy(F.desc("review_count"), "app_name", "app_id")


def run_manifest(
    items: DataFrame, clusters: DataFrame, seed: int = K.SEED, model: str = K.MODEL_NAME, source: str | None = None
) -> DataFrame:
    """One-row summary of a profile build, with the names of the text model and of the source."""
    themes = clusters.agg(F.count(F.lit(1)).alias("n")).scalar()
    return items.agg(
        F.count(F.lit(1)).alias("games"),
        F.sum(F.col("sampled_positive") + F.col("sampled_negative")).alias("review_sample_size"),
    ).select(
        F.lit(source).cast("string").alias("source"), F.lit(model).alias("model"), "games",
        themes.alias("clusters"), "review_sample_size", F.lit(seed).alias("random_seed"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, null included, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col(column).asc_nulls_last())


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent known value; the smallest one on ties."""
    known = df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return known.orderBy(F.desc("n"), column).limit(1)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and surplus rows, among rows with a key."""
    counts = df.agg(F.count(key).alias("rows"), F.count_distinct(key).alias("distinct_keys"))
    return counts.withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def stage_report(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each filter, counted in one pass.

    Stage names come with their conditions; each stage keeps what passed all
    stages before it.
    """
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_0")]
    for i, (_, condition) in enumerate(stages, start=1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"_{i}"))
    names = ["all rows"] + [name for name, _ in stages]
    entries = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"_{i}").alias("rows"),
            (F.col(f"_{max(i - 1, 0)}") - F.col(f"_{i}")).alias("dropped"),
            (F.try_divide(F.col(f"_{i}"), F.col("_0")) * 100).alias("pct_kept"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*counts).select(F.explode(F.array(*entries)).alias("row")).select("row.*")


def outlier_share(df: DataFrame, threshold: float = K.OUTLIER_DELTA) -> DataFrame:
    """Items whose delta is beyond the threshold, as count and percent of all."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.abs("delta") > threshold).alias("outliers")
    )
    return counts.withColumn("outlier_pct", F.try_divide(F.col("outliers"), F.col("total")) * 100)
