"""Checked joins, lookups with defaults, and response classification.

Joins are plain ones: adaptive execution splits the partitions of hot keys on
the side that repeats them, see ``session.get_session``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import clean_id
from reviewlens.operators.sampling import dedupe


def require(df: DataFrame, condition, message: str) -> DataFrame:
    """Rows unchanged; the job fails on the first row that breaks the condition.

    The check rides along with the scan, so it needs no pass of its own.
    """
    return df.filter(F.assert_true(F.coalesce(condition, F.lit(False)), F.lit(message)).isNull())


def many_to_one_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that fails when the right side repeats a key."""
    others = [name for name in right.columns if name != key]
    unique = right.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*others)).alias("_row")
    )
    unique = require(unique, F.col("_rows") == 1, f"{key} repeats on the right side")
    return left.join(unique.select(key, "_row.*"), key, "left")


def enrich_reviews(
    reviews: DataFrame, results: DataFrame, order: Sequence | None = None,
    key: str = "review_id", item: str = "app_id",
    columns: Sequence[str] = ("fetch_status", "achievements_unlocked", "total_achievements"),
) -> DataFrame:
    """Attach the latest result to each review.

    ``order`` names the columns that tell which result is the last one; without
    it a repeated key is an error, as are a review without result and a result
    that belongs to another item.
    """
    reviews = reviews.withColumns({key: clean_id(key), item: clean_id(item)})
    results = results.withColumns({key: clean_id(key), item: clean_id(item)})
    if order:
        results = dedupe(results, [key], [F.col(c) if isinstance(c, str) else c for c in order], "last")
    results = results.select(key, F.col(item).alias("_result_item"), *columns)
    joined = reviews.join(results, key, "left") if order else many_to_one_join(reviews, results, key)
    joined = require(joined, F.col("fetch_status").isNotNull(), "A review has no result")
    joined = require(
        joined, F.col("_result_item") == F.col(item), "A review and its result name different items"
    )
    return joined.drop("_result_item")


def with_visibility(users: DataFrame, states: DataFrame, user: str = "rater_id") -> DataFrame:
    """Profile state per user, the highest where the answer repeats one; users missing in it get 0."""
    known = states.groupBy(user).agg(F.max("state").alias("state"))
    return users.join(known, user, "left").withColumn("state", F.coalesce("state", F.lit(0)))


def rows_of(rows: DataFrame, selected: DataFrame, key: str = "rater_id") -> DataFrame:
    """Rows whose key was selected.

    A short selection is broadcast by its size; for a long one both sides are
    shuffled as they are, which lets adaptive execution split hot keys.
    """
    return rows.join(selected.select(key), key, "left_semi")


def pending(
    targets: DataFrame, done: DataFrame, key: str = "review_id", order: Sequence = (), ids: Sequence[str] = ()
) -> DataFrame:
    """Targets that no finished row covers yet, the first one of each key by ``order``.

    Targets without the key, or without one of ``ids``, drop out. Without
    ``order`` the smallest row of the other columns is the first.
    """
    known = targets.dropna(subset=[key, *ids])
    others = [F.col(name) for name in targets.columns if name != key]
    single = dedupe(known, [key], [F.col(c) if isinstance(c, str) else c for c in order] or others or [F.col(key)])
    return single.join(done.select(key), key, "left_anti")


def pending_pages(
    names: DataFrame, candidates: str, tried: DataFrame, successful: DataFrame, name: str = "app_name"
) -> DataFrame:
    """Candidate addresses still to fetch, one row each with its position.

    A name drops out once any of its candidates succeeded; of the others only
    the addresses not tried before remain.
    """
    pages = names.select(name, F.posexplode(candidates).alias("position", "url"))
    solved = pages.join(successful.select("url"), "url", "left_semi").select(name)
    return pages.join(solved, name, "left_anti").join(tried.select("url"), "url", "left_anti")


def with_sample_counts(items: DataFrame, counts: DataFrame, key: str = "app_id") -> DataFrame:
    """Sample sizes per item; items without sample get zeros."""
    joined = items.join(counts, key, "left")
    names = [name for name in counts.columns if name != key]
    return joined.withColumns({name: F.coalesce(name, F.lit(0)).cast("int") for name in names})


def pivot_counts(
    df: DataFrame, key: str = "app_id", rating: str = "recommended"
) -> DataFrame:
    """Rows per key and rating side, zero where a side is empty."""
    sides = df.groupBy(key).pivot(rating, [False, True]).count().na.fill(0)
    return sides.select(
        key, F.col("false").alias("sampled_negative"), F.col("true").alias("sampled_positive")
    )


def classify_responses(df: DataFrame, status: str = "http_status", body: str = "body") -> DataFrame:
    """Outcome, unlocked and total achievements of each stored service response."""
    # parsed once into a column of its own; three expressions read it
    entries = F.from_json(
        body, "playerstats struct<achievements: array<struct<achieved: int>>>"
    ).getField("playerstats").getField("achievements")
    df = df.withColumn("_entries", entries)
    outcome = (
        F.when(F.col(status) == 403, F.lit("Private_or_NotOwned"))
        .when(F.col(status) != 200, F.concat(F.lit("Error_"), F.col(status).cast("string")))
        .when(F.col(body).isNull() | F.try_parse_json(body).isNull(), F.lit("Invalid_Response"))
        .when(F.coalesce(F.size("_entries"), F.lit(0)) > 0, F.lit("Success"))
        .otherwise(F.lit("No_Stats"))
    )
    ok = F.col("fetch_status") == "Success"
    unlocked = F.size(F.filter("_entries", lambda entry: entry.getField("achieved") == 1))
    return df.withColumn("fetch_status", outcome).withColumns(
        {
            "achievements_unlocked": F.when(ok, unlocked).otherwise(0),
            "total_achievements": F.when(ok, F.size("_entries")).otherwise(0),
        }
    ).drop("_entries")
