"""Completion study: rows, bands and theme grids."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import (
    clean_id, clean_text, completion_pct, has_words, mentions, minutes_to_hours, numeric, rating_value,
)
from reviewlens.operators.sampling import cap_per_group, dedupe
from reviewlens.sources.tables import require_columns


def completion_stages() -> list[tuple[str, Column]]:
    """The filters of ``completion_rows`` by name, for a stage report."""
    return [
        ("has ids", F.col("review_id").isNotNull() & F.col("app_id").isNotNull()),
        ("fetched", F.col("fetch_status") == "Success"),
        ("has numbers", F.col("achievements_unlocked").isNotNull() & F.col("total_achievements").isNotNull()),
        ("has achievements", F.col("total_achievements") > 0),
    ]


def completion_rows(df: DataFrame, order: Sequence[Column], cap: int = K.REVIEWS_PER_ITEM) -> DataFrame:
    """One clean row per successfully fetched review with its completion in percent."""
    require_columns(
        df,
        ["review_id", "app_id", "review", "recommended", "fetch_status",
         "achievements_unlocked", "total_achievements"],
        "Enriched reviews",
    )
    rows = df.withColumns({"review_id": clean_id("review_id"), "app_id": clean_id("app_id")})
    rows = dedupe(rows.dropna(subset=["review_id", "app_id"]), ["review_id"], order)
    rows = rows.filter(F.col("fetch_status") == "Success").withColumns(
        {name: numeric(rows, name) for name in ("achievements_unlocked", "total_achievements")}
    )
    rows = rows.filter(F.col("achievements_unlocked").isNotNull() & (F.col("total_achievements") > 0))
    rows = rows.withColumn(
        "completion_percentage", completion_pct("achievements_unlocked", "total_achievements")
    )
    return cap_per_group(rows, ["app_id"], "review_id", cap)


def rated_rows(df: DataFrame) -> DataFrame:
    """Rows with a completion in range, rating as 1, 0 or null in ``rating``."""
    require_columns(
        df, ["app_id", "review", "recommended", "completion_percentage"], "Completion rows"
    )
    rows = df.withColumn("completion_percentage", numeric(df, "completion_percentage"))
    return rows.filter(F.col("completion_percentage").between(0, 100)).withColumn(
        "rating", rating_value("recommended")
    )


def rate_by_band(df: DataFrame, width: int = 10) -> DataFrame:
    """Recommendation rate per completion band with a normal 95 % interval."""
    band = F.greatest(F.ceil(F.col("completion_percentage") / width) - 1, F.lit(0)).cast("int")
    sums = df.dropna(subset=["rating"]).groupBy(band.alias("band")).agg(
        F.avg("rating").alias("mean"), F.count("rating").alias("n")
    )
    bands = df.sparkSession.range(0, 100 // width, 1, 1).select(F.col("id").cast("int").alias("band"))
    rate = F.col("mean") * 100
    error = F.sqrt(F.col("mean") * (1 - F.col("mean")) / F.greatest("n", F.lit(1))) * 100
    return (
        bands.join(sums, "band", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .select(
            "band", F.concat(F.col("band") * width, F.lit("–"), (F.col("band") + 1) * width, F.lit("%")).alias("label"),
            "n", rate.alias("rate"), error.alias("se"),
            (rate - 1.96 * error).alias("low"), (rate + 1.96 * error).alias("high"),
        )
        .orderBy("band")
    )


def completion_group() -> Column:
    low, middle, high = K.COMPLETION_GROUPS
    return (
        F.when(F.col("completion_percentage") <= K.LOW_COMPLETION, low)
        .when(F.col("completion_percentage") >= K.HIGH_COMPLETION, high)
        .otherwise(middle)
    )


def playtime_group(hours: Column) -> Column:
    """Playtime bin; unknown, negative and unbounded values have none."""
    chosen = F.when(hours.isNull() | (hours < 0) | (hours == float("inf")), F.lit(None).cast("string"))
    for upper, label in K.PLAYTIME_BINS:
        if math.isinf(upper):
            return chosen.otherwise(label)
        chosen = chosen.when(hours < upper, label)


PLAYTIME_NAMES = ("author.playtime_at_review", "playtime_at_review", "author_playtime_at_review", "playtime_minutes")


def theme_flags(df: DataFrame, lists: dict[str, Sequence[str]], text: str = "text") -> DataFrame:
    """One true/false column per word list, over cleaned text."""
    return df.withColumns({name: mentions(text, words) for name, words in lists.items()})


def theme_balance(
    df: DataFrame, first: Sequence[str], second: Sequence[str],
    playtime: str | None = None, max_chars: int | None = None,
) -> DataFrame:
    """Second theme's mention rate minus the first one's, per playtime and completion cell."""
    playtime = playtime or next((name for name in PLAYTIME_NAMES if name in df.columns), None)
    if playtime is None:
        raise ValueError("The rows have no playtime-at-review column")
    plain = df.withColumnRenamed(playtime, "_minutes")
    hours = minutes_to_hours(numeric(plain, "_minutes"))
    # the text is cleaned once per row, before both searches read it
    cells = plain.filter(has_words("review", max_chars) & playtime_group(hours).isNotNull()).select(
        clean_text("review", max_chars).alias("text"),
        playtime_group(hours).alias("playtime_group"),
        completion_group().alias("completion_group"),
    )
    share = {
        name: F.avg(F.col(name).cast("int")) * 100 for name in ("first_theme", "second_theme")
    }
    sums = (
        theme_flags(cells, {"first_theme": first, "second_theme": second})
        .groupBy("playtime_group", "completion_group")
        .agg((share["second_theme"] - share["first_theme"]).alias("balance"), F.count(F.lit(1)).alias("n"))
    )
    grid = [
        (i, bin_label, j, group)
        for i, (_, bin_label) in enumerate(K.PLAYTIME_BINS)
        for j, group in enumerate(K.COMPLETION_GROUPS)
    ]
    cells = df.sparkSession.createDataFrame(
        grid, "playtime_order int, playtime_group string, completion_order int, completion_group string"
    )
    return (
        cells.join(sums, ["playtime_group", "completion_group"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .orderBy("playtime_order", "completion_order")
    )
