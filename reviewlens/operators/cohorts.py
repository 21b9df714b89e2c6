"""Early-positive and long-play-negative cohorts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import boolean, minutes_to_hours, numeric, text_length
from reviewlens.operators.quantiles import box_stats, one_quantile, with_levels
from reviewlens.operators.sampling import sample_n
from reviewlens.session import materialize


def cohort_flags(
    df: DataFrame, playtime: str = "playtime_minutes",
    early: float = K.EARLY_MINUTES, long: float = K.LONG_MINUTES,
) -> DataFrame:
    """Add typed measures and the two cohort flags; unknown inputs give flag 0."""
    minutes = numeric(df, playtime)
    liked = boolean(df, "recommended")

    def flag(condition):
        return F.coalesce(condition, F.lit(False)).cast("byte")

    return df.withColumns(
        {
            "playtime_review_hours": minutes_to_hours(minutes),
            "review_length": text_length("review"),
            "received_for_free": boolean(df, "received_for_free"),
            "votes_helpful": numeric(df, "votes_helpful"),
            "is_early_positive": flag((minutes < early) & liked),
            "is_long_play_negative": flag((minutes >= long) & ~liked),
        }
    )


PROCESSED = [
    "playtime_review_hours", "review_length", "received_for_free",
    "votes_helpful", "is_early_positive", "is_long_play_negative",
]


def processed(df: DataFrame, playtime: str = "playtime_minutes", key: str | None = None) -> DataFrame:
    """The narrow table all cohort statistics read, with a key where samples are drawn."""
    return cohort_flags(df, playtime).select(*([key] if key else []), *PROCESSED)


def add_cohort(df: DataFrame) -> DataFrame:
    """Cohort name by the first flag that is set."""
    return df.withColumn(
        "cohort",
        F.when(F.col("is_early_positive") == 1, K.COHORT_EARLY)
        .when(F.col("is_long_play_negative") == 1, K.COHORT_LONG)
        .otherwise(K.COHORT_OTHER),
    )


def cohort_shares(df: DataFrame) -> DataFrame:
    """Cohort sizes in percent of all rows."""
    shares = df.agg(
        (F.avg("is_early_positive") * 100).alias("early"),
        (F.avg("is_long_play_negative") * 100).alias("long"),
    )
    return shares.select(
        F.explode(
            F.array(
                F.struct(F.lit(K.COHORT_OTHER).alias("cohort"),
                         (F.lit(100.0) - F.col("early") - F.col("long")).alias("share")),
                F.struct(F.lit(K.COHORT_EARLY).alias("cohort"), F.col("early").alias("share")),
                F.struct(F.lit(K.COHORT_LONG).alias("cohort"), F.col("long").alias("share")),
            )
        ).alias("row")
    ).select("row.*")


def free_share(df: DataFrame) -> DataFrame:
    """Share of free copies per cohort in percent; unknown ones are left out."""
    shares = df.groupBy("cohort").agg(
        (F.avg(F.col("received_for_free").cast("int")) * 100).alias("free_share")
    )
    return with_levels(shares, "cohort", K.COHORTS)


def trimmed_means(
    df: DataFrame, value: str = "votes_helpful", q: float = 0.99, upper: float = K.MAX_HELPFUL_VOTES
) -> DataFrame:
    """Mean per cohort before and after cutting values above the exact ``q`` quantile."""
    valid = df.filter((F.col(value) >= 0) & (F.col(value) < upper))
    cutoff = one_quantile(valid, value, q)
    means = valid.groupBy("cohort").agg(
        F.avg(value).alias("raw_mean"),
        F.avg(F.when(F.col(value) <= cutoff, F.col(value))).alias("trimmed_mean"),
    )
    return with_levels(means, "cohort", K.COHORTS)


def length_box(df: DataFrame) -> DataFrame:
    return box_stats(df, "cohort", "review_length", K.COHORTS)


#: Bandwidths from a point within which its kernel counts; beyond, it is under 1e-17 of its top.
DENSITY_REACH = 9.0
#: Bins to a bandwidth where the bin width follows from the data.
BINS_TO_A_BANDWIDTH = 200


def density(
    df: DataFrame, value: str, key: str | None = None, log: bool = True, grid: int = K.DENSITY_GRID,
    sample: int | None = None, floor: float | None = K.MIN_PLOTTED_HOURS, bin_width: float | None = None,
    cut: float = 3.0, seed: int = K.SEED,
) -> DataFrame:
    """Gaussian density curve of all rows, or of a seeded ``sample`` of them, on an even grid.

    Values are counted in bins far narrower than the bandwidth: of
    ``bin_width``, by default DENSITY_BIN with ``log`` and a small part of the
    bandwidth without. A bin adds to the grid steps within its kernel's reach
    and to no others, so bins of any number are worked on apart and summed up
    before the shuffle. The bandwidth follows Scott's rule and the grid reaches
    ``cut`` bandwidths beyond the data. With ``log`` bins and curve are over
    log10 of the value. Values up to ``floor`` and those that are null,
    infinite or not a number are left out; fewer than two values, or values
    without spread, have no curve and give no rows.
    """
    finite = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.abs(value) < float("inf"))
    rows = df.filter(finite if floor is None else finite & (F.col(value) > floor))
    if log:
        rows = rows.filter(F.col(value) > 0)
    if sample is not None:
        rows = sample_n(rows.select(key, value), [key], sample, seed)
    numbers = rows.select((F.log10(value) if log else F.col(value).cast("double")).alias("x"))
    if bin_width is None and not log:
        # as wide as a part of the bandwidth that all values, unbinned, would have
        wide = numbers.agg((F.stddev_samp("x") * F.pow(F.count("x"), F.lit(-0.2)) / BINS_TO_A_BANDWIDTH).alias("w")).scalar()
        width = F.when(wide > 0, wide).otherwise(1.0)
    else:
        width = F.lit(K.DENSITY_BIN if bin_width is None else bin_width)
    counts = numbers.groupBy(F.round(F.col("x") / width).alias("_bin")).agg(F.count(F.lit(1)).alias("n"))
    # bins are read for the bandwidth and for the curve
    counts = materialize(counts.select((F.col("_bin") * width).alias("x"), "n"))
    basic = counts.agg(F.struct(
        F.sum("n").alias("n"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    total, mean = basic.getField("n"), basic.getField("mean")
    spread = counts.agg(F.struct(F.sqrt(F.sum(F.col("n") * F.pow(F.col("x") - mean, F.lit(2.0))) / F.when(total > 1, total - 1)).alias("v"))).scalar().getField("v")
    # rounding is no spread
    there = spread > 1e-12 * F.greatest(F.abs(basic.getField("low")), F.abs(basic.getField("high")))
    shape = {"_h": spread * F.pow(total, F.lit(-0.2)), "_low": basic.getField("low"), "_high": basic.getField("high"), "_n": total}

    def placed(frame: DataFrame) -> DataFrame:
        frame = frame.filter(there).withColumns(shape)
        frame = frame.withColumns({"_low": F.col("_low") - F.col("_h") * cut, "_high": F.col("_high") + F.col("_h") * cut})
        return frame.withColumn("_step", (F.col("_high") - F.col("_low")) / float(grid - 1))

    reach = F.col("_h") * DENSITY_REACH
    first = F.greatest(F.lit(0), F.ceil((F.col("x") - reach - F.col("_low")) / F.col("_step")))
    last = F.least(F.lit(grid - 1), F.floor((F.col("x") + reach - F.col("_low")) / F.col("_step")))
    near = placed(counts).withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    near = near.withColumn("step", F.explode(F.sequence(F.col("_first").cast("int"), F.col("_last").cast("int"))))
    at = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("step") / float(grid - 1))
    kernel = F.exp(F.lit(-0.5) * F.pow((at - F.col("x")) / F.col("_h"), F.lit(2.0)))
    sums = near.groupBy("step").agg(F.sum(F.col("n") * kernel).alias("_sum"))
    steps = placed(df.sparkSession.range(grid).select(F.col("id").cast("int").alias("step")))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return steps.join(F.broadcast(sums), "step", "left").select(
        "step", (F.pow(F.lit(10.0), at) if log else at).alias("at"), (F.coalesce("_sum", F.lit(0.0)) / scale).alias("density"))
