"""Exact quantiles of columns that no single task could hold.

Values are first counted and written once, so repeats cost nothing and the
table is read once. Counts are then summed into buckets by a rising function of
the value; the totals show which buckets hold the wanted ranks, those are cut
into finer parts the same way, and only the values of the parts that hold a
rank are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.session import materialize

# buckets per doubling of the value; doubles span fewer than 2 * SPAN doublings
BUCKETS = 1024
SPAN = 1100
# parts of a bucket's range of values
PARTS = 4096


def value_counts_numeric(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their frequencies, as ``_v`` and ``_n``."""
    number = F.col(value).cast("double")
    return (
        df.select(*by, number.alias("_v"))
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises, finer near zero."""
    size = F.abs(value)
    steps = F.floor(F.when(size == float("inf"), F.lit(float(SPAN))).otherwise(F.log2(size)) * BUCKETS)
    # never null, so that no filter of its own keeps the counts from being reused
    return F.coalesce(F.signum(value).cast("long") * (steps + SPAN * BUCKETS), F.lit(0))


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles as rows (``by``…, ``prob``, ``quantile``)."""
    return quantiles_of_counts(materialize(value_counts_numeric(df, value, by)), probs, by)


def _holding(counts: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Buckets that hold a wanted rank: (``by``…, _b, prob, at, _before)."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.array(
        *[
            F.struct(F.lit(float(p)).alias("prob"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("at"))
            for p in probs
        ]
    )
    return (
        counts.groupBy(*by, "_b")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_total", F.sum("_in").over(group))
        .withColumn("_upto", F.sum("_in").over(running))
        .withColumn("_want", F.explode(ranks))
        .select(*by, "_b", "_want.prob", "_want.at", (F.col("_upto") - F.col("_in")).alias("_before"), "_upto")
        .filter((F.ceil("at") >= F.col("_before")) & (F.floor("at") < F.col("_upto")))
        .drop("_upto")
    )


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from (``by``…, _v, _n): the bucket of each rank, then its finer part, then the values in order.

    Both narrowings look at bucket sums alone. The second one cuts the range of
    values that a bucket really holds into ``PARTS``, so values that all lie
    close together are spread as well as any others.
    """
    by = list(by)
    counts = counts.withColumn("_b", _bucket(F.col("_v")))
    coarse = _holding(counts, by, probs)
    if not by:
        # at most two buckets for each probability
        coarse = F.broadcast(coarse)
    near = counts.join(coarse, [*by, "_b"])
    # a rank between two values may want two buckets; each is cut on its own
    range_ = near.groupBy(*by, "prob", "_b").agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    part = F.floor((F.col("_v") / 2 - F.col("_min") / 2) / (F.col("_max") / 2 - F.col("_min") / 2) * PARTS)
    spread = (F.col("_max") > F.col("_min")) & (F.col("_max") < float("inf")) & (F.col("_min") > float("-inf"))
    fine = near.join(range_, [*by, "prob", "_b"]).withColumn(
        "_b", F.struct(F.col("_b").alias("b"), F.when(spread, part).otherwise(0).alias("part"))
    )
    # ranks of a bucket start where the first narrowing said
    fine = fine.withColumn("_from", F.col("_before"))
    sums = fine.groupBy(*by, "prob", "_from", "_b").agg(F.sum("_n").alias("_in"), F.max("at").alias("at"))
    running = Window.partitionBy(*by, "prob", "_from").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("_upto", F.col("_from") + F.sum("_in").over(running)).withColumn("_start", F.col("_upto") - F.col("_in"))
    holding = sums.filter((F.ceil("at") >= F.col("_start")) & (F.floor("at") < F.col("_upto"))).select(
        *by, "prob", "_from", "_b", F.col("_start").alias("_before")
    )
    inside = Window.partitionBy(*by, "prob", "_from", "_b").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = (
        fine.drop("_before").join(holding, [*by, "prob", "_from", "_b"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def value_at(rank):
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    found = placed.groupBy(*by, "prob").agg(
        value_at(F.floor("at")).alias("_lo"), value_at(F.ceil("at")).alias("_hi"), F.max("at").alias("at")
    )
    step = F.col("at") - F.floor("at")
    return found.select(
        *by, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * step).alias("quantile")
    )


def one_quantile(df: DataFrame, value: str, prob: float) -> Column:
    """A single exact quantile, as a value usable in any expression."""
    return exact_quantiles(df, value, [prob]).select("quantile").scalar()


def box_stats(df: DataFrame, group: str, value: str, levels: Sequence[str]) -> DataFrame:
    """Quartiles and whiskers per group level, in display order.

    Whiskers end at the outermost values within 1.5 quartile ranges, and never
    inside the box.
    """
    counts = materialize(value_counts_numeric(df.filter(F.col(group).isin(list(levels))), value, [group]))
    quartiles = (
        quantiles_of_counts(counts, [0.25, 0.5, 0.75], [group])
        .groupBy(group)
        .agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
        )
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fenced = (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach)
    # one row per level, so this side is as short as the list of levels
    whiskers = (
        counts.join(F.broadcast(quartiles), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(fenced, F.col("_v"))), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(fenced, F.col("_v"))), F.col("q3")).alias("whisker_high"),
            F.sum("_n").alias("n"),
        )
    )
    return with_levels(whiskers, group, levels)


def with_levels(df: DataFrame, group: str, levels: Sequence[str]) -> DataFrame:
    """Left join onto the literal list of levels, so empty groups survive, in order."""
    rows = [(i, level) for i, level in enumerate(levels)]
    listed = df.sparkSession.createDataFrame(rows, f"{group}_order int, {group} string")
    return listed.join(df, group, "left").orderBy(f"{group}_order")
