"""Repeatable samples and top-k selections.

A row's priority is the md5 of its identity and a seed, so a sample depends on
the rows alone: never on file order, partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import parse_boolean, strip
from reviewlens.session import materialize

SALTS = 32
PREFIX_CHARS = 4


def priority(keys: Sequence[str], seed: int = K.SEED) -> Column:
    """Hash priority of a row: md5 over ``key|…|seed``."""
    return F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed))))


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int | None, rank: str | None = None,
    salt: Column | None = None,
) -> DataFrame:
    """First ``k`` rows of each group in the given total order; all rows without ``k``.

    Runs in two rounds so that one huge group is never sorted by one task: the
    first round ranks inside (group, salt), and Spark's group limit trims each
    partition before that shuffle. The second round sees at most ``k`` rows per
    salt. The salt is the input partition; give another one where the input is
    already partitioned by group.
    """
    if k is None:
        return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))) if rank else df
    first = Window.partitionBy(*by, "_salt").orderBy(*order)
    last = Window.partitionBy(*by).orderBy(*order)
    trimmed = (
        df.withColumn("_salt", (F.spark_partition_id() if salt is None else salt) % SALTS)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= k)
        .drop("_salt", "_rank")
    )
    name = rank or "_rank"
    best = trimmed.withColumn(name, F.row_number().over(last)).filter(F.col(name) <= k)
    return best if rank else best.drop(name)


def cap_per_group(
    df: DataFrame, by: Sequence[str], key: str, n: int | None = K.REVIEWS_PER_ITEM, seed: int = K.SEED
) -> DataFrame:
    """At most ``n`` random rows of each group; all of them without ``n``."""
    ranked = df.withColumn("_priority", priority([key], seed))
    return top_k_per_group(ranked, by, [F.col("_priority"), F.col(key)], n).drop("_priority")


def sample_rows(df: DataFrame, rating: str = "recommended", text: str = "review") -> DataFrame:
    """What samples are drawn from: readable ratings and stripped texts; row-wise, so it also takes a stream."""
    typed = df.withColumn(rating, parse_boolean(rating, "basic")).dropna(subset=["app_id", rating])
    return typed.withColumn(text, strip(F.coalesce(text, F.lit(""))))


def hash_sample(
    df: DataFrame,
    item: str = "app_id",
    rating: str = "recommended",
    text: str = "review",
    key: str | None = "review_id",
    k: int | None = K.SAMPLE_PER_SENTIMENT,
    min_chars: int = K.MIN_SAMPLE_CHARS,
    seed: int = K.SEED,
) -> DataFrame:
    """The ``k`` lowest-priority texts per (item, rating); short texts are out.

    Expects stripped texts. Without a key column, item and text identify a row.
    """
    identity = [key] if key else [item, text]
    rows = df.filter(F.length(text) >= min_chars).withColumn("_priority", priority(identity, seed))
    order = [F.col("_priority"), F.col(text)]
    return top_k_per_group(rows, [item, rating], order, k)


def dedupe_sample(
    sample: DataFrame, item: str = "app_id", rating: str = "recommended",
    text: str = "review", key: str | None = "review_id",
) -> DataFrame:
    """Drop repeats inside a sample; groups may end up with fewer than ``k`` rows."""
    order = [F.col("_priority"), F.col(rating).desc(), F.col(text)]
    return dedupe(sample, [item, key or text], order)


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first"
) -> DataFrame:
    """One row per key, the first or last in an explicit order; null keys are equal."""
    if keep == "last":
        order = [F.desc(c) if isinstance(c, str) else c.desc() for c in order]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _prefix() -> Column:
    return F.substring("_priority", 1, PREFIX_CHARS)


def _prefix_counts(hashed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows up to each hash prefix, at most 16 ** PREFIX_CHARS of them per group."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = hashed.groupBy(*by, _prefix().alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn("_seen", F.sum("_n").over(running))


def _cutoff(n: int) -> Column:
    """First prefix that covers n rows; one past all prefixes when there are fewer."""
    return F.coalesce(F.min(F.when(F.col("_seen") >= n, F.col("_prefix"))), F.lit("g"))


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = K.SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows with the lowest priorities, as ``_priority``.

    A first pass counts rows by the first hash digits and finds the digit
    prefix that holds the n-th row. Rows with a lower prefix are all in; those
    with that very prefix are put in order, which is one part in 65,536 of the
    table, whatever the sample's size.
    """
    hashed = df.withColumn("_priority", priority(keys, seed))
    counts = _prefix_counts(hashed)
    missing = F.max(F.when(F.col("_seen") >= n, n - F.col("_seen") + F.col("_n")))
    edge = counts.agg(F.struct(_cutoff(n).alias("prefix"), F.coalesce(missing, F.lit(0)).alias("rows"))).scalar()
    order = Window.partitionBy("_prefix").orderBy("_priority", *keys)
    near = hashed.withColumn("_prefix", _prefix()).filter(F.col("_prefix") <= edge.getField("prefix"))
    ranked = near.withColumn("_rank", F.row_number().over(order))
    chosen = (F.col("_prefix") < edge.getField("prefix")) | (F.col("_rank") <= edge.getField("rows"))
    return ranked.filter(chosen).drop("_prefix", "_rank")


def select_users(
    users: DataFrame, states: DataFrame, user: str = "rater_id",
    n: int = K.PUBLIC_USERS, seed: int = K.SEED,
) -> DataFrame:
    """``n`` random users with a public profile; fails when there are fewer."""
    from reviewlens.operators.joins import with_visibility

    visible = with_visibility(users.select(user).dropna().distinct(), states, user)
    visible = visible.filter(F.col("state") == K.PUBLIC_STATE)
    chosen = materialize(sample_n(visible, [user], n, seed).select(user))
    found = chosen.count()
    if found < n:
        raise RuntimeError(f"{n:,} public users are wanted, {found:,} exist")
    return chosen


def balanced_sample(
    df: DataFrame, key: str, side: str = "side", limit: int | None = K.TEXT_SAMPLE_LIMIT,
    minimum: int = K.MIN_TEXTS_PER_SIDE, seed: int = K.SEED,
) -> DataFrame:
    """Equally large random samples of the rows marked ``low`` and ``high``, of ``limit`` rows each at the most.

    One pass over the keys counts rows by side and hash prefix; as in
    ``sample_n`` only rows with the prefix that holds a side's last row are
    ranked, so no task orders a whole side.
    """
    low = F.col(side) == "low"
    side_seed = F.when(low, str(seed)).otherwise(str(seed + 1))
    hashed = df.withColumn("_priority", F.md5(F.concat_ws("|", F.col(key).cast("string"), side_seed)))
    counts = materialize(_prefix_counts(hashed, [side]))
    rows = [F.coalesce(F.max(F.when(low if is_low else ~low, F.col("_seen"))), F.lit(0)) for is_low in (True, False)]
    size = F.least(*rows, *([] if limit is None else [F.lit(limit)]))
    too_few = F.raise_error(F.lit(f"Each side has to hold {minimum} usable reviews or more")).cast("long")
    sized = counts.withColumn("_size", counts.agg(F.when(size >= minimum, size).otherwise(too_few).alias("n")).scalar())
    reached = F.col("_seen") >= F.col("_size")

    def edge(condition: Column) -> Column:
        missing = F.max(F.when(reached & condition, F.col("_size") - F.col("_seen") + F.col("_n")))
        prefix = F.coalesce(F.min(F.when(reached & condition, F.col("_prefix"))), F.lit("g"))
        return F.struct(prefix.alias("prefix"), F.coalesce(missing, F.lit(0)).alias("rows"))

    plan = sized.agg(F.struct(edge(low).alias("low"), edge(~low).alias("high"))).scalar()
    last = F.when(low, plan.getField("low")).otherwise(plan.getField("high"))
    near = hashed.withColumns({"_prefix": _prefix(), "_last": last}).filter(F.col("_prefix") <= F.col("_last.prefix"))
    order = Window.partitionBy(side, "_prefix").orderBy("_priority", key)
    ranked = near.withColumn("_rank", F.row_number().over(order))
    chosen = (F.col("_prefix") < F.col("_last.prefix")) | (F.col("_rank") <= F.col("_last.rows"))
    return ranked.filter(chosen).drop("_rank", "_priority", "_prefix", "_last")
