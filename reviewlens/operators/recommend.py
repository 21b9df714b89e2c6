"""Ranking items for a wanted text, with an optional text to avoid."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import excerpt, match_pct
from reviewlens.functions.vectors import as_vector, dot
from reviewlens.operators.blocks import in_blocks
from reviewlens.operators.sampling import dedupe, priority, top_k_per_group
from reviewlens.session import materialize


def relative_scale(df: DataFrame, column: str, name: str, by: Sequence[str] = (), bounded: bool = True) -> DataFrame:
    """Min-max scaling inside of each group; equal values all become zero.

    Groups are result lists of bounded length, such as a candidate pool. Rows
    of any number, as one group, are scaled with ``bounded=False``: two
    aggregates instead of a window.
    """
    if bounded:
        group = Window.partitionBy(*by)
        low, high = F.min(column).over(group), F.max(column).over(group)
    else:
        ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
        low, high = ends.getField("low"), ends.getField("high")
    scaled = F.when(high - low > 1e-9, (F.col(column) - low) / (high - low)).otherwise(0.0)
    return df.withColumn(name, scaled)


def _readable(text: str = "representative_review") -> Column:
    return (F.length(F.coalesce(F.col(text), F.lit(""))) >= K.READABLE_CHARS).cast("int")


def eligible_items(items: DataFrame, min_rate: float) -> DataFrame:
    """One row per item whose share of recommendations is high enough."""
    return dedupe(
        items.filter(F.col("recommendation_rate") >= min_rate).select("app_id", "app_name", "recommendation_rate", "review_count"),
        ["app_id"], [F.col("app_name"), F.col("review_count").desc(), F.col("recommendation_rate").desc()],
    )


def score_items(
    items: DataFrame, clusters: DataFrame, wanted, avoid=None, min_rate: float = K.MIN_RATE
) -> DataFrame:
    """Similarities and review choices of every eligible item with positive themes.

    ``wanted`` and ``avoid`` are plain vectors, as encoded from a request.
    Each cluster row is scored once; one aggregation per item does the rest.
    """
    eligible = eligible_items(items, min_rate)
    liked = F.col("sentiment") == "positive"
    disliked = F.col("sentiment") == "negative"
    scored = clusters.select(
        "app_id", "sentiment", "cluster", "sample_count", "representative_review",
        F.round(dot("embedding", wanted), 9).alias("_wanted"),
        (F.lit(0.0) if avoid is None else F.round(dot("embedding", avoid), 9)).alias("_avoid"),
        _readable().alias("_readable"),
    )
    review = F.col("representative_review")
    best_match = F.struct("_readable", "_wanted", -F.col("cluster"))
    largest = F.struct("_readable", "sample_count", -F.col("cluster"))
    per_item = scored.groupBy("app_id").agg(
        F.max(F.when(liked, F.col("_wanted"))).alias("wanted_similarity"),
        F.coalesce(F.max(F.when(disliked, F.col("_avoid"))), F.lit(0.0)).alias("avoid_similarity"),
        F.max_by(review, F.when(liked, best_match)).alias("positive_review"),
        F.coalesce(F.max_by(review, F.when(disliked, largest)), F.lit("")).alias("negative_review"),
    )
    return eligible.join(per_item.filter(F.col("wanted_similarity").isNotNull()), "app_id")


def rerank(scored: DataFrame, with_avoid: bool, pool: int | None = K.CANDIDATE_POOL,
           penalty: float = K.AVOID_PENALTY) -> DataFrame:
    """Rank score per item: plain similarity, or a penalised score inside the pool."""
    if not with_avoid:
        return scored.withColumns({"avoid_penalty": F.lit(0.0), "rank_score": F.col("wanted_similarity")})
    shortlist = scored if pool is None else scored.orderBy(F.desc("wanted_similarity"), "app_id").limit(pool)
    shortlist = relative_scale(shortlist, "wanted_similarity", "wanted_score", bounded=pool is not None)
    shortlist = relative_scale(shortlist, "avoid_similarity", "avoid_penalty", bounded=pool is not None)
    return shortlist.withColumn("rank_score", F.col("wanted_score") - penalty * F.col("avoid_penalty"))


def _order() -> list[Column]:
    return [F.desc(F.round("rank_score", 9)), F.desc("recommendation_rate"), F.col("app_id")]


def rank_items(
    items: DataFrame, clusters: DataFrame, wanted, avoid=None,
    min_rate: float = K.MIN_RATE, n: int = K.RESULTS,
) -> DataFrame:
    """The best ``n`` items with rank number, match percentage and excerpts."""
    ranked = rerank(score_items(items, clusters, wanted, avoid, min_rate), avoid is not None)
    top = ranked.orderBy(*_order()).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_order()))).withColumns(
        {
            "match_pct": match_pct("wanted_similarity"),
            "positive_review": excerpt("positive_review"),
            "negative_review": excerpt("negative_review"),
        }
    )


def _similarities(vectors: np.ndarray, themes: np.ndarray) -> np.ndarray:
    return np.round(vectors @ themes.T, 9)


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of one width; a null vector is a row of zeros."""
    lists = column.combine_chunks()
    out = np.zeros((len(lists), width))
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    out[there] = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _block_bests(requests: pa.Table, themes: pa.Table, width: int, k: int) -> pa.Table:
    """Per request the ``k`` items of a block that can still be wanted, each with the positive theme to show."""
    themes = themes.sort_by([("app_id", "ascending"), ("cluster", "ascending")])
    liked = themes["liked"].to_numpy(zero_copy_only=False)
    likes, dislikes = themes.filter(pa.array(liked)), themes.filter(pa.array(~liked))
    shape = {"request_id": requests.schema.field("request_id").type, "app_id": themes.schema.field("app_id").type,
             "recommendation_rate": pa.float64(), "with_avoid": pa.bool_(), "wanted_similarity": pa.float64(),
             "avoid_similarity": pa.float64(), "cluster": pa.int32()}
    if not requests.num_rows or not likes.num_rows:
        return pa.table({name: pa.array([], kind) for name, kind in shape.items()})
    wanted = _similarities(_vectors(requests["wanted"], width), _vectors(likes["embedding"], width))
    codes = pa.chunked_array([*likes["app_id"].chunks, *dislikes["app_id"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
    item, other = codes[: likes.num_rows], codes[likes.num_rows :]
    # likes are sorted by item, so an item's columns lie side by side and items are numbered in their order
    starts = np.flatnonzero(np.diff(item, prepend=-1))
    best = np.maximum.reduceat(wanted, starts, axis=1)
    with_avoid = requests["avoid"].is_valid().to_numpy()
    avoided = np.zeros_like(best)
    mine = other < len(starts)
    if mine.any() and with_avoid.any():
        against = _similarities(_vectors(requests["avoid"], width), _vectors(dislikes["embedding"], width)[mine])
        first = np.flatnonzero(np.diff(other[mine], prepend=-1))
        avoided[:, other[mine][first]] = np.maximum.reduceat(against, first, axis=1)
        avoided[~with_avoid] = 0
    rate = likes["recommendation_rate"].to_numpy()[starts]
    # ties: by rate where nothing is avoided, then by item
    by_rate = np.argsort(-rate, kind="stable")
    order = np.argsort(-best, axis=1, kind="stable")[:, :k]
    plain = by_rate[np.argsort(-best[:, by_rate], axis=1, kind="stable")[:, :k]]
    chosen = np.where(with_avoid[:, None], order, plain)
    line = np.repeat(np.arange(len(best)), chosen.shape[1])
    column = chosen.ravel()
    # the theme to show: a readable one if there is one, then the closest, then the lowest number
    readable = likes["readable"].to_numpy() > 0
    some = np.logical_or.reduceat(readable, starts)[item]
    shown = np.where(readable | ~some, wanted, -np.inf)
    ends = np.append(starts[1:], likes.num_rows)
    theme = np.array([a + shown[r, a:b].argmax() for r, a, b in zip(line.tolist(), starts[column].tolist(), ends[column].tolist())], dtype=np.int64)
    cluster = likes["cluster"].to_numpy()
    values = [requests["request_id"].take(pa.array(line)), likes["app_id"].take(pa.array(starts[column])), rate[column], with_avoid[line],
              best[line, column], avoided[line, column], cluster[theme]]
    return pa.table({name: v if isinstance(v, pa.ChunkedArray) else pa.array(v, kind) for v, (name, kind) in zip(values, shape.items())})


def rank_items_batch(
    items: DataFrame, clusters: DataFrame, requests: DataFrame, min_rate: float = K.MIN_RATE,
    n: int = K.RESULTS, pool: int = K.CANDIDATE_POOL, penalty: float = K.AVOID_PENALTY,
) -> DataFrame:
    """``rank_items`` for every row of ``requests`` (request_id, wanted, avoid) at once.

    Blocks of requests are multiplied with blocks of themes; a task gives each
    request the best ``pool`` items it has seen and no more, and these lists
    are merged like an aggregate. Texts join the few rows that are left. A
    null ``avoid`` ranks by similarity alone, requests without ``wanted`` have
    no result, and request_id is a key. The themes of one item, of which
    k-means gives a fixed number, meet in one block; (app_id, sentiment,
    cluster) is their key. All vectors have one length.
    """
    eligible = materialize(eligible_items(items, min_rate))
    themes = clusters.select(
        "app_id", (F.col("sentiment") == "positive").alias("liked"), F.col("cluster").cast("int").alias("cluster"), "sample_count",
        "representative_review", _readable().alias("readable"), as_vector("embedding").alias("embedding"),
    ).join(eligible.select("app_id", F.col("recommendation_rate").cast("double").alias("recommendation_rate")), "app_id")
    themes = materialize(themes.filter("liked IS NOT NULL AND embedding IS NOT NULL"))
    asked = requests.select("request_id", as_vector("wanted").alias("wanted"), as_vector("avoid").alias("avoid"))
    asked = materialize(asked.filter("request_id IS NOT NULL AND wanted IS NOT NULL"))
    width = themes.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    k = max(pool, n)
    kinds = dict(requests.dtypes) | {"app_id": dict(themes.dtypes)["app_id"]}
    near = in_blocks(
        asked, themes.drop("representative_review", "sample_count"), "request_id", "app_id", lambda some, others: _block_bests(some, others, width, k),
        f"request_id {kinds['request_id']}, app_id {kinds['app_id']}, recommendation_rate double, with_avoid boolean, "
        "wanted_similarity double, avoid_similarity double, cluster int",
    )
    tie = F.when(F.col("with_avoid"), 0.0).otherwise(-F.col("recommendation_rate"))
    listed = top_k_per_group(near, ["request_id"], [F.desc("wanted_similarity"), tie, F.col("app_id")], k, "_place")
    listed = listed.filter(~F.col("with_avoid") | (F.col("_place") <= pool)).drop("_place")
    for column, name in (("wanted_similarity", "_wanted"), ("avoid_similarity", "_avoid")):
        listed = relative_scale(listed, column, name, ["request_id"])
    score = F.when(F.col("with_avoid"), F.col("_wanted") - penalty * F.col("_avoid")).otherwise(F.col("wanted_similarity"))
    listed = listed.withColumn("rank_score", score)
    rank = F.row_number().over(Window.partitionBy("request_id").orderBy(*_order()))
    best = listed.withColumn("rank", rank).filter(F.col("rank") <= n).drop("recommendation_rate", "_wanted", "_avoid", "with_avoid")
    likes = themes.filter("liked").select("app_id", "cluster", F.col("representative_review").alias("positive_review"))
    largest = F.struct("readable", "sample_count", -F.col("cluster"))
    dislikes = themes.filter("NOT liked").groupBy("app_id").agg(F.max_by("representative_review", largest).alias("negative_review"))
    return (
        best.join(likes, ["app_id", "cluster"]).join(dislikes, "app_id", "left").join(eligible, "app_id")
        .select("request_id", "rank", "app_id", "app_name", "recommendation_rate", "review_count", "wanted_similarity", "avoid_similarity",
                "rank_score", match_pct("wanted_similarity").alias("match_pct"), excerpt("positive_review").alias("positive_review"),
                excerpt(F.coalesce("negative_review", F.lit(""))).alias("negative_review"))
    )


def moved_down(
    items: DataFrame, clusters: DataFrame, wanted, avoid,
    min_rate: float = K.MIN_RATE, n: int = K.RESULTS,
) -> DataFrame:
    """Items among the best ``n`` by similarity alone that the avoid text pushed out."""
    pool = rerank(score_items(items, clusters, wanted, avoid, min_rate), True)
    # the pool is short: number it once by both orders
    plain = Window.orderBy(F.desc("wanted_similarity"), "app_id")
    placed = pool.withColumn("_plain", F.row_number().over(plain)).withColumn(
        "_final", F.row_number().over(Window.orderBy(*_order()))
    )
    return placed.filter((F.col("_plain") <= n) & (F.col("_final") > n)).select("app_id", "app_name")


def random_pick(
    items: DataFrame, clusters: DataFrame, seed: int = K.SEED, min_rate: float = K.MIN_RATE
) -> DataFrame:
    """One random well-rated item that has positive themes: a random readable one, and its largest negative one."""
    rated = items.filter(F.col("recommendation_rate") >= min_rate)
    rated = rated.join(clusters.filter(F.col("sentiment") == "positive").select("app_id"), "app_id", "left_semi")
    choice = rated.withColumn("_priority", priority(["app_id"], seed)).orderBy("_priority", "app_id").limit(1)
    drawn = F.struct(
        (-F.col("_readable")).alias("unreadable"),
        priority(["app_id", "cluster"], seed + 1).alias("priority"), F.col("cluster"),
    )
    largest = F.struct("_readable", "sample_count", -F.col("cluster"))
    liked = F.col("sentiment") == "positive"
    disliked = F.col("sentiment") == "negative"
    themes = clusters.withColumn("_readable", _readable())
    # one item stays after the join, so the aggregation sees only its few themes
    chosen = choice.select("app_id", "app_name", "recommendation_rate").join(themes.drop("app_name"), "app_id")
    return chosen.groupBy("app_id", "app_name", "recommendation_rate").agg(
        F.min_by("representative_review", F.when(liked, drawn)).alias("positive_review"),
        F.coalesce(
            F.max_by("representative_review", F.when(disliked, largest)), F.lit("")
        ).alias("negative_review"),
    )
