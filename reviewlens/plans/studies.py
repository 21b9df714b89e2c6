"""The complete studies, composed from the operators.

Frames that several results read are written once to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import clean_id, clean_text, has_words, item_matches, numeric
from reviewlens.operators import cohorts, completion, consensus, critics, joins, pca, recommend, sampling, text, themes
from reviewlens.session import materialize
from reviewlens.sources.tables import require_columns


def cohort_study(
    reviews: DataFrame, playtime: str = "playtime_minutes", key: str = "review_id"
) -> dict[str, DataFrame]:
    """Playtime curve, and shares, lengths, free copies and votes of the three cohorts."""
    narrow = materialize(cohorts.processed(reviews, playtime, key))
    labelled = cohorts.add_cohort(narrow)
    return {
        "density": cohorts.density(narrow, "playtime_review_hours"),
        "shares": cohorts.cohort_shares(narrow),
        "length": cohorts.length_box(labelled),
        "free": cohorts.free_share(labelled),
        "votes": cohorts.trimmed_means(labelled),
    }


def cohort_summary(reviews: DataFrame, playtime: str = "playtime_minutes") -> DataFrame:
    """The cohort study as one row per cohort."""
    parts = cohort_study(reviews, playtime)
    summary = parts["length"]
    for name in ("shares", "free", "votes"):
        summary = summary.join(parts[name].drop("cohort_order"), "cohort")
    return summary.orderBy("cohort_order")


def enrichment(
    reviews: DataFrame, states: DataFrame, responses: DataFrame, order: Sequence[str],
    users: int = K.PUBLIC_USERS, user: str = "rater_id", seed: int = K.SEED, finished: DataFrame | None = None,
) -> DataFrame:
    """Reviews of randomly chosen public users with their classified results.

    ``finished`` holds results of an earlier run, with the columns of the new
    ones; only responses for reviews it does not cover are classified. User ids
    and leftover index columns do not go into the result.
    """
    require_columns(reviews, [user, "review_id", "app_id"], "Reviews")
    typed = reviews.withColumns({name: clean_id(name) for name in (user, "review_id", "app_id")})
    typed = typed.dropna(subset=[user, "review_id", "app_id"])
    known = states.withColumn(user, clean_id(user))
    chosen = sampling.select_users(typed, known, user, users, seed)
    public = materialize(joins.rows_of(typed, chosen, user))
    results = responses.withColumn("review_id", clean_id("review_id"))
    if finished is not None:
        finished = finished.withColumn("review_id", clean_id("review_id"))
        open_ids = joins.pending(public.select("review_id", "app_id", user), finished, ids=["app_id", user])
        results = results.join(open_ids.select("review_id"), "review_id", "left_semi")
    results = joins.classify_responses(results)
    if finished is not None:
        results = results.unionByName(finished, allowMissingColumns=True)
    return joins.enrich_reviews(public, results, order).drop(user, "Unnamed: 0", "0")


def text_sides(rated: DataFrame, rating: float, seed: int, key: str = "review_id",
               limit: int = K.TEXT_SAMPLE_LIMIT, minimum: int = K.MIN_TEXTS_PER_SIDE,
               max_chars: int | None = None) -> DataFrame:
    """Equally many cleaned texts of low and of high completion for one rating.

    Sampling comes first, so only the chosen texts are cleaned.
    """
    completed = F.col("completion_percentage")
    side = F.when(completed <= K.LOW_COMPLETION, "low").when(completed >= K.HIGH_COMPLETION, "high")
    usable = rated.filter((F.col("rating") == rating) & side.isNotNull()).select(
        key, "review", side.alias("side")
    )
    usable = usable.filter(has_words("review", max_chars))
    chosen = sampling.balanced_sample(usable, key, "side", limit, minimum, K.SEED + seed)
    return chosen.select(key, "side", clean_text("review", max_chars).alias("text"))


def distinctive_terms(rated: DataFrame, rating: float, seed: int, key: str = "review_id", **options) -> DataFrame:
    """Most distinctive terms of low and high completion for one rating."""
    sides = materialize(text_sides(rated, rating, seed, key, **options))
    return text.top_terms(text.tfidf_difference(sides, key))


def completion_report(enriched: DataFrame, order: Sequence[Column]) -> dict[str, DataFrame]:
    """What the cleaning of a completion study keeps and drops."""
    typed = enriched.withColumns(
        {name: clean_id(name) for name in ("review_id", "app_id")}
        | {name: numeric(enriched, name) for name in ("achievements_unlocked", "total_achievements")}
    )
    known = typed.dropna(subset=["review_id", "app_id"])
    single = sampling.dedupe(known, ["review_id"], order)
    return {
        "duplicates": consensus.duplicate_count(known, "review_id"),
        "statuses": consensus.value_counts(single, "fetch_status"),
        "stages": consensus.stage_report(single, completion.completion_stages()),
    }


def completion_study(
    enriched: DataFrame, order: Sequence[Column],
    positive: tuple[Sequence[str], Sequence[str]] = (K.POSITIVE_PLAY_SOCIAL, K.POSITIVE_STORY_ART),
    negative: tuple[Sequence[str], Sequence[str]] = (K.NEGATIVE_PLAY_ACCESS, K.NEGATIVE_SERVICE_COMMUNITY),
    cap: int = K.REVIEWS_PER_ITEM, max_chars: int | None = None,
    minimum: int = K.MIN_TEXTS_PER_SIDE,
) -> dict[str, DataFrame]:
    """Recommendation rates, distinctive terms and theme grids by completion."""
    rated = materialize(completion.rated_rows(completion.completion_rows(enriched, order, cap)))
    liked, disliked = (rated.filter(F.col("rating") == value) for value in (1.0, 0.0))
    sides = {"max_chars": max_chars, "minimum": minimum}
    return {
        "rate": completion.rate_by_band(rated),
        "positive_terms": distinctive_terms(rated, 1.0, 10, **sides),
        "positive_themes": completion.theme_balance(liked, *positive, max_chars=max_chars),
        "negative_terms": distinctive_terms(rated, 0.0, 20, **sides),
        "negative_themes": completion.theme_balance(disliked, *negative, max_chars=max_chars),
    }


def critic_study(
    reviews: DataFrame, pages: DataFrame, order: Sequence[str], min_reviews: int = K.MIN_ITEM_REVIEWS
) -> DataFrame:
    """Player consensus against critic score for every matched title.

    ``pages`` are critic rows, or raw pages whose fields are extracted first.
    """
    if "Title" not in pages.columns:
        pages = critics.extract_page_fields(pages)
    clean = critics.dedupe_critics(critics.clean_critics(pages), order)
    return finish_critic_study(critics.match_titles(consensus.consensus(reviews, min_reviews), clean))


def finish_critic_study(matched: DataFrame) -> DataFrame:
    """Derived columns where a stored result lacks them; rows without score drop out."""
    return critics.add_delta(matched).dropna(subset=["Metascore"]).drop("merge_name")


def critic_report(matched: DataFrame, n: int = K.TAIL_SIZE) -> dict[str, DataFrame]:
    """Share of outliers, and the titles players and critics disagree on most."""
    compared = critics.add_delta(matched)
    return {"outliers": consensus.outlier_share(compared), "tails": critics.both_tails(compared, n=n)}


def profile_sample(reviews: DataFrame, k: int = K.SAMPLE_PER_SENTIMENT, key: str | None = "review_id",
                   seed: int = K.SEED) -> DataFrame:
    """Deduplicated sample of stripped texts per (item, rating)."""
    require_columns(reviews, ["app_id", "app_name", "review", "recommended"], "Reviews")
    typed = sampling.sample_rows(reviews)
    return sampling.dedupe_sample(sampling.hash_sample(typed, key=key, k=k, seed=seed), key=key)


def sentiment() -> Column:
    return F.when(F.col("recommended"), "positive").otherwise("negative")


def item_profiles(
    reviews: DataFrame, k: int = K.SAMPLE_PER_SENTIMENT, encoder: Callable[[Column], Column] | None = None,
    restarts: int = K.KMEANS_RESTARTS, iterations: int = K.KMEANS_ROUNDS, seed: int = K.SEED,
) -> tuple[DataFrame, DataFrame]:
    """Item table and opinion themes of all items: (items, clusters)."""
    sample = materialize(profile_sample(reviews, k, seed=seed))
    profiles = consensus.item_profiles(consensus.item_counts(reviews), sample)
    members = sample.select("app_id", "app_name", "review_id", "review", sentiment().alias("sentiment"))
    members = materialize(themes.encode_text(members, encoder=encoder))
    by = ["app_id", "sentiment"]
    assigned = themes.grouped_kmeans(
        members, by, "review_id", restarts=restarts, iterations=iterations, seed=seed
    )
    joined = members.join(assigned, [*by, "review_id"])
    return profiles, themes.representatives(joined, by, "review_id")


def item_search(
    items: DataFrame, clusters: DataFrame, wanted, avoid=None,
    min_rate: float = K.MIN_RATE, n: int = K.RESULTS,
) -> DataFrame:
    """Best matches, followed by those the avoid text moved down (without a rank)."""
    best = recommend.rank_items(items, clusters, wanted, avoid, min_rate, n)
    best = best.select("app_id", "app_name", "rank", "match_pct", "recommendation_rate", "review_count",
                       "positive_review", "negative_review")
    if avoid is None:
        return best
    pushed = recommend.moved_down(items, clusters, wanted, avoid, min_rate, n)
    return best.unionByName(pushed, allowMissingColumns=True)


def theme_map(
    reviews: DataFrame, needle: str, item_id=None, k: int = K.SAMPLE_PER_SENTIMENT,
    encoder: Callable[[Column], Column] | None = None, restarts: int = K.KMEANS_RESTARTS,
    iterations: int = K.KMEANS_ROUNDS, seed: int = K.SEED,
) -> DataFrame:
    """Themes of one item: label, share, size, representative text and place on the map."""
    rows = reviews.filter(item_matches("app_name", "app_id", needle, item_id))
    # all matching ids form one item from here on
    sample = profile_sample(rows.withColumn("app_id", F.lit(needle)), k, seed=seed)
    sample = materialize(sample.withColumn("sentiment", sentiment()))
    if sample.isEmpty():
        raise ValueError(f"No item matches {needle!r}")
    title = consensus.mode_value(sample, "app_name").select("app_name").scalar()
    members = materialize(themes.encode_text(sample, encoder=encoder))
    by = ["sentiment"]
    assigned = themes.grouped_kmeans(
        members, by, "review_id", restarts=restarts, iterations=iterations, seed=seed
    )
    members = materialize(members.join(assigned, [*by, "review_id"]))
    labels = themes.describe_clusters(
        themes.cluster_terms(members, by, "review_id").withColumn("_title", F.split(F.lower(title), r"\W+")),
        by, banned_column="_title",
    )
    keys = ["sentiment", "cluster"]
    places = themes.map_centers(pca.pca_2d(members, "review_id", carry=["cluster"], by=by), keys)
    shares = themes.cluster_shares(members, by=by).filter(F.col("n") > 0)
    return (
        themes.representatives(members, by, "review_id")
        .join(labels, keys, "left")
        .join(shares.select(*keys, "share"), keys)
        .join(places, keys)
        .select(title.alias("app_name"), *keys, F.coalesce("description", F.lit(K.LABEL_FALLBACK)).alias("description"),
                "sample_count", "share", "pc1", "pc2", "representative_review")
        .orderBy(F.desc("sentiment"), "cluster")
    )
