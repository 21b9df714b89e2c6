"""Registered queries: every operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens import adapters as A, constants as K
from reviewlens.functions import clean, titles, vectors
from reviewlens.operators import (
    cohorts, completion, consensus, critics, joins, pca, quantiles, recommend, sampling, text, themes,
)
from reviewlens.plans import studies
from reviewlens.session import shared_path
from reviewlens.streaming import incremental

DIGITS = 6
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def whole(column: Column) -> Column:
    return column.cast("bigint")


def elements(df: DataFrame, keys: list[str], vector: str, digits: int = DIGITS) -> DataFrame:
    """One row per vector element."""
    return df.select(*keys, F.posexplode(vector).alias("pos", "value")).select(
        *keys, whole(F.col("pos")).alias("pos"), F.round(F.col("value").cast("double"), digits).alias("value")
    )


# --- column functions ----------------------------------------------------------


@query
def parse_boolean(spark, d):
    words = F.array(*[F.lit(w) for w in (
        "True", " TRUE ", "1", "1.0", "yes", "0.0", "no", "recommended",
        "Not Recommended", "t", "", "0", "false", "positive", "2", " NO ",
    )])
    rows = A.plays(spark, d).withColumn("word", F.get(words, (F.col("review_id") % 17).cast("int")))
    return rows.select(
        "review_id", "word",
        clean.parse_boolean("word", "extended").alias("extended"),
        clean.parse_boolean("word", "basic").alias("basic"),
        clean.rating_value("word").alias("rating"),
    )


@query
def coerce_numeric(spark, d):
    # numbers, words and broken numbers, taken from the raw event properties
    rows = A.table(spark, d, "events").select(
        "event_id", F.regexp_extract("props", r": (.*)\}", 1).alias("number"), "event_type"
    )
    mixed = (
        F.when(F.col("event_id") % 5 == 0, F.col("event_type"))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit(" "), "number", F.lit(".50 ")))
        .when(F.col("event_id") % 5 == 2, F.concat("number", F.lit("e2")))
        .when(F.col("event_id") % 5 == 3, F.concat("number", F.lit("..")))
        .otherwise(F.concat(F.lit("-"), "number"))
    )
    rows = rows.withColumn("raw", mixed)
    return rows.select("event_id", "raw", clean.coerce_double("raw").alias("value"))


@query
def clean_id(spark, d):
    rows = A.plays(spark, d)
    raw = (
        F.when(F.col("review_id") % 6 == 0, F.concat(F.lit(" "), "review_id", F.lit(".0 ")))
        .when(F.col("review_id") % 6 == 1, F.col("review_id").cast("string"))
        .when(F.col("review_id") % 6 == 2, F.lit("NaN"))
        .when(F.col("review_id") % 6 == 3, F.lit(" <NA> "))
        .when(F.col("review_id") % 6 == 4, F.concat("review_id", F.lit(".05")))
    )
    return rows.select("review_id", raw.alias("raw")).select(
        "review_id", "raw", clean.clean_id("raw").alias("id")
    )


@query
def cohort_flags(spark, d):
    rows = cohorts.add_cohort(cohorts.cohort_flags(A.text_reviews(spark, d)))
    return rows.select(
        "review_id", F.round("playtime_review_hours", 6).alias("playtime_review_hours"),
        whole(F.col("review_length")).alias("review_length"), "received_for_free", "votes_helpful",
        whole(F.col("is_early_positive")).alias("is_early_positive"),
        whole(F.col("is_long_play_negative")).alias("is_long_play_negative"), "cohort",
    )


def _clean_docs(spark, d):
    docs = A.table(spark, d, "documents").filter(clean.has_words("text"))
    return docs.select("doc_id", clean.clean_text("text").alias("text"))


@query
def clean_text(spark, d):
    return _clean_docs(spark, d)


@query
def theme_flags(spark, d):
    lists = {"first_theme": A.THEME_ONE, "second_theme": A.THEME_TWO}
    return completion.theme_flags(_clean_docs(spark, d), lists).drop("text")


def _titled_parts(spark, d):
    """Part names dressed up as titles, with symbols, numbers and numerals."""
    return A.table(spark, d, "part").selectExpr(
        "p_partkey",
        "CASE p_partkey % 5 WHEN 0 THEN concat(upper(p_name), '™: Part ', p_size) "
        "WHEN 1 THEN concat(p_name, ' ', CASE p_size % 4 WHEN 0 THEN 'VII' WHEN 1 THEN 'iv' "
        "WHEN 2 THEN 'Mix' ELSE 'IIII' END) "
        "WHEN 2 THEN concat(p_name, '*', p_type, ' (R) GOTY') "
        "WHEN 3 THEN concat('Tom''s ', p_name, ' - Year ', p_partkey * 7) "
        "ELSE concat('  ', p_name, '/', p_type, ',  ', p_brand, ' ') END AS title",
    )


@query
def title_key(spark, d):
    rows = _titled_parts(spark, d)
    return rows.select("p_partkey", "title", titles.title_key("title").alias("title_key"))


@query
def slug_candidates(spark, d):
    rows = _titled_parts(spark, d)
    found = rows.select("p_partkey", F.posexplode(titles.slug_candidates("title")).alias("position", "url"))
    return found.withColumn("position", whole(F.col("position")))


@query
def roman_numerals(spark, d):
    rows = A.table(spark, d, "part").select("p_partkey", (F.col("p_partkey") + F.col("p_size")).alias("number"))
    rows = rows.withColumn("roman", titles.to_roman("number"))
    broken = F.when(F.col("p_partkey") % 3 == 0, F.concat("roman", F.lit("i"))).otherwise(F.col("roman"))
    return rows.withColumn("numeral", broken).withColumn("back", whole(titles.from_roman("numeral")))


@query
def item_filter(spark, d):
    rows = A.ratings(spark, d).select("app_id", "app_name").distinct()
    matched = clean.item_matches("app_name", "app_id", "ER#00000000", 42)
    return rows.filter(matched)


@query
def excerpt(spark, d):
    docs = A.table(spark, d, "documents")
    return docs.select("doc_id", clean.excerpt("text").alias("excerpt"))


@query
def unit_vectors(spark, d):
    rows = A.table(spark, d, "embeddings")
    # scaled away from unit length first, so the operator has work to do
    longer = rows.select("vec_id", F.transform("embedding", lambda x: x * (F.col("label") + 1)).alias("v"))
    return elements(longer.select("vec_id", vectors.unit_vector("v").alias("v")), ["vec_id"], "v")


@query
def dot_scores(spark, d):
    wanted = A.query_vector(spark, d, 0)
    rows = A.table(spark, d, "embeddings")
    return rows.select("vec_id", F.round(vectors.dot("embedding", wanted), DIGITS).alias("score"))


@query
def page_fields(spark, d):
    fields = {**A.TEST_PAGE_FIELDS, "page_number": (r"page=(\d+)", "int")}
    pages = A.table(spark, d, "pages")
    found = critics.extract_page_fields(
        pages.select("page_id", F.concat_ws("\n", "html", "url").alias("html")), fields
    )
    return found.drop("html").withColumns(
        {name: whole(F.col(name)) for name in ("Metascore", "NumberOfCriticReviews", "page_number")}
    )


# --- joins and collection -------------------------------------------------------


@query
def classify_responses(spark, d):
    rows = joins.classify_responses(A.responses(spark, d)).drop("body")
    return rows.withColumns(
        {name: whole(F.col(name)) for name in ("http_status", "achievements_unlocked", "total_achievements")}
    )


@query
def completion_share(spark, d):
    rows = completion.completion_rows(A.text_reviews(spark, d), [F.col("ts")])
    rows = rounded(rows, "completion_percentage")
    return rows.select("review_id", "app_id", "completion_percentage")


@query
def enrich_reviews(spark, d):
    reviews = A.plays(spark, d).select("review_id", "app_id", "recommended")
    first = joins.classify_responses(A.responses(spark, d)).withColumn("attempt", F.lit(1))
    # a failed first attempt is followed by a second one
    second = first.filter(F.col("fetch_status") == "Error_500").withColumns(
        {"attempt": F.lit(2), "fetch_status": F.lit("No_Stats")}
    )
    joined = joins.enrich_reviews(reviews, first.unionByName(second), ["attempt"])
    return joined.withColumns(
        {name: whole(F.col(name)) for name in ("achievements_unlocked", "total_achievements")}
    )


@query
def public_users(spark, d):
    users = A.plays(spark, d)
    return sampling.select_users(users, A.states(spark, d), "rater_id", 20)


@query
def public_user_reviews(spark, d):
    rated = A.plays(spark, d)
    chosen = sampling.select_users(rated, A.states(spark, d), "rater_id", 20)
    return joins.rows_of(rated, chosen).select("review_id", "rater_id", "app_id")


@query
def pending_targets(spark, d):
    rated = A.plays(spark, d)
    done = rated.filter(F.col("fetch_status") == "Success")
    # some targets are listed twice
    targets = rated.unionByName(rated.filter("review_id % 10 = 0"))
    return joins.pending(targets, done, order=["ts"], ids=["app_id", "rater_id"]).select("review_id", "app_id")


@query
def pending_urls(spark, d):
    template = "u/%s"
    names = consensus.consensus(A.ratings(spark, d)).select("app_name").distinct()
    names = names.withColumn("urls", titles.slug_candidates("app_name", template))
    pages = names.select(F.explode("urls").alias("url"))
    successful = pages.filter(F.col("url").rlike("3$"))
    tried = pages.filter(F.col("url").rlike("[57]$"))
    found = joins.pending_pages(names, "urls", tried, successful)
    return found.withColumn("position", whole(F.col("position")))


# --- samples and deduplication -----------------------------------------------------


@query
def cap_per_group(spark, d):
    return sampling.cap_per_group(A.plays(spark, d), ["app_id"], "review_id", 20).select("review_id", "app_id")


@query
def hash_sample(spark, d):
    sample = studies.profile_sample(A.text_reviews(spark, d), k=10)
    return sample.select("review_id", "app_id", "recommended")


@query
def dedupe_first(spark, d):
    rows = A.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return sampling.dedupe(rows, ["l_partkey"], order)


@query
def dedupe_last(spark, d):
    rows = A.table(spark, d, "events").select("user_id", "event_id", "event_type")
    return sampling.dedupe(rows, ["user_id"], [F.col("event_id")], "last")


@query
def dedupe_critics(spark, d):
    kept = critics.dedupe_critics(A.critics_dups(spark, d), ["p_partkey"])
    return kept.select("p_partkey", "Title", "Platform", "url")


@query
def balanced_sample(spark, d):
    rated = completion.rated_rows(A.text_reviews(spark, d))
    return studies.text_sides(rated, 1.0, 10, minimum=10).select("review_id", "side")


@query
def sample_n(spark, d):
    return sampling.sample_n(A.plays(spark, d), ["review_id"], 500).select("review_id")


# --- statistics ------------------------------------------------------------------


def _processed(spark, d):
    return cohorts.add_cohort(cohorts.processed(A.plays(spark, d)))


@query
def cohort_shares(spark, d):
    return rounded(cohorts.cohort_shares(cohorts.processed(A.plays(spark, d))), "share")


@query
def cohort_free_share(spark, d):
    shares = rounded(cohorts.free_share(_processed(spark, d)), "free_share")
    return shares.withColumn("cohort_order", whole(F.col("cohort_order")))


@query
def helpful_votes(spark, d):
    means = rounded(cohorts.trimmed_means(_processed(spark, d)), "raw_mean", "trimmed_mean")
    return means.withColumn("cohort_order", whole(F.col("cohort_order")))


@query
def box_stats(spark, d):
    rows = cohorts.add_cohort(cohorts.processed(A.text_reviews(spark, d)))
    box = rounded(cohorts.length_box(rows), "q1", "median", "q3", "whisker_low", "whisker_high")
    return box.withColumns({"cohort_order": whole(F.col("cohort_order")), "n": whole(F.col("n"))})


@query
def item_quartiles(spark, d):
    rows = quantiles.exact_quantiles(A.plays(spark, d), "playtime_minutes", [0.25, 0.5, 0.99], ["app_id"])
    return rounded(rows, "quantile")


@query
def playtime_density(spark, d):
    rows = cohorts.cohort_flags(A.plays(spark, d)).select("review_id", "playtime_review_hours")
    curve = cohorts.density(rows, "playtime_review_hours", "review_id")
    return rounded(curve, "at", "density").withColumn("step", whole(F.col("step")))


@query
def consensus_scores(spark, d):
    return rounded(consensus.consensus(A.ratings(spark, d)), "steam_consensus")


@query
def status_counts(spark, d):
    return consensus.value_counts(A.plays(spark, d), "fetch_status")


@query
def stage_report(spark, d):
    rows = A.plays(spark, d)
    report = consensus.stage_report(rows, completion.completion_stages())
    report = rounded(report, "pct_kept").withColumn("step", whole(F.col("step")))
    surplus = consensus.duplicate_count(rows, "rater_id")
    extra = surplus.select(
        F.lit(9).cast("bigint").alias("step"), F.lit("duplicate raters").alias("stage"), "rows",
        F.col("duplicates").alias("dropped"), F.lit(None).cast("double").alias("pct_kept"),
    )
    return report.unionByName(extra)


@query
def modal_name(spark, d):
    return consensus.mode_value(A.plays(spark, d), "app_name")


@query
def rate_by_band(spark, d):
    rated = completion.rated_rows(A.text_reviews(spark, d))
    bands = rounded(completion.rate_by_band(rated), "rate", "se", "low", "high")
    return bands.withColumn("band", whole(F.col("band")))


def _theme_balance(spark, d, rating):
    rated = completion.rated_rows(A.text_reviews(spark, d)).filter(F.col("rating") == rating)
    grid = rounded(completion.theme_balance(rated, A.THEME_ONE, A.THEME_TWO), "balance")
    return grid.withColumns({name: whole(F.col(name)) for name in ("playtime_order", "completion_order")})


@query
def theme_balance_pos(spark, d):
    return _theme_balance(spark, d, 1.0)


@query
def theme_balance_neg(spark, d):
    return _theme_balance(spark, d, 0.0)


# --- critics ------------------------------------------------------------------------


@query
def json_records(spark, d):
    pages = critics.type_critics(A.critics(spark, d))
    fields = ["Title", "Platform", "Metascore", "NumberOfCriticReviews", "url"]
    return critics.to_json_records(pages, ["critic_id"], critics.critic_filter(), fields)


def _matched(spark, d):
    return studies.critic_study(A.ratings(spark, d), A.critics(spark, d), ["critic_id"])


@query
def consensus_delta(spark, d):
    matched = rounded(_matched(spark, d), "steam_consensus", "Metascore_Normalized", "delta")
    return matched.select("app_id", "app_name", "Title", "steam_consensus", "Metascore_Normalized", "delta")


@query
def sorted_baseline(spark, d):
    rows = critics.with_row_position(consensus.sorted_baseline(A.ratings(spark, d)), ["app_name", "app_id"])
    return rounded(rows, "steam_consensus").withColumn("position", whole(F.col("position")))


@query
def critic_page_fields(spark, d):
    return critics.extract_page_fields(A.critic_pages(spark, d)).select(
        "page_id", "Title", whole(F.col("Metascore")).alias("Metascore"),
        whole(F.col("NumberOfCriticReviews")).alias("NumberOfCriticReviews"))


@query
def outlier_share(spark, d):
    items = consensus.consensus(A.ratings(spark, d))
    matched = critics.add_delta(critics.match_titles(items, critics.clean_critics(A.critics(spark, d))))
    return rounded(consensus.outlier_share(matched), "outlier_pct")


@query
def delta_tails(spark, d):
    tails = rounded(critics.both_tails(_matched(spark, d)), "delta")
    return tails.select("app_id", "app_name", "delta")


@query
def title_preview(spark, d):
    clean_pages = critics.dedupe_critics(A.critics_dups(spark, d), ["p_partkey"])
    return critics.preview_sorted(clean_pages, ["p_partkey"]).select("stage", "p_partkey", "Title", "Platform")


# --- text and themes ------------------------------------------------------------------


@query
def tfidf(spark, d):
    return rounded(text.tfidf(_clean_docs(spark, d), "doc_id", text.clean_tokens("text")), "weight")


@query
def tfidf_diff_pos(spark, d):
    rated = completion.rated_rows(A.text_reviews(spark, d))
    terms = studies.distinctive_terms(rated, 1.0, 10, minimum=10)
    return terms.withColumn("rank", whole(F.col("rank")))


@query
def tfidf_diff_neg(spark, d):
    rated = completion.rated_rows(A.text_reviews(spark, d))
    terms = studies.distinctive_terms(rated, 0.0, 20, minimum=10)
    return terms.withColumn("rank", whole(F.col("rank")))


@query
def encode_text(spark, d):
    docs = A.table(spark, d, "documents").select("doc_id", F.col("text").alias("review"))
    coded = themes.encode_text(docs)
    return elements(coded, ["doc_id"], "embedding", 4).filter("value <> 0")


@query
def encode_latent(spark, d):
    docs = A.table(spark, d, "documents").select("doc_id", F.col("text").alias("review"))
    # one zero, not two
    return elements(themes.encode_text(docs, latent=4), ["doc_id"], "embedding", 4).withColumn("value", F.col("value") + 0.0)


@query
def centroids(spark, d):
    means = vectors.vector_mean(A.member_vectors(spark, d), ["app_id", "sentiment"], "embedding")
    return elements(means, ["app_id", "sentiment"], "mean")


@query
def grouped_kmeans(spark, d):
    found, _ = themes.fit_kmeans(A.member_vectors(spark, d), ["app_id", "sentiment"], "vec_id")
    return found.select("app_id", "sentiment", "vec_id", whole(F.col("cluster")).alias("cluster"))


@query
def representatives(spark, d):
    return A.clusters(spark, d).drop("embedding", "app_name").withColumn("cluster", whole(F.col("cluster")))


@query
def cluster_shares(spark, d):
    shares = themes.cluster_shares(A.clustered_members(spark, d), by=["app_id", "sentiment"])
    return rounded(shares, "share").withColumn("cluster", whole(F.col("cluster")))


@query
def cluster_terms(spark, d):
    rows = themes.cluster_terms(A.clustered_members(spark, d), ["app_id", "sentiment"], "vec_id")
    return rows.withColumn("cluster", whole(F.col("cluster")))


@query
def describe_clusters(spark, d):
    rows = themes.cluster_terms(A.clustered_members(spark, d), ["app_id", "sentiment"], "vec_id")
    labels = themes.describe_clusters(rows, ["app_id", "sentiment"])
    return labels.withColumn("cluster", whole(F.col("cluster")))


@query
def pca_2d(spark, d):
    rows = pca.pca_2d(A.member_vectors(spark, d), "vec_id", by=["sentiment"])
    return rounded(rows, "pc1", "pc2", digits=4)


# --- profiles and search ---------------------------------------------------------------


def _text_sample(spark, d):
    return studies.profile_sample(A.text_reviews(spark, d), k=10)


@query
def item_profiles(spark, d):
    rows = consensus.item_profiles(consensus.item_counts(A.text_reviews(spark, d)), _text_sample(spark, d))
    return rounded(rows, "recommendation_rate").withColumns(
        {name: whole(F.col(name)) for name in ("sampled_negative", "sampled_positive")}
    )


@query
def run_manifest(spark, d):
    rows = consensus.item_profiles(consensus.item_counts(A.text_reviews(spark, d)), _text_sample(spark, d))
    summary = consensus.run_manifest(rows, A.clusters(spark, d), source="documents")
    return summary.withColumn("random_seed", whole(F.col("random_seed")))


SEARCH_RATE = 60.0


def _search(spark, d):
    return A.items(spark, d), A.clusters(spark, d), A.query_vector(spark, d, 0), A.query_vector(spark, d, 1)


@query
def rank_items(spark, d):
    items, clusters, wanted, _ = _search(spark, d)
    best = recommend.rank_items(items, clusters, wanted, min_rate=SEARCH_RATE)
    best = best.select("rank", "app_id", "app_name", "recommendation_rate", "wanted_similarity",
                       "match_pct", "positive_review", "negative_review")
    return rounded(best, "recommendation_rate").withColumn("rank", whole(F.col("rank")))


@query
def rank_items_avoid(spark, d):
    items, clusters, wanted, avoid = _search(spark, d)
    best = recommend.rank_items(items, clusters, wanted, avoid, min_rate=SEARCH_RATE)
    best = best.select("rank", "app_id", "wanted_similarity", "avoid_similarity", "rank_score")
    return rounded(best, "rank_score").withColumn("rank", whole(F.col("rank")))


@query
def moved_down(spark, d):
    items, clusters, wanted, avoid = _search(spark, d)
    return recommend.moved_down(items, clusters, wanted, avoid, min_rate=SEARCH_RATE, n=3)


def _requests(spark, d):
    """Every tenth embedding as a request; each avoids the vector after it, those divisible by 30 avoid nothing."""
    rows = A.table(spark, d, "embeddings")
    wanted = rows.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("request_id"), F.col("embedding").alias("wanted"))
    avoid = rows.select((F.col("vec_id") - 1).alias("request_id"), F.col("embedding").alias("avoid"))
    return wanted.join(avoid.filter("request_id % 30 <> 0"), "request_id", "left")


@query
def rank_items_batch(spark, d):
    items, clusters = A.items(spark, d), A.clusters(spark, d)
    best = recommend.rank_items_batch(items, clusters, _requests(spark, d), min_rate=SEARCH_RATE)
    best = best.select("request_id", "rank", "app_id", "app_name", "wanted_similarity", "avoid_similarity", "rank_score",
                       "positive_review", "negative_review")
    return rounded(best, "rank_score").withColumn("rank", whole(F.col("rank")))


@query
def random_pick(spark, d):
    items, clusters, _, _ = _search(spark, d)
    return rounded(recommend.random_pick(items, clusters, min_rate=SEARCH_RATE), "recommendation_rate")


# --- streams ------------------------------------------------------------------------------


def _event_stream(spark, d):
    return A.as_plays(incremental.open_stream(spark, f"{d.rstrip('/')}/events.parquet"))


@query
def stream_item_counts(spark, d):
    counts = incremental.stream_item_counts(_event_stream(spark, d), shared_path(spark, "item-counts"))
    return rounded(counts, "recommendation_rate")


@query
def stream_hash_sample(spark, d):
    sample = incremental.stream_hash_sample(_event_stream(spark, d), shared_path(spark, "sample"), k=10)
    return sample.select("review_id", "app_id", "recommended")


@query
def stream_resume(spark, d):
    answers = A.as_responses(_event_stream(spark, d))
    results = incremental.stream_resume(answers, shared_path(spark, "results"), [F.col("http_status")], leave_out=["body"])
    return results.select("review_id", "fetch_status", whole(F.col("achievements_unlocked")).alias("achievements_unlocked"))


# --- complete studies ------------------------------------------------------------------------


@query
def cohort_study(spark, d):
    rows = rounded(studies.cohort_summary(A.plays(spark, d)), "share", "free_share", "raw_mean", "trimmed_mean",
                   "q1", "median", "q3", "whisker_low", "whisker_high")
    return rows.withColumns({"cohort_order": whole(F.col("cohort_order")), "n": whole(F.col("n"))})


@query
def cohort_study_curve(spark, d):
    curve = studies.cohort_study(A.plays(spark, d))["density"]
    return rounded(curve, "at", "density").withColumn("step", whole(F.col("step")))


@query
def enrichment_study(spark, d):
    answers = A.responses(spark, d).withColumn("attempt", F.lit(1))
    # a third of the answers was classified by an earlier run, and some users are listed twice
    finished = joins.classify_responses(answers.filter("review_id % 3 = 0"))
    states = A.states(spark, d)
    rows = studies.enrichment(
        A.plays(spark, d).drop("fetch_status", "achievements_unlocked", "total_achievements"),
        states.unionByName(states.filter("rater_id % 2 = 0")), answers, ["attempt"], users=20, finished=finished,
    )
    return rows.select(
        "review_id", "app_id", "fetch_status",
        whole(F.col("achievements_unlocked")).alias("achievements_unlocked"),
        whole(F.col("total_achievements")).alias("total_achievements"),
    )


@query
def completion_study(spark, d):
    lists = (A.THEME_ONE, A.THEME_TWO)
    parts = studies.completion_study(
        A.text_reviews(spark, d), [F.col("ts")], lists, lists, minimum=10
    )
    tall = [
        parts["rate"].select(F.lit("rate").alias("part"), F.col("label").alias("item"), F.col("rate").alias("value")),
        *[
            parts[f"{side}_themes"].select(
                F.lit(f"{side}_themes").alias("part"),
                F.concat_ws(" / ", "playtime_group", "completion_group").alias("item"),
                F.col("balance").alias("value"),
            )
            for side in ("positive", "negative")
        ],
        *[
            parts[f"{side}_terms"].select(
                F.concat_ws("_", F.lit(side), "side").alias("part"), F.col("term").alias("item"),
                F.col("score").alias("value"),
            )
            for side in ("positive", "negative")
        ],
    ]
    rows = tall[0]
    for part in tall[1:]:
        rows = rows.unionByName(part)
    return rounded(rows, "value")


@query
def critic_study(spark, d):
    rows = _matched(spark, d).select(
        "app_id", "app_name", "total_reviews", "total_positive", "steam_consensus", "Title", "Metascore", "delta")
    return rounded(rows, "steam_consensus", "delta")


def letter_counts(texts: Column) -> Column:
    """A plain encoder: how often each letter of a-z occurs."""
    lowered = F.lower(texts)
    letters = [chr(code) for code in range(ord("a"), ord("z") + 1)]
    counts = [F.length(lowered) - F.length(F.replace(lowered, F.lit(x), F.lit(""))) for x in letters]
    return F.array(*counts).cast("array<double>")


@query
def item_profile_study(spark, d):
    items, clusters = studies.item_profiles(
        A.text_reviews(spark, d), k=10, encoder=letter_counts
    )
    sized = items.select("app_id", "review_count", whole(F.col("sampled_positive")).alias("sampled_positive"))
    themes_only = clusters.drop("embedding").withColumn("cluster", whole(F.col("cluster")))
    return themes_only.join(sized, "app_id")


@query
def item_search(spark, d):
    items, clusters, wanted, avoid = _search(spark, d)
    rows = studies.item_search(items, clusters, wanted, avoid, SEARCH_RATE, 3)
    return rows.select("app_id", "app_name", whole(F.col("rank")).alias("rank"), "match_pct", "positive_review")


@query
def theme_map(spark, d):
    rows = studies.theme_map(A.text_reviews(spark, d), "src1")
    return rounded(rows, "share", "pc1", "pc2", digits=3)


@query
def theme_map_labels(spark, d):
    rows = studies.theme_map(A.text_reviews(spark, d), "src1", encoder=letter_counts)
    rows = rounded(rows.drop("pc1", "pc2"), "share")
    return rows.withColumn("cluster", whole(F.col("cluster")))
