"""Views of the driver's tables in the shape of review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens import constants as K
from reviewlens.functions.vectors import unit_vector, vector_mean
from reviewlens.operators.themes import representatives
from reviewlens.session import spread

# page fields of the test pages: field -> (pattern, type)
TEST_PAGE_FIELDS = {
    "Title": (r"(?s)<title>(.*?)</title>", "string"),
    "Metascore": (r"track\((\d+)\)", "int"),
    "NumberOfCriticReviews": (r"ad (\d+)", "int"),
}
THEME_ONE = ["ther", "thon", "thre", "thing"]
THEME_TWO = ["tion", "eren", "anea", "thou"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages") else rows


def as_plays(events: DataFrame) -> DataFrame:
    """One rating per event; row-wise, so it also takes a stream."""
    return events.selectExpr(
        "event_id AS review_id",
        "user_id AS app_id",
        "event_id % 500 AS rater_id",
        "ts",
        "event_type IN ('signup', 'purchase', 'view') AS recommended",
        "value * 30 AS playtime_minutes",
        "event_id % 7 = 0 AS received_for_free",
        "CAST(floor(value) AS DOUBLE) AS votes_helpful",
        "CASE WHEN event_id % 11 = 0 THEN 'Private_or_NotOwned' "
        "WHEN event_id % 13 = 0 THEN 'No_Stats' ELSE 'Success' END AS fetch_status",
        "CAST(regexp_replace(props, '[^0-9]+', '') AS DOUBLE) AS achievements_unlocked",
        "CAST(100 AS DOUBLE) AS total_achievements",
        "concat('item ', user_id) AS app_name",
        "concat_ws(' ', event_type, 'rated', event_id, props) AS review",
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_plays(table(spark, sf_dir, "events"))


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = plays(spark, sf_dir).drop("app_id", "app_name", "review")
    docs = table(spark, sf_dir, "documents")
    joined = docs.join(rated, docs["doc_id"] == rated["review_id"])
    return joined.selectExpr(
        "review_id", "source AS app_id", "source AS app_name", "rater_id", "ts", "text AS review", "lang",
        "recommended", "playtime_minutes", "received_for_free", "votes_helpful", "fetch_status",
        "achievements_unlocked", "total_achievements",
        "achievements_unlocked / total_achievements * 100 AS completion_percentage",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    names = table(spark, sf_dir, "supplier")
    return lines.join(names, lines["l_suppkey"] == names["s_suppkey"]).selectExpr(
        "l_orderkey * 10 + l_linenumber AS review_id", "l_suppkey AS app_id", "s_name AS app_name",
        "l_returnflag <> 'R' AS recommended",
    )


def critics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS critic_id",
        "concat(upper(s_name), '™') AS Title", "'PC' AS Platform",
        "CAST(floor((s_acctbal + 1000) / 110) AS DOUBLE) AS Metascore",
        "CAST(s_suppkey % 12 AS INT) AS NumberOfCriticReviews",
        "concat('https://critics.example/', s_suppkey) AS url",
    )


def critic_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the default markup: scores that are numbers, missing, ``tbd`` or outside their block, tagged counts."""
    title = "concat('<div class=\"c subpage-header__navigation d\"> <b>Page &amp; ', page_id, '</b> &#46;</div>')"
    score = (
        "CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN '<div class=\"score-card-left__score-number\"><p><span>tbd</span></p></div>' "
        "ELSE concat('<div class=\"x score-card-left__score-number\"><p><span title=\"s\"> ', page_id % 101, ' </span></p></div>') END"
    )
    count = (
        "CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('<div class=\"count\">Showing <b>', page_id % 57, "
        "'</b> Critic Reviews</div>') ELSE concat('<div class=\"count\">Showing ', page_id % 57, ' Critic Reviews</div>') END"
    )
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", f"concat({title}, {score}, '<div><span>77</span></div>', {count}, coalesce(html, '')) AS html")


def critics_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name AS Title", "p_type AS Platform", "p_retailprice / 25 AS Metascore",
        "concat('u/', p_partkey % 100) AS url",
    )


def member_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    docs = table(spark, sf_dir, "documents")
    return vectors.join(docs, vectors["vec_id"] == docs["doc_id"]).selectExpr(
        "vec_id", "label AS app_id", "concat('item ', label) AS app_name",
        "CASE WHEN vec_id % 3 <> 0 THEN 'positive' ELSE 'negative' END AS sentiment",
        "text AS review", "embedding",
    )


def as_responses(rated: DataFrame) -> DataFrame:
    """Stored service answers, one per rating; row-wise, so it also takes a stream."""
    return rated.selectExpr(
        "review_id", "app_id",
        "CASE WHEN review_id % 11 = 0 THEN 403 WHEN review_id % 13 = 0 THEN 500 ELSE 200 END AS http_status",
        "CASE WHEN review_id % 17 = 0 THEN 'not json' "
        "WHEN review_id % 19 = 0 THEN '{\"playerstats\":{}}' "
        "ELSE concat('{\"playerstats\":{\"achievements\":[', "
        "repeat('{\"achieved\":1},', CAST(achievements_unlocked AS INT) % 10), "
        "'{\"achieved\":0}]}}') END AS body",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_responses(plays(spark, sf_dir))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile states of users; users the table lacks stay unknown."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS rater_id", "CAST(c_nationkey % 4 AS INT) AS state"
    )


def clustered_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member vectors with a given cluster number and its unit center."""
    members = member_vectors(spark, sf_dir).withColumn("cluster", (F.col("vec_id") % 4).cast("int"))
    by = ["app_id", "sentiment", "cluster"]
    centers = vector_mean(members, by, "embedding", "_mean").select(
        *by, unit_vector("_mean").alias("center")
    )
    return members.join(centers, by)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return representatives(clustered_members(spark, sf_dir), ["app_id", "sentiment"], "vec_id")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item table over the member vectors' items."""
    liked = (F.col("sentiment") == "positive").cast("int")
    return member_vectors(spark, sf_dir).groupBy("app_id", "app_name").agg(
        F.count(F.lit(1)).alias("review_count"), (F.avg(liked) * 100).alias("recommendation_rate")
    )


def query_vector(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    """Embedding of one row, the way a search request arrives: as a plain vector."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id)
    return list(rows.select("embedding").first()[0])
