"""Opinion themes: text vectors, grouped k-means, labels and 2-D maps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import CountVectorizerModel, IDF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import flatten_text
from reviewlens.functions.vectors import dot, unit_vector
from reviewlens.operators.kmeans import fit_kmeans
from reviewlens.operators.latent import in_latent_space, latent_axes
from reviewlens.operators.text import raw_tokens, tfidf
from reviewlens.session import materialize


def encode_text(
    df: DataFrame, text: str = "review", name: str = "embedding",
    encoder: Callable[[Column], Column] | None = None, size: int = 384, latent: int | None = None,
) -> DataFrame:
    """Unit vector per text.

    ``encoder`` turns the text column into a vector column, for example an
    iterator ``pandas_udf`` that loads a model once per worker. The default
    hashes words and weighs them by inverse document frequency. With ``latent``
    these vectors are seen along that many latent axes of all texts, so texts
    without a common word are near if their words go with the same others.
    """
    if encoder is not None:
        coded = df.withColumn(name, encoder(F.col(text)))
        return coded.withColumn(name, unit_vector(name).cast("array<float>"))
    # a word's place follows from its md5, so any other tool can compute the same vectors
    place = lambda word: F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("int") % size
    words = df.withColumn("_words", F.transform(raw_tokens(text), lambda word: place(word).cast("string")))
    words = words.withColumn("_words", F.coalesce("_words", F.array().cast("array<string>")))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], "_words", "_counts")
    # texts are read once, counts for the frequencies and for the weights
    counts = materialize(counter.transform(words).drop("_words"))
    weighted = IDF(inputCol="_counts", outputCol="_weights").fit(counts).transform(counts)
    scaled = Normalizer(inputCol="_weights", outputCol="_unit").transform(weighted)
    coded = scaled.withColumn(name, vector_to_array("_unit", "float32")).drop("_counts", "_weights", "_unit")
    return coded if latent is None else in_latent_space(coded, name, latent_axes(coded, name, latent))


def grouped_kmeans(df: DataFrame, by: Sequence[str], key: str, vector: str = "embedding", **options) -> DataFrame:
    """Members of ``fit_kmeans`` with their center beside them: (``by``…, key, ``cluster``, ``center``)."""
    members, centers = fit_kmeans(df, by, key, vector, **options)
    return members.join(centers, [*by, "cluster"])


def representatives(
    members: DataFrame, by: Sequence[str], key: str, text: str = "review",
    vector: str = "embedding", center: str = "center", name: str = "app_name",
) -> DataFrame:
    """Per cluster: size, center, and the member text closest to the center."""
    score = F.round(dot(F.col(vector), F.col(center)), 9)
    closest = F.struct((-score).alias("score"), F.col(key))
    extra = []
    if name in members.columns and name not in by:
        extra = [F.min_by(name, F.when(F.col(name).isNotNull(), F.col(key))).alias(name)]
    return members.groupBy(*by, "cluster").agg(
        *extra,
        F.count(F.lit(1)).alias("sample_count"),
        flatten_text(F.min_by(text, closest)).alias("representative_review"),
        F.any_value(F.col(center).cast("array<float>")).alias("embedding"),
    )


def cluster_shares(assigned: DataFrame, k: int = K.CLUSTERS_PER_SENTIMENT, by: Sequence[str] = ()) -> DataFrame:
    """Members and share in percent of all k clusters of a group, empty ones too."""
    counts = [F.count_if(F.col("cluster") == i).alias(f"_{i}") for i in range(k)]
    entries = [
        F.struct(
            F.lit(i).alias("cluster"), F.col(f"_{i}").alias("n"),
            (F.try_divide(F.col(f"_{i}"), F.col("_all")) * 100).alias("share"),
        )
        for i in range(k)
    ]
    sums = assigned.groupBy(*by).agg(F.count(F.lit(1)).alias("_all"), *counts)
    return sums.select(*by, F.explode(F.array(*entries)).alias("row")).select(*by, "row.*")


def cluster_terms(
    members: DataFrame, by: Sequence[str], key: str, text: str = "review",
    k: int = K.CLUSTERS_PER_SENTIMENT, stop_words: Sequence[str] | None = None,
    max_features: int = K.LABEL_MAX_FEATURES,
) -> DataFrame:
    """Every term's mean weight inside a cluster minus its mean outside.

    Each group is a corpus of its own, without English stop words; words of the
    domain stay, so that no pair of words skips one. With a single cluster
    nothing is outside, which counts as zero.
    """
    by = list(by)
    weights = tfidf(
        members, key, raw_tokens(text), by=by, carry=["cluster"],
        stop_words=K.ENGLISH_STOP_WORDS if stop_words is None else stop_words,
        min_documents=K.LABEL_MIN_DOCUMENTS, max_share=K.LABEL_MAX_SHARE,
        max_features=max_features, sublinear=False,
    )
    sums = weights.groupBy(*by, "term").agg(
        F.sum("weight").alias("_all"),
        *[F.sum(F.when(F.col("cluster") == i, F.col("weight")).otherwise(0.0)).alias(f"_w{i}") for i in range(k)],
    )
    counts = [F.count(F.lit(1)).alias("_docs")]
    counts += [F.count_if(F.col("cluster") == i).alias(f"_n{i}") for i in range(k)]
    if by:
        joined = sums.join(members.groupBy(*by).agg(*counts), by)
    else:
        joined = sums.withColumn("_sizes", members.agg(F.struct(*counts)).scalar()).select("*", "_sizes.*")
    entries = []
    for i in range(k):
        inside, size = F.col(f"_w{i}"), F.col(f"_n{i}")
        outside = F.coalesce(F.try_divide(F.col("_all") - inside, F.col("_docs") - size), F.lit(0.0))
        score = F.round(inside / F.when(size > 0, size) - outside, 9)
        entries.append(F.struct(F.lit(i).alias("cluster"), score.alias("score")))
    scored = joined.select(*by, "term", F.explode(F.array(*entries)).alias("row"))
    return scored.select(*by, "row.cluster", "term", "row.score").filter(F.col("score").isNotNull())


def describe_clusters(
    terms: DataFrame, by: Sequence[str], banned: Sequence[str] = tuple(K.LABEL_STOP_WORDS),
    banned_column: str | None = None, n: int = K.LABEL_TERMS,
) -> DataFrame:
    """Label per cluster: its best terms, none inside another, joined by commas.

    Terms with a banned word or a digit are passed over. ``banned_column`` may
    hold more banned words per row, such as those of the item's own title.
    Each of the ``n`` terms is the best one left that fits those before it, one
    aggregate after the other, so a vocabulary of any size meets in no task.
    """
    by = list(by)
    blocked = F.array(*[F.lit(word) for word in banned])
    if banned_column:
        blocked = F.concat(blocked, F.coalesce(F.col(banned_column), F.array().cast("array<string>")))
    usable = ~F.arrays_overlap(F.split("term", " "), blocked) & ~F.col("term").rlike(r"\p{Nd}")
    keys = [*by, "cluster"]
    rows = materialize(terms.select(*keys, "term", "score", usable.alias("_usable")))
    chosen = rows.select(*keys).distinct().withColumn("_chosen", F.array().cast("array<string>"))
    clash = F.exists("_chosen", lambda c: F.contains(c, F.col("term")) | F.contains(F.col("term"), c))
    for _ in range(n):
        fitting = rows.filter("_usable").join(chosen, keys).filter(~clash)
        best = fitting.groupBy(*keys).agg(F.min(F.struct((-F.col("score")).alias("minus"), "term"))["term"].alias("_next"))
        more = F.when(F.col("_next").isNull(), F.col("_chosen")).otherwise(F.array_append("_chosen", F.col("_next")))
        chosen = chosen.join(best, keys, "left").select(*keys, more.alias("_chosen"))
    label = F.when(F.size("_chosen") > 0, F.array_join("_chosen", ", ")).otherwise(K.LABEL_FALLBACK)
    return chosen.select(*keys, label.alias("description"))


def map_centers(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Middle of each cluster on the 2-D map."""
    return points.groupBy(*by).agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"))
