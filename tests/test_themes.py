import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlens.functions import vectors
from reviewlens.operators import blocks, kmeans, latent, pca, text, themes


def brute_starts(points, k, r, seed=42):
    """Starts of one restart, one race after the other."""
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    chosen = []
    for j in range(k):
        d = digest(f"{seed}|{r}|{j}")
        factor, shift = int(d[:8], 16) % (2**31 - 2) + 1, int(d[8:16], 16) % (2**31 - 1)

        def arrival(i):
            h = int(digest(f"{i}|{seed}")[:8], 16) % (2**31 - 1)
            lead = -math.log(((h * factor + shift) % (2**31 - 1) + 1) / 2**31)
            if chosen:
                gap = min(sum((a - b) ** 2 for a, b in zip(points[i], c)) for c in chosen)
                lead = lead / gap if gap > 0 else math.inf
            return lead, h, i
        chosen.append(points[min(points, key=arrival)])
    return chosen


def brute_kmeans(points, k, restarts, iterations, seed=42):
    """Labels and centers of {id: vector} with the same starts, comparing all points with all centers in every round."""
    ids, x = list(points), np.array(list(points.values()))
    best = None
    for r in range(restarts):
        centers = {c: np.array(v) for c, v in enumerate(brute_starts(points, k, r, seed))}
        def label():
            names = sorted(centers)
            gaps = np.stack([((x - centers[c]) ** 2).sum(axis=1) for c in names])
            return np.array(names)[gaps.argmin(axis=0)], gaps.min(axis=0).sum()
        for _ in range(iterations):
            labels, _ = label()
            centers = {c: x[labels == c].mean(axis=0) for c in sorted(set(labels))}
        labels, inertia = label()
        if best is None or round(inertia, 6) < best[0]:
            best = (round(inertia, 6), dict(zip(ids, labels.tolist())), centers)
    return best[1], best[2]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    sizes = {"big": 60, "small": 3, "one": 1}
    rows, key = [], 0
    for name, size in sizes.items():
        for v in rng.normal(0, 1, (size, 5)):
            rows.append((name, key, [float(t) for t in v]))
            key += 1
    rows += [("same", key + i, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(6)]
    return rows, spark.createDataFrame(rows, "g string, id long, embedding array<double>")


@pytest.mark.parametrize("restarts,iterations,block", [(1, 3, 16384), (4, 100, 16384), (1, 3, 13), (3, 100, 13)])
def test_kmeans_equals_direct_loop(cloud, restarts, iterations, block, monkeypatch):
    # with small blocks the large group is worked on block by block
    monkeypatch.setattr(blocks, "POINTS", block)
    rows, df = cloud
    found = themes.grouped_kmeans(df, ["g"], "id", restarts=restarts, iterations=iterations).collect()
    assert len(found) == len(rows)
    for g in ("big", "small", "one", "same"):
        labels, centers = brute_kmeans({i: v for n, i, v in rows if n == g}, 4, restarts, iterations)
        for r in (r for r in found if r["g"] == g):
            assert r["cluster"] == labels[r["id"]]
            c = centers[r["cluster"]]
            assert r["center"] == pytest.approx(list(c / np.linalg.norm(c)))
    assert len({r["cluster"] for r in found if r["g"] == "same"}) == 1


def test_bounds_give_the_clusters_of_full_comparisons():
    rng = np.random.default_rng(8)
    for trial in range(20):
        middles = rng.normal(0, 6, (5, 4))
        x = np.concatenate([m + rng.normal(0, rng.uniform(0.1, 2), (80, 4)) for m in middles] + [np.repeat(middles, 3, axis=0)])
        hashes = rng.integers(0, kmeans.PRIME, len(x))
        centers = kmeans.starts_of(x, hashes, kmeans.race_factors(trial, 1, 6)[0])
        bounds, full, rounds = kmeans.Bounds(x, centers), kmeans.squared_distances(x, centers).argmin(axis=1), 0
        while True:
            assert (bounds.cluster == full).all()
            after = kmeans.means_of(x, full, len(centers))
            before, full = full, kmeans.squared_distances(x, after).argmin(axis=1)
            moved, rounds = bounds.move(centers, after), rounds + 1
            assert moved == (before != full).sum()
            centers = after
            if not moved:
                break
        # a point that stays far from other centers is not compared again
        assert bounds.compared < len(x) * (rounds + 1)


def test_starts_lie_apart():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.01, (100, 2)) for c in (0, 10, 20, 30)])
    apart = 0
    for seed in range(50):
        starts = kmeans.starts_of(x, rng.integers(0, kmeans.PRIME, len(x)), kmeans.race_factors(seed, 1, 4)[0])
        apart += len({round(s[0] / 10) for s in starts}) == 4
    assert apart >= 45


def test_kmeans_leaves_out_what_has_no_group_or_vector(spark):
    rows = [("a", 1, [1.0, 0.0]), ("a", 2, None), (None, 3, [1.0, 1.0]), ("b", 4, [0.0, 2.0])]
    members, centers = themes.fit_kmeans(spark.createDataFrame(rows, "g string, id long, embedding array<double>"), ["g"], "id")
    assert {tuple(r) for r in members.collect()} == {("a", 1, 0), ("b", 4, 0)}
    assert {(r["g"], r["cluster"], tuple(r["center"])) for r in centers.collect()} == {("a", 0, (1.0, 0.0)), ("b", 0, (0.0, 1.0))}


def test_more_rounds_never_raise_inertia(cloud):
    rows, df = cloud
    points = {i: np.array(v) for n, i, v in rows if n == "big"}
    inertia = []
    for rounds in (1, 2, 5):
        labels = {r["id"]: r["cluster"] for r in themes.grouped_kmeans(
            df.filter("g = 'big'"), ["g"], "id", restarts=1, iterations=rounds).collect()}
        total = 0.0
        for c in set(labels.values()):
            x = np.array([points[i] for i in points if labels[i] == c])
            total += ((x - x.mean(axis=0)) ** 2).sum()
        inertia.append(total)
    assert inertia == sorted(inertia, reverse=True)


def test_vector_expressions(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id int, v array<float>")
    found = df.select(vectors.unit_vector("v").alias("u"), vectors.dot("v", [1.0, 2.0]).alias("d")).collect()
    assert [list(r["u"]) for r in found] == [[0.6, 0.8], [0.0, 0.0]]
    assert [r["d"] for r in found] == [11.0, 0.0]
    assert vectors.vector_mean(df, [], "v").first()["mean"] == [1.5, 2.0]


def test_representatives(spark):
    rows = [("a", 1, 0, "near\nest ", [0.9, 0.1]), ("a", 2, 0, "far", [0.1, 0.9]), ("a", 3, 1, "x", [0.0, 1.0]), ("a", 4, 1, "y", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "g string, id int, cluster int, review string, embedding array<double>")
    df = df.withColumn("center", F.when(F.col("cluster") == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))))
    found = {r["cluster"]: r for r in themes.representatives(df, ["g"], "id").collect()}
    assert (found[0]["representative_review"], found[0]["sample_count"]) == ("near est", 2)
    assert found[1]["representative_review"] == "x"


def test_shares_include_empty_clusters(spark):
    df = spark.createDataFrame([(0,), (0,), (2,), (0,)], "cluster int")
    found = [(r["cluster"], r["n"], r["share"]) for r in themes.cluster_shares(df).orderBy("cluster").collect()]
    assert found == [(0, 3, 75), (1, 0, 0), (2, 1, 25), (3, 0, 0)]


@pytest.mark.parametrize("by", [["g"], []])
def test_cluster_terms(spark, by):
    rows = [(1, "g", 0, "red sun red"), (2, "g", 0, "red moon"), (3, "g", 1, "blue moon"), (4, "g", 1, "blue sun")]
    df = spark.createDataFrame(rows, "id int, g string, cluster int, review string")
    found = {(r["cluster"], r["term"]): r["score"] for r in themes.cluster_terms(df, by, "id", k=2).collect()}
    weights = text.tfidf(df, "id", text.raw_tokens("review"), carry=["cluster"], min_documents=2, max_share=0.9, sublinear=False).collect()
    for (cluster, term), score in found.items():
        inside = sum(r["weight"] for r in weights if r["term"] == term and r["cluster"] == cluster) / 2
        outside = sum(r["weight"] for r in weights if r["term"] == term and r["cluster"] != cluster) / 2
        assert score == pytest.approx(inside - outside, abs=1e-8)
    assert {t for _, t in found} == {"red", "sun", "moon", "blue"}


def test_label_terms_skip_no_word_of_the_domain(spark):
    rows = [(1, 0, "solid game story"), (2, 0, "solid game story"), (3, 1, "the other"), (4, 1, "x")]
    df = spark.createDataFrame(rows, "id int, cluster int, review string")
    found = {r["term"] for r in themes.cluster_terms(df, [], "id", k=2).collect()}
    assert {"solid game", "game story", "game"} <= found and "solid story" not in found


def test_labels(spark):
    terms = [
        (0, "sun", 0.9), (0, "sun dance", 0.8), (0, "su", 0.7), (0, "game world", 0.6), (0, "top 10", 0.5), (0, "moon", 0.4),
        (0, "hero", 0.3), (0, "late", 0.2), (1, "game", 0.9), (1, "x1", 0.1), (2, "b", 0.5), (2, "a", 0.5),
    ]
    df = spark.createDataFrame(terms, "cluster int, term string, score double").withColumn("own", F.array(F.lit("hero")))
    found = {r["cluster"]: r["description"] for r in themes.describe_clusters(df, []).collect()}
    assert found == {0: "sun, moon, hero", 1: "mixed reviews", 2: "a, b"}
    found = {r["cluster"]: r["description"] for r in themes.describe_clusters(df, [], banned_column="own").collect()}
    assert found[0] == "sun, moon, late"


@pytest.mark.parametrize("block", [16384, 12])
def test_grouped_pca(spark, block, monkeypatch):
    # with small blocks the larger groups' scatter matrices are added up from several tasks
    monkeypatch.setattr(blocks, "POINTS", block)
    rng = np.random.default_rng(2)
    groups = {"wide": rng.normal(0, [5, 3, 1], (60, 3)) + 100, "line": np.outer(np.arange(30.0), [1, 2, 2]) / 3,
              "one": np.ones((1, 3)), "same": np.full((25, 3), 0.1)}
    rows = [(g, f"{g}{i}", [float(t) for t in v], "kept") for g, x in groups.items() for i, v in enumerate(x)]
    rows += [("wide", "nothing", None, "kept"), (None, "no group", [1.0, 2.0, 3.0], "kept")]
    df = spark.createDataFrame(rows, "g string, id string, embedding array<double>, mean string").withColumn("axes", F.lit(1))
    found = {r["id"]: r for r in pca.pca_2d(df, "id", by=["g"], carry=["mean"]).collect()}
    assert len(found) == sum(map(len, groups.values()))
    for g, x in groups.items():
        places = np.array([[found[f"{g}{i}"][c] for c in ("pc1", "pc2")] for i in range(len(x))])
        if g in ("one", "same"):
            assert np.abs(places).max() < 1e-9
            continue
        centred = x - x.mean(axis=0)
        _, size, axes = np.linalg.svd(centred, full_matrices=False)
        axes = axes[:2] * np.sign(axes[:2][[0, 1], np.abs(axes[:2]).argmax(axis=1)])[:, None]
        axes[size[:2] < 1e-9] = 0
        assert np.allclose(places, centred @ axes.T, atol=1e-7)
    assert pca.pca_2d(df.limit(0), "id", by=["g"]).count() == 0


def test_pca_equals_svd(spark):
    x = np.random.default_rng(12).normal(0, [3, 2, 1, 0.5], (80, 4)) + 5
    df = spark.createDataFrame([(i, [float(t) for t in v]) for i, v in enumerate(x)], "id int, embedding array<double>")
    found = pca.pca_2d(df, "id").orderBy("id").collect()
    centred = x - x.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:2].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    places = centred @ axes
    assert np.allclose([[r["pc1"], r["pc2"]] for r in found], places, atol=1e-9)
    assert np.allclose(places.mean(axis=0), 0)


def test_labels_from_a_large_vocabulary(spark):
    # the best terms lie inside of each other, further ones come late
    rows = spark.range(200_000).selectExpr("0 AS cluster", "concat('term', lpad(CAST(id AS STRING), 6, '0')) AS term", "CAST(id AS DOUBLE) AS score")
    rows = rows.withColumn("term", F.translate("term", "0123456789", "abcdefghij"))
    nested = spark.createDataFrame([(0, "deep sea", 9e6), (0, "sea", 8e6), (0, "deep", 7e6), (1, "x2", 5.0)], "cluster int, term string, score double")
    found = themes.describe_clusters(rows.unionByName(nested), [])
    assert {r["cluster"]: r["description"] for r in found.collect()} == {0: "deep sea, termbjjjjj, termbjjjji", 1: "mixed reviews"}


def test_latent_axes_equal_singular_vectors(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(0, 1, (90, 6)) * [9, 7, 5, 3, 2, 1] @ np.linalg.qr(rng.normal(0, 1, (6, 6)))[0]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(t) for t in v]) for i, v in enumerate(x)] + [(100, None), (101, [0.0] * 6)], "id int, v array<float>").repartition(5)
    axes = latent.latent_axes(df, "v", 2, rounds=60)
    expected = np.linalg.svd(x.astype(np.float64), full_matrices=False)[2][:2].T
    assert np.allclose(np.abs((axes * expected).sum(axis=0)), 1, atol=1e-6) and np.allclose(axes.T @ axes, np.eye(2), atol=1e-9)
    seen = {r["id"]: r["v"] for r in latent.in_latent_space(df, "v", axes).collect()}
    places = x @ axes
    assert seen[100] is None and list(seen[101]) == [0, 0]
    assert np.allclose([seen[i] for i in range(90)], places / np.linalg.norm(places, axis=1, keepdims=True), atol=1e-5)
    assert latent.latent_axes(df.limit(0), "v", 2).shape == (0, 0)


def test_texts_without_a_common_word_can_be_near(spark):
    # two subjects, each with two words for everything that never stand in one text, but go with the same others
    rng = np.random.default_rng(6)
    subjects = [(["lift", "elevator"], [f"floor{i}" for i in range(12)]), (["movie", "film"], [f"scene{i}" for i in range(12)])]
    rows, key = [], 0
    for names, others in subjects:
        for name in names:
            for _ in range(60):
                rows.append((key, " ".join([name, *rng.choice(others, 4, replace=False)])))
                key += 1
    rows += [(1000 + i, name) for i, name in enumerate(["lift", "elevator", "movie", "film"])]
    df = spark.createDataFrame(rows, "id int, review string")
    cosine = lambda v, a, b: float(np.dot(v[a], v[b]))
    plain = {r["id"]: np.array(r["embedding"]) for r in themes.encode_text(df, size=2048).filter("id >= 1000").collect()}
    near = {r["id"]: np.array(r["embedding"]) for r in themes.encode_text(df, size=2048, latent=2).filter("id >= 1000").collect()}
    assert abs(cosine(plain, 1000, 1001)) < 0.01 and abs(cosine(plain, 1002, 1003)) < 0.01
    assert cosine(near, 1000, 1001) > 0.9 and cosine(near, 1002, 1003) > 0.9
    assert abs(cosine(near, 1000, 1002)) < 0.3 and abs(cosine(near, 1001, 1003)) < 0.3


def test_encode_text(spark):
    df = spark.createDataFrame([(1, "red sun"), (2, "red sun"), (3, "blue moon shines"), (4, "")], "id int, review string")
    found = {r["id"]: np.array(r["embedding"]) for r in themes.encode_text(df, size=64).collect()}
    assert np.allclose(found[1], found[2]) and np.linalg.norm(found[3]) == pytest.approx(1, abs=1e-6)
    assert np.all(found[4] == 0) and abs(found[1] @ found[3]) < 0.5

    @F.pandas_udf("array<float>")
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 0.0])

    coded = themes.encode_text(df, encoder=lengths).orderBy("id").collect()
    assert [list(r["embedding"]) for r in coded] == [[1, 0], [1, 0], [1, 0], [0, 0]]


def test_latent_places_leave_other_columns_in_the_jvm(spark):
    rows = spark.createDataFrame([(i, "long text " * 50, [float(i), 1.0, 0.0]) for i in range(2500)] + [(9999, None, None)],
                                 "id long, review string, v array<float>")
    axes = np.eye(3)[:, :2]
    seen = latent.in_latent_space(rows, "v", axes)
    # no operator that hands whole rows to Python
    assert "MapInArrow" not in seen._jdf.queryExecution().executedPlan().toString()
    found = {r["id"]: (r["review"], r["v"]) for r in seen.collect()}
    assert len(found) == 2501 and found[9999] == (None, None)
    for i in (0, 1, 1024, 2499):
        assert found[i][0] == "long text " * 50
        assert np.allclose(found[i][1], np.array([i, 1]) / np.hypot(i, 1), atol=1e-6)
