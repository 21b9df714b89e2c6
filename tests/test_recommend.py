import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import blocks, recommend


@pytest.fixture(scope="module")
def shelf(spark):
    rng = np.random.default_rng(21)
    items, clusters = [], []
    for i in range(40):
        items.append((i, f"item {i}", float(rng.integers(50, 100)), 100 + i))
        for c in range(8):
            if i == 7 and c < 4:
                continue
            v = rng.normal(0, 1, 6)
            v /= np.linalg.norm(v)
            words = "long readable text " * 6 if rng.random() < 0.6 else "short"
            clusters.append((i, f"item {i}", "positive" if c < 4 else "negative", c % 4, int(rng.integers(1, 50)), f"{words}{i}-{c}", [float(np.float32(t)) for t in v]))
    return (
        items, clusters,
        spark.createDataFrame(items, "app_id int, app_name string, recommendation_rate double, review_count int"),
        spark.createDataFrame(clusters, "app_id int, app_name string, sentiment string, cluster int, sample_count int, representative_review string, embedding array<float>"),
    )


WANTED = [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
AVOID = [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]


def brute(items, clusters, avoid=None, min_rate=70, pool=20):
    out = []
    for app, name, rate, n in items:
        pos = [c for c in clusters if c[0] == app and c[2] == "positive"]
        neg = [c for c in clusters if c[0] == app and c[2] == "negative"]
        if rate < min_rate or not pos:
            continue
        readable = [c for c in pos if len(c[5]) >= 90] or pos
        row = {
            "app_id": app, "rate": rate, "wanted": round(max(np.dot(c[6], WANTED) for c in pos), 9),
            "avoid": round(max(np.dot(c[6], AVOID) for c in neg), 9) if neg and avoid else 0.0,
            "positive": max(readable, key=lambda c: (round(np.dot(c[6], WANTED), 9), -c[3]))[5],
            "negative": max([c for c in neg if len(c[5]) >= 90] or neg, key=lambda c: (c[4], -c[3]))[5],
        }
        out.append(row)
    if avoid:
        out = sorted(out, key=lambda r: (-r["wanted"], r["app_id"]))[:pool]
        for key in ("wanted", "avoid"):
            low, high = min(r[key] for r in out), max(r[key] for r in out)
            for r in out:
                r["s" + key] = (r[key] - low) / (high - low) if high - low > 1e-9 else 0.0
        for r in out:
            r["score"] = r["swanted"] - 0.75 * r["savoid"]
    else:
        for r in out:
            r["score"] = r["wanted"]
    return sorted(out, key=lambda r: (-round(r["score"], 9), -r["rate"], r["app_id"]))


def test_random_pick_has_a_theme(spark):
    items = spark.createDataFrame([(i, f"i{i}", 90.0, 5) for i in range(9)], "app_id int, app_name string, recommendation_rate double, review_count int")
    rows = [(4, "i4", "positive", 0, 3, "fine"), (5, "i5", "negative", 0, 3, "bad")]
    clusters = spark.createDataFrame(rows, "app_id int, app_name string, sentiment string, cluster int, sample_count int, representative_review string")
    for seed in range(3):
        assert [r["app_id"] for r in recommend.random_pick(items, clusters, seed=seed).collect()] == [4]


def test_rank_items(shelf):
    items, clusters, item_df, cluster_df = shelf
    found = recommend.rank_items(item_df, cluster_df, WANTED, n=8).orderBy("rank").collect()
    expected = brute(items, clusters)[:8]
    assert [r["app_id"] for r in found] == [r["app_id"] for r in expected]
    assert [r["rank"] for r in found] == list(range(1, 9))
    for f, e in zip(found, expected):
        assert f["wanted_similarity"] == e["wanted"] and f["avoid_similarity"] == 0 and f["avoid_penalty"] == 0
        assert f["positive_review"] == e["positive"] and f["negative_review"] == e["negative"]
        assert f["match_pct"] == max(0, e["wanted"]) * 100


def test_avoid_reranks_the_pool(shelf):
    items, clusters, item_df, cluster_df = shelf
    found = recommend.rank_items(item_df, cluster_df, WANTED, AVOID, min_rate=0, n=30).orderBy("rank").collect()
    expected = brute(items, clusters, True, 0)
    assert [r["app_id"] for r in found] == [r["app_id"] for r in expected]
    assert [r["rank_score"] for r in found] == pytest.approx([r["score"] for r in expected])
    assert len(found) == 20


def test_moved_down(shelf):
    items, clusters, item_df, cluster_df = shelf
    found = {r["app_id"] for r in recommend.moved_down(item_df, cluster_df, WANTED, AVOID, 0, 5).collect()}
    final = [r["app_id"] for r in brute(items, clusters, True, 0)][:5]
    plain = [r["app_id"] for r in brute(items, clusters, None, 0)]
    by_wanted = sorted(brute(items, clusters, None, 0), key=lambda r: (-r["wanted"], r["app_id"]))[:5]
    assert found == {r["app_id"] for r in by_wanted} - set(final) and plain


def test_items_without_positive_themes_are_skipped(shelf):
    _, _, item_df, cluster_df = shelf
    found = recommend.score_items(item_df, cluster_df, WANTED, min_rate=0)
    assert found.filter(F.col("app_id") == 7).count() == 0 and found.count() == 39


def test_relative_scale(spark):
    two = recommend.relative_scale(spark.createDataFrame([(2.0,), (4.0,)], "v double"), "v", "s")
    assert sorted(r["s"] for r in two.collect()) == [0.0, 1.0]
    same = recommend.relative_scale(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", "s")
    assert [r["s"] for r in same.collect()] == [0.0, 0.0]


def test_random_pick(shelf):
    items, clusters, item_df, cluster_df = shelf
    picks = {seed: recommend.random_pick(item_df, cluster_df, seed).collect() for seed in (1, 2, 3, 1)}
    for rows in picks.values():
        row = rows[0]
        assert len(rows) == 1 and row["recommendation_rate"] >= 70
        own = [c for c in clusters if c[0] == row["app_id"]]
        liked = [c[5] for c in own if c[2] == "positive"]
        assert row["positive_review"] in ([t for t in liked if len(t) >= 90] or liked)
    nobody = recommend.random_pick(item_df, cluster_df.filter("sentiment = 'positive'"), 1).first()
    assert nobody["negative_review"] == ""


def test_relative_scale_of_any_number_of_rows(spark):
    rows = spark.createDataFrame([(2.0,), (4.0,), (3.0,), (None,)], "v double")
    spread = recommend.relative_scale(rows, "v", "s", bounded=False)
    assert "SinglePartition" not in spread._jdf.queryExecution().optimizedPlan().toString()
    assert {r["v"]: r["s"] for r in spread.collect() if r["v"]} == {2.0: 0.0, 3.0: 0.5, 4.0: 1.0}


@pytest.mark.parametrize("block", [5, 2048])
def test_batch_equals_single_searches(spark, shelf, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK", block)
    _, _, item_df, cluster_df = shelf
    rng = np.random.default_rng(5)
    asked = []
    for i in range(12):
        wanted, avoid = rng.normal(0, 1, (2, 6)).tolist()
        asked.append((f"r{i}", wanted, avoid if i % 3 else None))
    requests = spark.createDataFrame([*asked, ("none", None, [1.0] * 6), (None, [1.0] * 6, None)], "request_id string, wanted array<double>, avoid array<double>")
    found = recommend.rank_items_batch(item_df, cluster_df, requests, n=7)
    rows = {}
    for r in found.orderBy("request_id", "rank").collect():
        rows.setdefault(r["request_id"], []).append(r)
    assert set(rows) == {name for name, _, _ in asked}
    columns = ["rank", "app_id", "app_name", "recommendation_rate", "review_count", "wanted_similarity", "avoid_similarity", "match_pct", "positive_review", "negative_review"]
    for name, wanted, avoid in asked:
        single = recommend.rank_items(item_df, cluster_df, wanted, avoid, n=7).orderBy("rank").collect()
        assert [[r[c] for c in columns] for r in rows[name]] == [[r[c] for c in columns] for r in single]
        assert [r["rank_score"] for r in rows[name]] == pytest.approx([r["rank_score"] for r in single])


def test_batch_without_requests_or_themes(spark, shelf):
    _, _, item_df, cluster_df = shelf
    requests = spark.createDataFrame([("a", [1.0] * 6, None)], "request_id string, wanted array<double>, avoid array<double>")
    assert recommend.rank_items_batch(item_df, cluster_df, requests.limit(0)).count() == 0
    assert recommend.rank_items_batch(item_df, cluster_df.filter("sentiment = 'negative'"), requests).count() == 0
