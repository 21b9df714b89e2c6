import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import sampling


def md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to one item."""
    item = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)
    return spark.range(0, 6000, 1, 12).select(
        F.col("id").alias("review_id"), item.alias("app_id"), (F.col("id") % 5 > 1).alias("recommended"),
        F.concat(F.lit("text number "), F.col("id"), F.lit(" of the lot")).alias("review"),
    )


def brute(rows, by, k, seed=42):
    groups = defaultdict(list)
    for row in rows:
        groups[by(row)].append((md5(row["review_id"], seed), row["review_id"]))
    return {r for g in groups.values() for _, r in sorted(g)[:k]}


def test_cap_per_group(skewed):
    found = {r[0] for r in sampling.cap_per_group(skewed, ["app_id"], "review_id", 7).select("review_id").collect()}
    assert found == brute(skewed.collect(), lambda r: r["app_id"], 7)


def test_hash_sample_ignores_partitioning(skewed):
    expected = brute(skewed.collect(), lambda r: (r["app_id"], r["recommended"]), 9)
    for parts in (1, 3, 50):
        sample = sampling.dedupe_sample(sampling.hash_sample(skewed.repartition(parts), k=9))
        assert {r["review_id"] for r in sample.collect()} == expected


def test_hash_sample_is_idempotent_and_drops_short_texts(skewed, spark):
    once = sampling.hash_sample(skewed, k=5)
    again = sampling.hash_sample(once.drop("_priority"), k=5)
    assert {r["review_id"] for r in once.collect()} == {r["review_id"] for r in again.collect()}
    short = spark.createDataFrame([(1, 1, True, "short"), (2, 1, True, "x" * 20)], skewed.schema)
    assert [r["review_id"] for r in sampling.hash_sample(short).collect()] == [2]


def test_repeats_are_dropped_after_sampling(spark):
    schema = "review_id long, app_id int, recommended boolean, review string"
    rows = [(1, 1, True, "a" * 20), (1, 1, True, "a" * 20), (2, 1, True, "b" * 20), (3, 1, False, "c" * 20)]
    sample = sampling.hash_sample(spark.createDataFrame(rows, schema), k=2)
    kept = sampling.dedupe_sample(sample).collect()
    ids = sorted(r["review_id"] for r in kept)
    # both copies of 1 may take the two places of the positive side
    expected = sorted({r for _, r in sorted((md5(i, 42), i) for i in (1, 1, 2))[:2]} | {3})
    assert ids == expected


def test_sample_without_ids_uses_texts(spark):
    rows = [(1, True, "same text again and again"), (1, True, "same text again and again"), (1, True, "another text of that length")]
    df = spark.createDataFrame(rows, "app_id int, recommended boolean, review string")
    kept = sampling.dedupe_sample(sampling.hash_sample(df, key=None), key=None)
    assert kept.count() == 2


def test_dedupe_keeps_ends_and_joins_null_keys(spark):
    rows = [("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)]
    df = spark.createDataFrame(rows, "k string, n int")
    first = sampling.dedupe(df, ["k"], [F.col("n")]).collect()
    last = sampling.dedupe(df, ["k"], [F.col("n")], "last").collect()
    assert {r["n"] for r in first} == {1, 3, 5}
    assert {r["n"] for r in last} == {2, 4, 5}


def test_no_cap_keeps_all_rows(skewed):
    assert sampling.cap_per_group(skewed, ["app_id"], "review_id", None).count() == skewed.count()


@pytest.mark.parametrize("n", [0, 1, 100, 5999, 10000])
def test_sample_n(skewed, n):
    found = {r["review_id"] for r in sampling.sample_n(skewed, ["review_id"], n).collect()}
    assert found == {i for _, i in sorted((md5(i, 42), i) for i in range(6000))[:n]}


def test_balanced_sample(spark):
    rows = [(i, "low" if i < 30 else "high") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, side string")
    found = sampling.balanced_sample(df, "k", minimum=10, seed=7)
    low = {r["k"] for r in found.filter("side = 'low'").collect()}
    high = {r["k"] for r in found.filter("side = 'high'").collect()}
    assert low == set(range(30))
    assert high == {i for _, i in sorted((md5(i, 8), i) for i in range(30, 100))[:30]}
    capped = sampling.balanced_sample(df, "k", limit=12, minimum=10, seed=7)
    assert {r["side"]: r["count"] for r in capped.groupBy("side").count().collect()} == {"low": 12, "high": 12}
    assert sampling.balanced_sample(df, "k", limit=None, minimum=10, seed=7).count() == 60
    with pytest.raises(Exception, match="31 usable"):
        sampling.balanced_sample(df, "k", minimum=31).collect()
    with pytest.raises(Exception, match="1 usable"):
        sampling.balanced_sample(df.filter("side = 'low'"), "k", minimum=1).collect()


def test_select_users(spark):
    users = spark.createDataFrame([(i % 50,) for i in range(500)] + [(None,)], "rater_id long")
    states = spark.createDataFrame([(i, 3 if i % 2 else 1) for i in range(40)], "rater_id long, state int")
    chosen = [r["rater_id"] for r in sampling.select_users(users, states, n=5).collect()]
    assert sorted(chosen) == sorted(i for _, i in sorted((md5(i, 42), i) for i in range(1, 40, 2))[:5])
    with pytest.raises(RuntimeError, match="20 exist"):
        sampling.select_users(users, states, n=21)
