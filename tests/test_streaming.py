import pytest
from pyspark.sql import functions as F

from reviewlens.adapters import as_plays, as_responses
from reviewlens.operators import consensus, joins, sampling
from reviewlens.plans import studies
from reviewlens.streaming import incremental


@pytest.fixture(scope="module", params=[1, 2, 7])
def split(request, spark, sf, tmp_path_factory):
    """The same events in 1, 2 or 7 files, one file per batch."""
    path = str(tmp_path_factory.mktemp("events") / "in")
    spark.read.parquet(f"{sf}/events.parquet").repartition(request.param, "event_id").write.parquet(path)
    return path


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_counts_do_not_depend_on_batches(spark, split, tmp_path):
    stream = as_plays(incremental.open_stream(spark, split, 1))
    found = incremental.stream_item_counts(stream, str(tmp_path / "out"))
    assert rows(found) == rows(consensus.item_counts(as_plays(spark.read.parquet(split))))


def test_sample_does_not_depend_on_batches(spark, split, tmp_path):
    stream = as_plays(incremental.open_stream(spark, split, 1))
    found = incremental.stream_hash_sample(stream, str(tmp_path / "out"), k=6)
    batch = sampling.dedupe_sample(sampling.hash_sample(as_plays(spark.read.parquet(split)), k=6))
    assert rows(found.select("review_id", "app_id")) == rows(batch.select("review_id", "app_id"))


def test_sample_prepares_rows_like_the_batch_form(spark, tmp_path):
    rows = [
        (1, "a", "A", "  ten letters  " + " " * 20, "true"), (2, "a", "A", "long enough for a sample", None),
        (3, "a", "A", "long enough for a sample too", "yes"), (4, "a", "A", " another text of some length ", "0"),
    ]
    df = spark.createDataFrame(rows, "review_id long, app_id string, app_name string, review string, recommended string")
    path = str(tmp_path / "in")
    df.repartition(3, "review_id").write.parquet(path)
    found = incremental.stream_hash_sample(incremental.open_stream(spark, path, 1), str(tmp_path / "out"), k=6)
    batch = studies.profile_sample(df, k=6)
    assert rows_of(found, batch.columns) == rows_of(batch, batch.columns)
    assert {r["review_id"] for r in batch.collect()} == {3, 4}


def rows_of(df, columns):
    return sorted(map(str, df.select(sorted(columns)).collect()))


def states_of(target):
    """Modification time of every file of a running result, by bucket and slot."""
    return {p: p.stat().st_mtime_ns for p in target.glob("_bucket=*/_slot=*/*.parquet")}


def test_old_states_go(spark, split, tmp_path):
    target = tmp_path / "out"
    incremental.stream_item_counts(as_plays(incremental.open_stream(spark, split, 1)), str(target)).collect()
    slots = {p.parent for p in states_of(target)}
    assert slots and all(len([s for s in slots if s.parent == bucket]) <= 2 for bucket in {s.parent for s in slots})


def ratings(spark, path, rows, mode="append"):
    schema = "review_id long, app_id string, app_name string, review string, recommended string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(path)


@pytest.mark.parametrize("running", [
    lambda stream, target: incremental.stream_item_counts(stream, target),
    lambda stream, target: incremental.stream_hash_sample(stream, target, k=3),
])
def test_a_batch_leaves_other_buckets_alone(spark, tmp_path, running):
    path, target = str(tmp_path / "in"), tmp_path / "out"
    text = "long enough for a sample "
    ratings(spark, path, [(i, f"item {i % 20}", "name", f"{text}{i}", "true") for i in range(200)])
    running(incremental.open_stream(spark, path, 1), str(target)).collect()
    before = states_of(target)
    assert len({p.parts[-3] for p in before}) > 5
    ratings(spark, path, [(1000 + i, "item 3", "name", f"{text}{i}", "true") for i in range(50)])
    running(incremental.open_stream(spark, path, 1), str(target)).collect()
    after = states_of(target)
    new = {p for p in after if p not in before}
    assert len({p.parts[-3] for p in new}) == 1
    assert all(after[p] == t for p, t in before.items())
    assert rows(running(incremental.open_stream(spark, path, 1), str(target))) == rows(
        running(incremental.open_stream(spark, path, 99), str(tmp_path / "again")))


def test_a_sample_never_holds_more_than_its_size(spark, tmp_path):
    path, target = str(tmp_path / "in"), tmp_path / "out"
    for batch in range(4):
        ratings(spark, path, [(100 * batch + i, f"item {i % 2}", "name", f"a text of some length {i}", "true") for i in range(40)])
        incremental.stream_hash_sample(incremental.open_stream(spark, path, 1), str(target), k=3).collect()
        held = spark.read.parquet(str(target)).groupBy("app_id", "recommended", "_slot").count().collect()
        assert held and all(r["count"] <= 3 for r in held)


def test_a_retried_batch_starts_from_the_same_state(spark, tmp_path):
    target = str(tmp_path / "out")
    schema = "app_id string, n long"
    add = lambda old, new: old.unionByName(new).groupBy("app_id", "_bucket").agg(F.sum("n").alias("n"))
    for number, amount in ((0, 1), (1, 10), (1, 10), (2, 100), (2, 100), (2, 100)):
        batch = spark.createDataFrame([("a", amount), *([("b", 5)] if number == 1 else [])], schema)
        incremental.upsert(batch, target, number, ["app_id"], 8, add)
    assert {tuple(r) for r in incremental.latest_state(spark, target, batch.schema).collect()} == {("a", 111), ("b", 5)}


def test_empty_batches(spark, tmp_path):
    path, target = str(tmp_path / "in"), str(tmp_path / "out")
    ratings(spark, path, [])
    for _ in range(2):
        assert incremental.stream_hash_sample(incremental.open_stream(spark, path, 1), target).count() == 0
    ratings(spark, path, [(1, "a", "A", "long enough for a sample", "true")])
    assert incremental.stream_hash_sample(incremental.open_stream(spark, path, 1), target).count() == 1


def test_resume_reads_no_earlier_results(spark, tmp_path):
    path, target = str(tmp_path / "in"), tmp_path / "out"
    schema = "review_id long, http_status int, body string, attempt int"
    answers = [[(1, 403, None, 1), (1, 500, None, 2), (2, 403, None, 1), (None, 403, None, 1)], [(2, 500, None, 9), (3, 404, None, 1)], [(1, 200, "{}", 3)]]
    found = None
    for batch in answers:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        found = incremental.stream_resume(incremental.open_stream(spark, path, 1), str(target), [F.col("attempt")], leave_out=["body"])
        kept = {(r["review_id"], r["fetch_status"]) for r in found.collect()}
        # nothing of earlier batches is needed to go on
        if batch is answers[0]:
            assert kept == {(1, "Error_500"), (2, "Private_or_NotOwned"), (None, "Private_or_NotOwned")}
    assert "body" not in found.columns
    assert kept == {(1, "Error_500"), (2, "Private_or_NotOwned"), (None, "Private_or_NotOwned"), (3, "Error_404")}
    assert spark.read.parquet(str(target / "version=1")).count() == 1


def test_resume_skips_finished_ids(spark, split, tmp_path):
    target = str(tmp_path / "out")
    answers = as_responses(as_plays(incremental.open_stream(spark, split, 1)))
    first = incremental.stream_resume(answers, target, [F.col("http_status")])
    expected = rows(joins.classify_responses(as_responses(as_plays(spark.read.parquet(split)))))
    assert rows(first) == expected
    # the same answers again, one of them under a new id
    again = spark.read.parquet(split).withColumn("event_id", F.when(F.col("event_id") == 1, 99991).otherwise(F.col("event_id")))
    again.coalesce(1).write.mode("append").parquet(split)
    more = incremental.stream_resume(answers, target, [F.col("http_status")])
    assert more.count() == len(expected) + 1 and more.filter("review_id = 99991").count() == 1
    assert set(expected) <= set(rows(more))


def test_nothing_new_changes_nothing(spark, sf, tmp_path):
    stream = as_plays(incremental.open_stream(spark, f"{sf}/events.parquet"))
    target = str(tmp_path / "out")
    once = rows(incremental.stream_item_counts(stream, target))
    assert rows(incremental.stream_item_counts(stream, target)) == once
