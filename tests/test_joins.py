import json

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import joins


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame([("1.0", "7", "x"), ("2", "7.0", "y"), ("3", "8", "z")], "review_id string, app_id string, review string")


def results(spark, rows):
    return spark.createDataFrame(
        rows, "review_id string, app_id string, fetch_status string, achievements_unlocked int, total_achievements int, at int")


GOOD = [("1", "7", "Success", 1, 2, 1), ("2", "7", "No_Stats", 0, 0, 1), ("3", "8", "Error_500", 0, 0, 1)]


def test_enrich_keeps_the_last_result(spark, reviews):
    df = joins.enrich_reviews(reviews, results(spark, GOOD + [("3", "8.0", "Success", 4, 5, 2)]), ["at"])
    found = {r["review_id"]: r for r in df.collect()}
    assert len(found) == 3 and found["3"]["fetch_status"] == "Success" and found["1"]["app_id"] == "7"
    assert "_result_item" not in df.columns


@pytest.mark.parametrize(
    "rows,order,message",
    [
        (GOOD[:2], ["at"], "has no result"),
        (GOOD[:2] + [("3", "9", "Success", 1, 1, 1)], ["at"], "different items"),
        (GOOD + GOOD[:1], None, "repeats on the right side"),
    ],
)
def test_enrich_guards(spark, reviews, rows, order, message):
    with pytest.raises(Exception, match=message):
        joins.enrich_reviews(reviews, results(spark, rows), order).collect()
    with pytest.raises(Exception, match=message):
        joins.enrich_reviews(reviews, results(spark, rows), order).count()


def test_visibility_and_selection(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "rater_id long")
    states = spark.createDataFrame([(1, 3), (1, 3), (2, 1)], "rater_id long, state int")
    seen = [(r["rater_id"], r["state"]) for r in joins.with_visibility(users, states).collect()]
    assert sorted(seen) == [(1, 3), (2, 1), (3, 0)]
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c")], "rater_id long, x string")
    assert sorted(r["x"] for r in joins.rows_of(rows, users).collect()) == ["a", "b"]


def test_pending(spark):
    targets = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "review_id string")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "review_id string")
    assert sorted(r[0] for r in joins.pending(targets, done).collect()) == ["b", "c"]


def test_pending_takes_the_first_of_equal_targets(spark):
    rows = [("b", 2, "y", "i"), ("b", 1, "x", "i"), ("c", 1, "z", None), ("d", 1, "d", "i"), ("d", 1, "d", "i")]
    targets = spark.createDataFrame(rows, "review_id string, at int, note string, app_id string")
    done = spark.createDataFrame([("a",)], "review_id string")
    found = joins.pending(targets, done, order=["at"], ids=["app_id"]).collect()
    assert sorted((r["review_id"], r["note"]) for r in found) == [("b", "x"), ("d", "d")]


def test_pending_pages(spark):
    names = spark.createDataFrame([("A", ["a", "a2"]), ("B", ["b"]), ("C", ["c", "c2"])], "app_name string, urls array<string>")
    tried = spark.createDataFrame([("c",), ("b",)], "url string")
    good = spark.createDataFrame([("a2",)], "url string")
    found = joins.pending_pages(names, "urls", tried, good).collect()
    assert [(r["app_name"], r["position"], r["url"]) for r in found] == [("C", 1, "c2")]


def test_classify_responses(spark):
    done = json.dumps({"playerstats": {"achievements": [{"achieved": 1}, {"achieved": 0}, {"name": "x"}, {"achieved": 1}]}})
    rows = [
        (1, 403, done), (2, 500, None), (3, 200, "not json"), (4, 200, None), (5, 200, "{}"),
        (6, 200, '{"playerstats": {"achievements": []}}'), (7, 200, done), (8, 200, '{"playerstats": {"achievements": {}}}'),
    ]
    df = spark.createDataFrame(rows, "review_id int, http_status int, body string")
    found = {r["review_id"]: (r["fetch_status"], r["achievements_unlocked"], r["total_achievements"])
             for r in joins.classify_responses(df).collect()}
    assert found == {
        1: ("Private_or_NotOwned", 0, 0), 2: ("Error_500", 0, 0), 3: ("Invalid_Response", 0, 0),
        4: ("Invalid_Response", 0, 0), 5: ("No_Stats", 0, 0), 6: ("No_Stats", 0, 0), 7: ("Success", 2, 4),
        8: ("No_Stats", 0, 0),
    }


def test_sample_sizes_per_item(spark):
    sample = spark.createDataFrame([(1, True), (1, True), (1, False), (2, False)], "app_id int, recommended boolean")
    items = spark.createDataFrame([(1,), (2,), (3,)], "app_id int")
    found = joins.with_sample_counts(items, joins.pivot_counts(sample)).orderBy("app_id").collect()
    assert [tuple(r) for r in found] == [(1, 1, 2), (2, 1, 0), (3, 0, 0)]
