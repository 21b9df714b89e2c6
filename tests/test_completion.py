import math

import pytest
from pyspark.sql import functions as F

from reviewlens import constants as K
from reviewlens.operators import completion


def test_bands(spark):
    edges = {0.0: 0, 10.0: 0, 10.0001: 1, 20.0: 1, 55.0: 5, 100.0: 9}
    rows = [(v, 1.0) for v in edges] + [(55.0, 0.0), (57.0, None)]
    found = completion.rate_by_band(spark.createDataFrame(rows, "completion_percentage double, rating double")).collect()
    assert [r["band"] for r in found] == list(range(10))
    counts = {r["band"]: r["n"] for r in found if r["n"]}
    assert counts == {0: 2, 1: 2, 5: 2, 9: 1}
    five, empty = found[5], found[3]
    assert five["rate"] == 50 and five["se"] == pytest.approx(math.sqrt(0.25 / 2) * 100)
    assert five["high"] - five["low"] == pytest.approx(2 * 1.96 * five["se"])
    assert five["label"] == "50–60%"
    assert (empty["rate"], empty["n"]) == (None, 0)


def test_playtime_bins(evaluate):
    hours = [0.0, 4.9, 5.0, 20.0, 100.0, -1.0, math.inf, None]
    labels = [label for _, label in K.PLAYTIME_BINS]
    found = evaluate(hours, lambda c: completion.playtime_group(F.col(c)), "double")
    assert found == [labels[0], labels[0], labels[1], labels[2], labels[3], None, None, None]


def test_theme_grid_has_all_cells(spark):
    rows = [
        (60.0, 10.0, "the art of war"), (60.0, 25.0, "fun"), (60.0, 20.0, "music and art"), (9e9, 80.0, "fun fun"),
        (math.inf, 80.0, "fun"), (-1.0, 10.0, "fun"), (60.0, 10.0, "!!"), (600.0, 50.0, "Fun, art"),
    ]
    df = spark.createDataFrame(rows, "playtime_minutes double, completion_percentage double, review string")
    found = completion.theme_balance(df, ["fun"], ["art", "music"]).collect()
    assert len(found) == 12
    cells = {(r["playtime_order"], r["completion_group"]): (r["balance"], r["n"]) for r in found if r["n"]}
    assert cells[(0, "Low")] == (pytest.approx(100 / 3), 3)
    assert cells[(3, "High")] == (-100, 1)
    assert cells[(1, "Middle")] == (0, 1)
    assert sum(r["n"] for r in found) == 5
    with pytest.raises(ValueError, match="playtime"):
        completion.theme_balance(df.drop("playtime_minutes"), ["a"], ["b"])


def test_completion_rows(spark):
    rows = [
        (1, "1.0", "7", "Success", "5", "10"), (2, "1", "7", "Success", "9", "10"), (3, "nan", "7", "Success", "1", "1"),
        (4, "2", "7", "No_Stats", "1", "1"), (5, "3", "7", "Success", "x", "1"), (6, "4", "7", "Success", "3", "0"),
        (7, "5", "7", "Success", "12", "10"),
    ]
    df = spark.createDataFrame(
        rows, "at int, review_id string, app_id string, fetch_status string, achievements_unlocked string, total_achievements string"
    ).withColumns({"review": F.lit("text"), "recommended": F.lit("yes")})
    found = {r["review_id"]: r["completion_percentage"] for r in completion.completion_rows(df, [F.col("at")]).collect()}
    assert found == {"1": 50, "5": 100}
    assert completion.completion_rows(df, [F.col("at")], cap=1).count() == 1
    with pytest.raises(ValueError, match="fetch_status"):
        completion.completion_rows(df.drop("fetch_status"), [F.col("at")])


def test_rated_rows(spark):
    rows = [(-1.0, "yes"), (100.1, "yes"), (None, "yes"), (100.0, "negative"), (0.0, "?")]
    df = spark.createDataFrame(rows, "completion_percentage double, recommended string").withColumns(
        {"app_id": F.lit(1), "review": F.lit("x")})
    assert [r["rating"] for r in completion.rated_rows(df).collect()] == [0.0, None]
