import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens import constants as K
from reviewlens.operators import cohorts, consensus, quantiles


@pytest.mark.parametrize(
    "name,values",
    [
        ("heavy tail", np.random.default_rng(1).pareto(0.7, 3000) * 10),
        ("signed", np.random.default_rng(2).normal(0, 1e4, 2000)),
        ("ties", np.repeat([0.0, 1.0, 1.0, 5.0], 250)),
        ("tiny", np.array([3.0])),
        ("narrow", np.random.default_rng(3).uniform(0, 1e-6, 500)),
        ("extreme", np.array([-1e308, -1.0, -5e-324, 0.0, 5e-324, 2.0, 1e308])),
    ],
)
def test_exact_quantiles(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    found = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-320)


def test_quantiles_per_group_with_one_hot_group(spark):
    rng = np.random.default_rng(4)
    rows = [(0 if rng.random() < 0.4 else int(rng.integers(1, 30)), float(rng.integers(0, 500))) for _ in range(5000)]
    df = spark.createDataFrame(rows + [(1, None), (None, 3.0)], "g int, v double")
    found = {(r["g"], r["prob"]): r["quantile"] for r in quantiles.exact_quantiles(df, "v", [0.1, 0.75], ["g"]).collect()}
    for g in {g for g, _ in rows}:
        values = [v for h, v in rows if h == g]
        for p in (0.1, 0.75):
            assert found[(g, p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_box_stats_keeps_levels_and_fences(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", float(v)) for v in (-100, 10, 10, 10)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = quantiles.box_stats(df, "g", "v", ["b", "a", "c"]).collect()
    assert [r["g"] for r in found] == ["b", "a", "c"]
    a = found[1]
    assert (a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["n"]) == (2, 3, 4, 1, 4, 5)
    # the lower quartile is an interpolated value far below all values in reach
    assert (found[0]["q1"], found[0]["whisker_low"], found[0]["whisker_high"]) == (-17.5, -17.5, 10)
    assert found[2]["median"] is None


@pytest.fixture(scope="module")
def rated(spark):
    rows = [
        (1, "119.9", "true", "no", "3", "  hi "), (2, "120", "True", "yes", "x", None),
        (3, "3000", "false", "1", "60000", "long text"), (4, "2999", "false", None, "10", "a"),
        (5, None, "true", "0", "1", "b"), (6, "9999", "maybe", "yes", "2", "c"), (7, "10", None, "no", "-1", "d"),
    ]
    return spark.createDataFrame(
        rows, "review_id long, playtime_minutes string, recommended string, received_for_free string, votes_helpful string, review string")


def test_cohort_flags(rated):
    found = cohorts.add_cohort(cohorts.cohort_flags(rated)).orderBy("review_id").collect()
    assert [r["is_early_positive"] for r in found] == [1, 0, 0, 0, 0, 0, 0]
    assert [r["is_long_play_negative"] for r in found] == [0, 0, 1, 0, 0, 0, 0]
    assert [r["cohort"] for r in found][:3] == [K.COHORT_EARLY, K.COHORT_OTHER, K.COHORT_LONG]
    assert [r["review_length"] for r in found] == [2, 0, 9, 1, 1, 1, 1]
    assert [r["votes_helpful"] for r in found] == [3, None, 60000, 10, 1, 2, -1]


def test_cohort_statistics(rated):
    narrow = cohorts.processed(rated)
    shares = {r["cohort"]: r["share"] for r in cohorts.cohort_shares(narrow).collect()}
    assert sum(shares.values()) == pytest.approx(100)
    assert shares[K.COHORT_EARLY] == pytest.approx(100 / 7)
    labelled = cohorts.add_cohort(narrow)
    free = [r["free_share"] for r in cohorts.free_share(labelled).collect()]
    assert free == [pytest.approx(50), 0, 100]
    votes = cohorts.trimmed_means(labelled, q=0.5).collect()
    assert [r["cohort"] for r in votes] == K.COHORTS
    # in range are 3, 10, 1, 2; the middle is 2.5
    assert votes[0]["raw_mean"] == pytest.approx(13 / 3) and votes[0]["trimmed_mean"] == 1.5
    assert votes[1]["raw_mean"] == 3 and votes[1]["trimmed_mean"] is None
    assert votes[2]["raw_mean"] is None


@pytest.mark.parametrize("values", [
    [1000 + i * 1e-4 for i in range(3000)], [-5.0, 5.0, float("inf"), float("-inf"), 0.0, 0.0], [7.0] * 50, [2.0**i for i in range(-40, 40)],
])
def test_quantiles_of_close_and_far_values(spark, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        low = sorted(values)[int(np.floor(p * (len(values) - 1)))]
        if np.isfinite(low):
            with np.errstate(invalid="ignore"):
                expected = np.quantile(values, p)
            assert found[p] == pytest.approx(expected) or np.isnan(expected)


def test_density_equals_direct_sum(spark):
    values = np.random.default_rng(5).lognormal(1, 1, 300)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)] + [(999, 0.001)], "k long, h double")
    found = cohorts.density(df, "h", grid=50).orderBy("step").collect()
    x = np.round(np.log10(values) / 0.001) * 0.001
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * width, x.max() + 3 * width, 50)
    direct = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))
    assert [r["at"] for r in found] == pytest.approx(list(10 ** grid))
    assert [r["density"] for r in found] == pytest.approx(list(direct))
    area = np.sum(direct) * (grid[1] - grid[0])
    assert area == pytest.approx(1, abs=0.01)


def test_density_of_any_range(spark):
    rng = np.random.default_rng(9)
    values = [float(v) for v in np.concatenate([rng.normal(0, 1e8, 4000), rng.normal(9e8, 3e7, 500)])]
    strange = [float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in [*values, *strange]], "h double")
    found = cohorts.density(df, "h", log=False, floor=None, grid=60).orderBy("step").collect()
    x, at = np.array(values), np.array([r["at"] for r in found])
    width = x.std(ddof=1) * len(x) ** -0.2
    direct = np.exp(-0.5 * ((at[:, None] - x) / width) ** 2).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))
    assert at[0] == pytest.approx(x.min() - 3 * width, abs=width / 100) and len(found) == 60
    assert np.allclose([r["density"] for r in found], direct, rtol=1e-3, atol=direct.max() * 1e-4)
    # an infinite value changes nothing with logarithms either
    logs = [cohorts.density(spark.createDataFrame([(v,) for v in [*map(abs, values), *extra]], "h double"), "h").orderBy("step").collect()
            for extra in ([], strange)]
    assert len(logs[0]) == len(logs[1]) == K.DENSITY_GRID
    assert np.allclose([tuple(r) for r in logs[0]], [tuple(r) for r in logs[1]], rtol=1e-9)


def test_density_without_spread(spark):
    for values in ([0.1] * 30, [1e9] * 3, [5.0], [], [None], [float("inf")] * 3):
        df = spark.createDataFrame([(v,) for v in values], "h double")
        assert cohorts.density(df, "h").collect() == []
        assert cohorts.density(df, "h", log=False).collect() == []


def test_density_of_a_sample(spark):
    df = spark.range(1, 400).selectExpr("id AS k", "CAST(id AS DOUBLE) AS h")
    curve = cohorts.density(df, "h", "k", grid=80, sample=50).collect()
    large = cohorts.density(df, "h", "k", grid=80, sample=10_000).orderBy("step").collect()
    whole = cohorts.density(df, "h", grid=80).orderBy("step").collect()
    assert len(curve) == 80 and [r["density"] for r in large] == pytest.approx([r["density"] for r in whole])
    assert cohorts.density(df.limit(1), "h").count() == 0


def test_unreadable_ratings_count_as_none_positive(spark):
    df = spark.createDataFrame([(i, "a", "A", "?") for i in range(30)], "review_id long, app_id string, app_name string, recommended string")
    assert [tuple(r) for r in consensus.consensus(df).collect()] == [("a", "A", 30, 0, 0.0)]


def test_sorted_baseline(spark):
    rows = [(i, n, n, i % 2 == 0) for n in ("b", "a") for i in range(30)]
    df = spark.createDataFrame(rows, "review_id long, app_id string, app_name string, recommended boolean")
    assert [r["app_name"] for r in consensus.sorted_baseline(df).collect()] == ["a", "b"]


def test_consensus_needs_support(spark):
    rows = [(i, "a", "A", i % 3 > 0) for i in range(30)] + [(i, "b", "B", True) for i in range(29)]
    rows += [(i, None, "C", True) for i in range(40)] + [(i, "d", "D", True) for i in range(31)]
    df = spark.createDataFrame(rows, "review_id long, app_id string, app_name string, recommended boolean")
    found = [tuple(r) for r in consensus.consensus(df).collect()]
    assert found == [("d", "D", 31, 31, 1.0), ("a", "A", 30, 20, pytest.approx(2 / 3))]


def test_item_counts_take_first_known_name(spark):
    rows = [(3, 1, "late", "true"), (1, 1, None, "true"), (2, 1, "early", "no"), (4, 2, None, "1"), (5, 2, None, "1.0")]
    df = spark.createDataFrame(rows, "review_id long, app_id int, app_name string, recommended string")
    found = {r["app_id"]: r for r in consensus.item_counts(df).collect()}
    assert found[1]["app_name"] == "early" and found[1]["recommendation_rate"] == pytest.approx(200 / 3)
    # "1.0" is unknown to the basic vocabulary
    assert (found[2]["app_name"], found[2]["review_count"]) == ("2", 1)


def test_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None), (None, 5)], "k string, n int")
    assert [tuple(r) for r in consensus.value_counts(df, "k").collect()] == [("a", 2), (None, 2), ("b", 1)]
    assert consensus.mode_value(df.filter("n <> 2 or n is null"), "k").first()["k"] == "a"
    assert tuple(consensus.duplicate_count(df, "k").first()) == (3, 2, 1)
    report = consensus.stage_report(df, [("key", F.col("k").isNotNull()), ("number", F.col("n") > 1)]).collect()
    assert [(r["stage"], r["rows"], r["dropped"], r["pct_kept"]) for r in report] == [
        ("all rows", 5, 0, 100), ("key", 3, 2, 60), ("number", 1, 2, 20)]
    empty = consensus.stage_report(df.limit(0), [("key", F.col("k").isNotNull())]).collect()
    assert empty[0]["pct_kept"] is None


def test_outliers_are_strictly_beyond(spark):
    df = spark.createDataFrame([(0.25,), (-0.26,), (None,), (0.5,)], "delta double")
    assert tuple(consensus.outlier_share(df).first()) == (4, 2, 50.0)
