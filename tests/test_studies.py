import os

import pytest
from pyspark.sql import functions as F

from reviewlens import adapters as A, constants as K
from reviewlens.operators import consensus
from reviewlens.plans import studies
from reviewlens.session import materialize, release_stages, shared_root
from reviewlens.sources import tables


def test_profiles_then_search(spark, sf, tmp_path):
    reviews = A.text_reviews(spark, sf)
    items, clusters = studies.item_profiles(reviews, k=8, restarts=2, iterations=2)
    tables.write_profiles(items, clusters, consensus.run_manifest(items, clusters), str(tmp_path / "p"))
    items, clusters, manifest = tables.load_profiles(spark, str(tmp_path / "p"))
    summary = manifest.first()
    assert (summary["games"], summary["clusters"]) == (items.count(), clusters.count())
    with pytest.raises(FileNotFoundError, match="clusters, manifest"):
        items.write.parquet(str(tmp_path / "q" / "items"))
        tables.load_profiles(spark, str(tmp_path / "q"))
    totals = items.agg(F.sum("review_count"), F.sum(F.col("sampled_negative") + F.col("sampled_positive"))).first()
    assert totals[0] == 200 and totals[1] == clusters.agg(F.sum("sample_count")).first()[0]
    biggest = clusters.groupBy("app_id", "sentiment").count().agg(F.max("count")).first()[0]
    assert biggest <= K.CLUSTERS_PER_SENTIMENT
    wanted = list(clusters.filter("sentiment = 'positive'").orderBy("app_id", "cluster").first()["embedding"])
    found = studies.item_search(items, clusters, wanted, min_rate=0, n=3).orderBy("rank").collect()
    assert [r["rank"] for r in found] == [1, 2, 3] and found[0]["match_pct"] == pytest.approx(100, abs=0.01)


def test_theme_map(spark, sf):
    found = studies.theme_map(A.text_reviews(spark, sf), "SRC1", restarts=1, iterations=2).collect()
    assert {r["sentiment"] for r in found} == {"positive", "negative"}
    for side in K.SENTIMENTS:
        own = [r for r in found if r["sentiment"] == side]
        assert sum(r["share"] for r in own) == pytest.approx(100)
        assert len({r["cluster"] for r in own}) == len(own) <= 4
        # places are centred: weighted by size they cancel out
        assert sum(r["pc1"] * r["sample_count"] for r in own) == pytest.approx(0, abs=1e-5)
    assert all(r["description"] for r in found)
    with pytest.raises(ValueError, match="nowhere"):
        studies.theme_map(A.text_reviews(spark, sf), "nowhere")


def test_cohort_study_has_all_parts(spark, sf):
    parts = studies.cohort_study(A.plays(spark, sf))
    sizes = {name: part.count() for name, part in parts.items()}
    assert sizes == {"density": 200, "shares": 3, "length": 3, "free": 3, "votes": 3}


def test_critic_study_from_raw_pages(spark, sf):
    title = '<div class="subpage-header__navigation">%s</div>'
    score = '<div class="score-card-left__score-number"><span>%d</span></div>'
    count = "<div class='count'>Showing %d Critic Reviews</div>"
    rows = [(f"u/{i}", "PC", title % f"supplier#{i:09d}&trade;" + score % (40 + i) + count % (4 + i)) for i in range(4)]
    pages = spark.createDataFrame(rows, "url string, Platform string, html string")
    matched = studies.critic_study(A.ratings(spark, sf), pages, ["url"])
    # the first page has too few critics
    assert sorted(r["app_id"] for r in matched.collect()) == [1, 2, 3]
    report = studies.critic_report(matched, 2)
    assert report["outliers"].first()["total"] == 3 and report["tails"].count() == 4


def test_completion_report(spark):
    rows = [(1, "1.0", "Success", "x"), (2, "1", "No_Stats", "1"), (3, "2", "Success", "1"), (4, None, "Success", "1"), (5, "3", None, "1")]
    df = spark.createDataFrame(rows, "at int, review_id string, fetch_status string, total_achievements string").withColumns(
        {"app_id": F.lit(7), "achievements_unlocked": F.lit("1")})
    parts = studies.completion_report(df, [F.col("at")])
    assert tuple(parts["duplicates"].first()) == (4, 3, 1)
    assert {r["fetch_status"]: r["n"] for r in parts["statuses"].collect()} == {"Success": 2, None: 1}
    assert [r["rows"] for r in parts["stages"].collect()] == [3, 3, 2, 1, 1]


def test_cut_is_optional(spark, sf):
    rated = A.text_reviews(spark, sf).withColumn("rating", F.lit(1.0))
    cut = studies.text_sides(rated, 1.0, 10, minimum=5, max_chars=50)
    whole = studies.text_sides(rated, 1.0, 10, minimum=5)
    assert cut.agg(F.max(F.length("text"))).first()[0] <= 50 < whole.agg(F.max(F.length("text"))).first()[0]
    assert {r[0] for r in cut.select("review_id").collect()} == {r[0] for r in whole.select("review_id").collect()}


def test_finished_critic_results_are_reused(spark):
    stored = spark.createDataFrame([("A", 0.5, 40.0), ("B", 0.5, None)], "app_name string, steam_consensus double, Metascore double")
    found = studies.finish_critic_study(stored).collect()
    assert [(r["app_name"], r["delta"]) for r in found] == [("A", pytest.approx(0.1))]


def test_enrichment_needs_enough_users(spark, sf):
    with pytest.raises(RuntimeError, match="public users"):
        studies.enrichment(A.plays(spark, sf), A.states(spark, sf), A.responses(spark, sf).withColumn("at", F.lit(1)), ["at"])


class Stub:
    """Just enough of a session to ask where the shared folder is."""

    def __init__(self, configured, master):
        self.conf = self
        self.settings = {"spark.master": master} | ({"spark.checkpoint.dir": configured} if configured else {})

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def set(self, name, value):
        self.settings[name] = value


def test_stages_are_released(spark):
    session = spark.newSession()
    kept = materialize(session.range(5))
    folder = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert kept.count() == 5 and os.path.isdir(folder)
    release_stages(session)
    assert not os.path.isdir(folder)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(Stub("hdfs://shared/folder", "yarn")) == "hdfs://shared/folder"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Stub(None, "yarn"))
    local = Stub(None, "local[2]")
    assert shared_root(local) == shared_root(local) == local.settings["reviewlens.checkpoint.dir"]
    assert shared_root(spark)
