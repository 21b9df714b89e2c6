import json

from pyspark.sql import functions as F

from reviewlens.operators import critics

PAGE = """<html><div class="x subpage-header__navigation y"> <b>Great
 Game</b> <i>&amp; Co&#46;</i> </div><div class="score-card-left__score-number"><p><span title="s"> %s </span></div>
<div class="count">Showing %s Critic Reviews</div></html>"""


def test_page_fields(spark):
    pages = [(1, PAGE % ("87", "41")), (2, PAGE % ("TBD", "x")), (3, "<html></html>"), (4, None)]
    df = spark.createDataFrame(pages, "page_id int, html string")
    found = {r["page_id"]: (r["Title"], r["Metascore"], r["NumberOfCriticReviews"])
             for r in critics.extract_page_fields(df).collect()}
    assert found[1] == ("Great\n Game& Co.", 87, 41)
    assert found[2] == ("Great\n Game& Co.", None, None)
    assert found[3] == found[4] == (None, None, None)


def test_page_fields_stay_in_their_block(spark):
    score = '<div class="score-card-left__score-number"><p>%s</p></div>'
    pages = [
        (1, score % "<span>tbd</span>" + "<span>77</span>"), (2, "<span>77</span>"), (3, score % "<span> <b>9</b>1 </span><span>5</span>"),
        (4, '<div class="count">Showing <b>12</b> Critic Reviews</div>'), (5, "Showing 12 Critic Reviews"),
    ]
    df = spark.createDataFrame(pages, "page_id int, html string")
    found = {r["page_id"]: (r["Metascore"], r["NumberOfCriticReviews"]) for r in critics.extract_page_fields(df).collect()}
    assert found == {1: (None, None), 2: (None, None), 3: (91, None), 4: (None, 12), 5: (None, None)}


def test_references(spark):
    texts = ["a &amp;lt; b", "&eacute;&amp;", "x & y", "&lt;i&gt;", None, "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r["u"] for r in df.select("i", critics.unescape(F.col("t")).alias("u")).orderBy("i").collect()]
    assert found == ["a &lt; b", "é&", "x & y", "<i>", None, "plain"]


def test_empty_title_keys_match_nothing(spark):
    items = spark.createDataFrame([(1, "東京"), (2, "物語"), (3, "A")], "app_id int, app_name string")
    scores = spark.createDataFrame([("京都", 60.0), ("大阪", 70.0), ("a", 10.0)], "Title string, Metascore double")
    assert [r["app_id"] for r in critics.match_titles(items, scores).collect()] == [3]
    assert {r["side"]: r["empty_titles"] for r in critics.empty_titles(items, scores).collect()} == {"items": 2, "critics": 2}


def pages(spark):
    rows = [
        (1, "A", "PC", "80", "9", "u/1"), (2, "B", "PC", "None", "9", "u/2"), (3, "C", "PC", "70", "4", "u/3"),
        (4, "A", "PC", "60", "5", None), (5, None, "PC", "50", "7", "u/5"), (6, None, "PC", "40", "8", "u/6"),
        (7, "Z", "PC", "30", "8", "u/1"), (8, "A", "Mac", "20", "8", "u/1"),
    ]
    return spark.createDataFrame(rows, "n int, Title string, Platform string, Metascore string, NumberOfCriticReviews string, url string")


def test_cleaning_and_two_pass_dedupe(spark):
    clean = critics.clean_critics(pages(spark))
    assert sorted(r["n"] for r in clean.collect()) == [1, 4, 5, 6, 7, 8]
    # 7 repeats an address, 4 a title, 6 the missing title of 5
    assert sorted(r["n"] for r in critics.dedupe_critics(clean, ["n"]).collect()) == [1, 5, 8]


def test_json_records_number_before_filtering(spark):
    typed = critics.type_critics(pages(spark))
    fields = ["Title", "Platform", "Metascore", "url"]
    found = critics.to_json_records(typed, ["n"], critics.critic_filter(), fields).orderBy("position").collect()
    records = [json.loads(r["record"]) for r in found]
    assert [r["id"] for r in records] == ["1", "4", "5", "6", "7", "8"]
    assert list(records[0]) == ["id", "url", "Title", "Platform", "Metascore"]
    assert "url" not in records[1] and "Title" not in records[2]


def test_row_positions_are_gapless(spark):
    df = spark.range(0, 5000, 1, 9).select((F.hash("id")).alias("k"), "id")
    rows = sorted(critics.with_row_position(df, ["k", "id"]).collect(), key=lambda r: (r["k"], r["id"]))
    assert [r["position"] for r in rows] == list(range(1, 5001))


def test_match_fans_out_and_adds_delta(spark):
    items = spark.createDataFrame([(1, "Big Fish: II", 0.9), (2, "big fish ii", 0.5), (3, None, 0.5)], "app_id int, app_name string, steam_consensus double")
    scores = spark.createDataFrame([("BIG FISH II™", 60.0), ("big-fish ii", 70.0), (None, 10.0)], "Title string, Metascore double")
    matched = critics.add_delta(critics.match_titles(items, scores))
    assert matched.count() == 4
    row = matched.filter("app_id = 1 and Metascore = 60").first()
    assert abs(row["delta"] - 0.3) < 1e-12
    kept = critics.add_delta(matched.withColumn("delta", F.lit(7.0)))
    assert kept.first()["delta"] == 7.0


def test_tails_repeat_rows_of_short_tables(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(7)], "app_id int, delta double")
    found = [r["app_id"] for r in critics.both_tails(df, n=5).collect()]
    assert found == [0, 1, 2, 2, 3, 3, 4, 4, 5, 6]


def test_preview(spark):
    found = critics.preview_sorted(pages(spark), ["n"], 3).collect()
    assert [r["n"] for r in found if r["stage"] == "before"] == [1, 2, 3]
    assert [r["n"] for r in found if r["stage"] == "after"] == [1, 4, 8]
    last = critics.preview_sorted(pages(spark), ["n"], 8).filter("stage = 'after'").collect()
    assert [r["n"] for r in last][-2:] == [5, 6]
