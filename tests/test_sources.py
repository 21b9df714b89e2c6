import json
import os
import time

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import cohorts, critics
from reviewlens.sources import tables

CSV = '''row,review_id,app_id,app_name,review,recommended,author.playtime_at_review,extra
0,1,10,"Big ""One""","two
lines, one text",True,12.5,x
1,2,10,Small,,no,abc,y
'''


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_read_reviews_by_name(spark, csv_path):
    df = tables.read_reviews(spark, csv_path)
    assert df.columns == ["review_id", "app_id", "app_name", "review", "recommended", "author.playtime_at_review"]
    first, second = df.orderBy("review_id").collect()
    assert first["app_name"] == 'Big "One"' and first["review"] == "two\nlines, one text"
    assert second["review"] is None and second["author.playtime_at_review"] == "abc"


def test_read_reviews_prunes_and_checks_columns(spark, csv_path):
    typed = tables.read_reviews(spark, csv_path, "review_id long, `author.playtime_at_review` double", ["review_id"])
    assert typed.dtypes == [("review_id", "bigint")]
    pruned = tables.read_reviews(spark, csv_path, columns=["review_id", "recommended"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<review_id:string,recommended:string>" in plan
    with pytest.raises(ValueError, match="votes_helpful"):
        tables.read_reviews(spark, csv_path, columns=["review_id", "votes_helpful"])


def test_export_to_cohorts(spark, csv_path):
    raw = tables.read_reviews(spark, csv_path).withColumns({"received_for_free": F.lit("no"), "votes_helpful": F.lit("1")})
    dotted = cohorts.processed(raw, "author.playtime_at_review")
    plain = cohorts.processed(tables.plain_names(raw))
    assert dotted.collect() == plain.collect()
    assert sorted(r["is_early_positive"] for r in plain.collect()) == [0, 1]
    both = raw.withColumn("playtime_at_review", F.lit(1))
    assert "playtime_minutes" in tables.plain_names(both).columns and "playtime_at_review" in tables.plain_names(both).columns


def test_processed_table_round_trip(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_processed(spark.range(5).withColumn("x", F.lit("y")), path)
    loaded = tables.load_processed(spark, path, ["id"])
    assert loaded.columns == ["id"] and loaded.count() == 5
    with pytest.raises(ValueError, match="missing columns z"):
        tables.load_processed(spark, path, ["z"])


def test_csv_and_append_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "hi", now'), (2, None)], "id int, t string")
    tables.write_csv(rows, str(tmp_path / "c"))
    back = tables.read_reviews(spark, str(tmp_path / "c"), "id int, t string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, 'say "hi", now'), (2, None)]
    for _ in range(2):
        tables.append_results(rows, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", 9.0, "u/1"), (2, None, 8.0, "u/2")], "n int, Title string, Metascore double, url string")
    records = critics.to_json_records(df, ["n"], F.lit(True), ["Title", "url"])
    tables.write_json_records(records, str(tmp_path / "j"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(lines, key=lambda r: r["id"]) == [{"id": "1", "url": "u/1", "Title": "A"}, {"id": "2", "url": "u/2"}]


def test_refresh_only_when_stale(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(3).write.parquet(source)
    built = []

    def build(session, path):
        built.append(path)
        return session.read.parquet(path)

    for force, expected in ((False, 1), (False, 1), (True, 2)):
        assert tables.refresh_if_stale(spark, source, target, build, force).count() == 3
        assert len(built) == expected
    late = time.time() + 60
    for name in os.listdir(source):
        os.utime(os.path.join(source, name), (late, late))
    tables.refresh_if_stale(spark, source, target, build)
    assert len(built) == 3
    with pytest.raises(FileNotFoundError):
        tables.refresh_if_stale(spark, str(tmp_path / "none"), target, build)


def test_a_failed_build_leaves_the_old_table(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(3).write.parquet(source)
    tables.refresh_if_stale(spark, source, target, lambda session, path: session.read.parquet(path))
    reader = tables.current_table(spark, target)
    spark.range(3, 10).write.mode("append").parquet(source)

    def broken(session, path):
        # some rows are written before one of them fails
        return session.read.parquet(path).select(F.when(F.col("id") == 9, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))

    with pytest.raises(Exception, match="broken"):
        tables.refresh_if_stale(spark, source, target, broken)
    assert sorted(r[0] for r in tables.current_table(spark, target).collect()) == [0, 1, 2] == sorted(r[0] for r in reader.collect())
    assert tables.refresh_if_stale(spark, source, target, lambda session, path: session.read.parquet(path)).count() == 10
    # who still reads the old version finds its files
    assert reader.count() == 3


def test_only_changed_files_are_built(spark, tmp_path):
    source, target = tmp_path / "s", str(tmp_path / "t")
    for name, low in (("a", 0), ("b", 10), ("c", 20)):
        spark.range(low, low + 3).coalesce(1).write.parquet(str(source / name))
    calls = []

    def doubled(session, files):
        calls.append({f.split("/")[-2] for f in files})
        return session.read.parquet(*files).selectExpr("id * 2 AS id")

    ids = lambda rows: sorted(r[0] for r in rows.collect())
    refresh = lambda **more: tables.refresh_if_stale(spark, str(source), target, doubled, row_wise=True, **more)
    assert ids(refresh()) == [0, 2, 4, 20, 22, 24, 40, 42, 44]
    assert ids(refresh()) == [0, 2, 4, 20, 22, 24, 40, 42, 44] and calls == [{"a", "b", "c"}]
    spark.range(100, 102).coalesce(1).write.mode("overwrite").parquet(str(source / "b"))
    spark.range(50, 51).coalesce(1).write.parquet(str(source / "d"))
    assert ids(refresh()) == [0, 2, 4, 40, 42, 44, 100, 200, 202] and calls[1:] == [{"b", "d"}]
    for file in (source / "a").iterdir():
        file.unlink()
    assert ids(refresh()) == [40, 42, 44, 100, 200, 202] and len(calls) == 2
    assert ids(refresh(force=True)) == [40, 42, 44, 100, 200, 202] and calls[2:] == [{"b", "c", "d"}]


def test_stored_reviews_are_split(spark, csv_path, tmp_path):
    target = str(tmp_path / "stored")
    rows = tables.store_reviews(spark, csv_path, target, 2, columns=["review_id", "review"])
    assert sorted(r["review_id"] for r in rows.collect()) == ["1", "2"] and rows.columns == ["review_id", "review"]
    assert len([f for f in os.listdir(target) if f.endswith(".parquet")]) == 2
