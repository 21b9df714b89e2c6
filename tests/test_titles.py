import unicodedata

from pyspark.sql import functions as F

from reviewlens.functions import titles


def test_title_key(evaluate):
    raw = ["Tom's Game™: GOTY", "A-B/C, D", "  ÉCLAIR®  x ", "一二", None]
    assert evaluate(raw, titles.title_key) == ["toms game goty", "a b c d", "clair x", "", None]


def test_slugs(evaluate):
    raw = ["Saga VII", "Saga 7", "Mix 2", "Year 9999", "A*B (R)", "a＊b", "Game GOTY", "The Mix", "Part IIII", "No-1 of 1"]
    found = evaluate(raw, lambda c: titles.slug_candidates(c, "%s"))
    assert found == [
        ["saga-vii", "saga-7"], ["saga-7", "saga-vii"], ["mix-2", "mix-ii"], ["year-9999"], ["a-b"], ["a-b"],
        ["game-game-of-the-year"], ["the-mix", "the-1009"], ["part-iiii"], ["no-1-of-1", "no-i-of-i"],
    ]


def test_numerals_both_ways(spark):
    numbers = spark.range(1, 5000).withColumn("roman", titles.to_roman("id"))
    wrong = numbers.filter(~titles.from_roman("roman").eqNullSafe(F.col("id").cast("int")))
    assert wrong.count() == 0
    known = {4: "iv", 1994: "mcmxciv", 4999: "mmmmcmxcix"}
    for row in numbers.filter(F.col("id").isin(list(known))).collect():
        assert row["roman"] == known[row["id"]]


def test_numeral_limits(evaluate):
    assert evaluate([0, 5000, None], titles.to_roman, "int") == [None, None, None]
    assert evaluate(["", "iiii", "vx", "MIX", "d"], titles.from_roman) == [None, None, None, 1009, 500]


def test_unstable_characters_become_spaces(evaluate):
    signs = ["x" + chr(c) + "y" for c in (0xE9, 0x2122, 0xFF0A, 0x3000, 0x2160, 0x4E00, 0xFB01)]
    expected = ["x y" if unicodedata.normalize("NFKC", s) != s else s for s in signs]
    assert evaluate(signs, titles.slug_base) == expected
