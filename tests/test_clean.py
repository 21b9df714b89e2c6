import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from reviewlens import constants as K
from reviewlens.functions import clean


def test_boolean_vocabularies(evaluate):
    words = ["True", " TRUE ", "1", "1.0", "yes", "0.0", "no", "recommended", "not recommended", "t", "", None]
    assert evaluate(words, clean.parse_boolean) == [
        True, True, True, True, True, False, False, None, None, None, None, None]
    assert evaluate(words, lambda c: clean.parse_boolean(c, "basic")) == [
        True, True, True, None, True, None, False, None, None, None, None, None]
    assert evaluate(words, clean.rating_value) == [1, 1, 1, 1, 1, 0, 0, 1, 0, None, None, None]
    assert evaluate([True, False, None], clean.parse_boolean, "boolean") == [True, False, None]
    assert evaluate([1.0, 0.0, 2.0], clean.rating_value, "double") == [1.0, 0.0, None]


def test_numbers(evaluate):
    raw = ["1", " 2.5 ", "-3e2", "x", "", None, "1d", "nan", "inf", "-Infinity", "1.", ".5"]
    found = evaluate(raw, clean.coerce_double)
    assert found == [1, 2.5, -300, None, None, None, None, None, math.inf, -math.inf, 1, 0.5]


def test_ids(evaluate):
    raw = [" 42.0 ", "42", "nan", "<NA>", "", None, "4.05", "None", "7.00"]
    assert evaluate(raw, clean.clean_id) == ["42", "42", None, None, None, None, "4.05", None, "7.00"]


def test_text_length_strips_any_space(evaluate):
    assert evaluate(["  ab　\n", None, "", " a b "], clean.text_length) == [2, 0, 0, 3]


CLEANED = {
    "I can't, won't; it's the dev's fault": "i cannot will not it is the dev fault",
    "They’re laggy": "they are laggy",
    "I've said they'll say I'd": "i have said they will say i would",
    "don't": "do not",
    "there's what's that's I'm": "there is what is that is i am",
    "éart": "art",
    "écan't": "can t",
    "  Café 2 GO!! ": "caf go",
    "123 !!!": "",
}


def test_clean_text(evaluate):
    assert evaluate(list(CLEANED), clean.clean_text) == list(CLEANED.values())
    assert evaluate([None], clean.clean_text) == [""]


def test_clean_text_takes_whole_texts_unless_cut(evaluate):
    long = "a" * 2001
    assert evaluate([long], clean.clean_text) == [long]
    assert evaluate([long], lambda c: clean.clean_text(c, K.REVIEW_CHAR_LIMIT)) == ["a" * 2000]


def test_has_words_agrees_with_cleaning(evaluate):
    texts = [*CLEANED, None, "", "ÀÉ", "\u212A", "\u0130", "x" * 3]
    cleaned = evaluate(texts, clean.clean_text)
    assert evaluate(texts, clean.has_words) == [text != "" for text in cleaned]


def test_keywords_are_whole_words(evaluate):
    texts = ["the artist", "great art here", "dlc", "art"]
    assert evaluate(texts, lambda c: clean.mentions(c, ["art", " DLC ", "art"])) == [False, True, True, True]
    assert clean.keyword_pattern(["ab", "abc", "ab", "b"]) == r"\b(?:abc|ab|b)\b"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("a b", "a b"),
        ("  a \n\t b ", "a b"),
        ("x" * 420, "x" * 420),
        ("x" * 421, "x" * 420 + "…"),
        ("word " * 100, " ".join(["word"] * 84) + "…"),
    ],
)
def test_excerpt(evaluate, text, expected):
    assert evaluate([text], clean.excerpt) == [expected]


def test_small_expressions(evaluate, spark):
    assert evaluate([90.0], clean.minutes_to_hours, "double") == [1.5]
    assert evaluate([-0.2, 0.25], clean.match_pct, "double") == [0.0, 25.0]
    assert evaluate([" a\nb "], clean.flatten_text) == ["a b"]
    rows = spark.createDataFrame([(5, 10), (20, 10), (1, 0), (-1, 10)], "u int, t int")
    assert [r[0] for r in rows.select(clean.completion_pct("u", "t")).collect()] == [50, 100, None, 0]
    names = spark.createDataFrame([("7", "Great Sea"), ("8.0", None), ("x", "sea.dog")], "id string, name string")
    hit = names.select(clean.item_matches("name", "id", "SEA.", 8)).collect()
    assert [r[0] for r in hit] == [False, True, True]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_strip_equals_python(evaluate, texts):
    texts = [t.replace("\x00", "").encode("utf8", "ignore").decode() for t in texts]
    assert evaluate(texts, clean.strip) == [t.strip() for t in texts]
