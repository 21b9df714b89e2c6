"""Column expressions that type and normalise messy review fields."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlens import constants as K

# every character that counts as white space in Unicode, spelled out so that
# all regex engines agree
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
SPACES = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def _col(column) -> Column:
    """A column from itself or its name; dots belong to the name."""
    return F.col(f"`{column}`") if isinstance(column, str) else column


def strip(column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(_col(column), F.lit(SPACES))


def collapse_spaces(column) -> Column:
    """One space between words, none at the ends."""
    return F.trim(F.regexp_replace(_col(column), f"{SPACE}+", " "))


def parse_boolean(column, vocab: str = "extended") -> Column:
    """Three-valued boolean from mixed text; unknown words become null."""
    true_words, false_words = K.BOOLEAN_WORDS[vocab]
    word = F.lower(strip(_col(column).cast("string")))
    is_true, is_false = word.isin(true_words), word.isin(false_words)
    if vocab == "rating":
        number = coerce_double(word)
        is_true = is_true | F.coalesce(number == 1, F.lit(False))
        is_false = is_false | F.coalesce(number == 0, F.lit(False))
    return F.when(is_true, F.lit(True)).when(is_false, F.lit(False))


def rating_value(column) -> Column:
    """The rating as 1.0, 0.0 or null, ready for averages."""
    return parse_boolean(column, "rating").cast("int").cast("double")


def coerce_double(column) -> Column:
    """Number from text; anything unreadable, and NaN, becomes null."""
    text = _col(column).cast("string")
    return (
        F.when(text.rlike(NUMBER), text.try_cast("double"))
        .when(text.rlike(INFINITE) & ~text.contains("-"), F.lit(float("inf")))
        .when(text.rlike(INFINITE), F.lit(float("-inf")))
    )


def numeric(df: DataFrame, name: str) -> Column:
    """``name`` as double; columns that are numbers already skip the text check."""
    field = df.schema[name].dataType
    if isinstance(field, (T.DoubleType, T.FloatType)):
        value = _col(name).cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(field, T.NumericType):
        return _col(name).cast("double")
    return coerce_double(name)


def boolean(df: DataFrame, name: str, vocab: str = "extended") -> Column:
    """``name`` as boolean; boolean columns pass through untouched."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return _col(name)
    return parse_boolean(name, vocab)


def clean_id(column) -> Column:
    """Identifier as text, without a trailing ``.0``; empty markers become null."""
    value = F.regexp_replace(strip(_col(column).cast("string")), r"\.0$", "")
    return F.when(~F.lower(value).isin(K.MISSING_ID_WORDS), value)


def text_length(column) -> Column:
    """Characters left after stripping; null counts as empty."""
    return F.length(strip(F.coalesce(_col(column), F.lit(""))))


def minutes_to_hours(column) -> Column:
    return _col(column) / F.lit(60.0)


def completion_pct(unlocked, total) -> Column:
    """Unlocked share in percent, held within 0 and 100."""
    share = F.try_divide(_col(unlocked), _col(total)) * 100
    return F.when(share.isNotNull(), F.least(F.greatest(share, F.lit(0.0)), F.lit(100.0)))


def clean_text(column, max_chars: int | None = None) -> Column:
    """Lower-case words made of a-z only, contractions spelled out.

    The whole text is used unless ``max_chars`` sets a cut
    (``constants.REVIEW_CHAR_LIMIT`` is the customary one). Texts without any
    letter become empty; ``has_words`` tells them beforehand.
    """
    text = F.coalesce(_col(column), F.lit(""))
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    text = F.replace(F.lower(text), F.lit("’"), F.lit("'"))
    text = F.replace(text, F.lit("‘"), F.lit("'"))
    spelled = text
    for pattern, words in K.CONTRACTIONS:
        spelled = F.regexp_replace(spelled, f"(?U){pattern}", words)
    text = F.when(text.contains("'"), spelled).otherwise(text)
    return F.trim(F.regexp_replace(text, "[^a-z]+", " "))


def has_words(column, max_chars: int | None = None) -> Column:
    """Would cleaning leave anything? True for texts with a letter of a-z.

    The search stops at the first such letter, so filters use it on raw text.
    The last two characters of the pattern turn into i and k when lowered.
    """
    text = F.coalesce(_col(column), F.lit(""))
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    return text.rlike("[a-zA-Z\u0130\u212A]")


def keyword_pattern(words) -> str:
    """Whole-word pattern, longest word first."""
    distinct = {word.strip().lower() for word in words}
    ordered = sorted(distinct, key=lambda word: (-len(word), word))
    return r"\b(?:" + "|".join(re.escape(word) for word in ordered) + r")\b"


def mentions(column, words) -> Column:
    """Does the cleaned text hold any of the words?"""
    return _col(column).rlike(keyword_pattern(words))


def flatten_text(column) -> Column:
    """One line of text for display."""
    return strip(F.replace(_col(column), F.lit("\n"), F.lit(" ")))


def excerpt(column, length: int = K.EXCERPT_CHARS) -> Column:
    """Collapsed text; long ones end at a word boundary with an ellipsis."""
    text = collapse_spaces(column)
    cut = F.regexp_replace(F.substring(text, 1, length), " [^ ]*$", "")
    return F.when(F.length(text) <= length, text).otherwise(F.concat(cut, F.lit("…")))


def match_pct(column) -> Column:
    """Similarity as a display percentage, never below zero."""
    return F.greatest(F.lit(0.0), _col(column)) * 100


def item_matches(name, item_id, needle: str, wanted_id=None) -> Column:
    """Case-blind literal substring of the name, or the same numeric id."""
    by_name = F.contains(F.lower(F.coalesce(_col(name), F.lit(""))), F.lit(needle.lower()))
    if wanted_id is None:
        return by_name
    by_id = F.coalesce(coerce_double(item_id) == F.lit(float(wanted_id)), F.lit(False))
    return by_id | by_name
