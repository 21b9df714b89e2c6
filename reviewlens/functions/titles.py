"""Title keys, page slugs and numeral swaps."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import _col, collapse_spaces


def title_key(column) -> Column:
    """Join key for titles: lower case, no trademark signs, no punctuation."""
    title = F.translate(F.lower(_col(column)), "™®©", "")
    title = F.regexp_replace(title, r"[:\-/,]", " ")
    title = F.regexp_replace(title, r"[^a-z0-9\s\x0B\x1C-\x1F\x85\p{Z}]", "")
    return collapse_spaces(title)


def unstable_class() -> str:
    """Regex class of all characters that NFKC normalisation would change.

    Derived from the Unicode tables at import, so that the JVM can apply it
    without a Python round trip.
    """
    ranges: list[list[int]] = []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.is_normalized("NFKC", chr(code)):
            continue
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


UNSTABLE = unstable_class()


def to_roman(column) -> Column:
    """Lower-case numeral for 1 to 4999, else null."""
    number = _col(column).cast("int")

    def digit(names, power):
        values = F.array(*[F.lit(name) for name in names])
        return F.get(values, F.floor(number / power).cast("int") % 10)

    numeral = F.concat(
        digit(K.ROMAN_THOUSANDS, 1000),
        digit(K.ROMAN_HUNDREDS, 100),
        digit(K.ROMAN_TENS, 10),
        digit(K.ROMAN_UNITS, 1),
    )
    return F.when(number.between(1, K.ROMAN_MAX), numeral)


def from_roman(column) -> Column:
    """Value of a canonical numeral, else null."""
    numeral = F.lower(_col(column))

    def value(group, names):
        values = F.array(*[F.lit(name) for name in names])
        part = F.regexp_extract(numeral, K.ROMAN_PATTERN, group)
        return F.array_position(values, part) - 1

    total = (
        value(1, K.ROMAN_THOUSANDS) * 1000
        + value(2, K.ROMAN_HUNDREDS) * 100
        + value(3, K.ROMAN_TENS) * 10
        + value(4, K.ROMAN_UNITS)
    )
    valid = numeral.rlike(K.ROMAN_PATTERN) & (numeral != "")
    return F.when(valid, total.cast("int"))


def slug_base(column) -> Column:
    """Title prepared for slugs: stable characters, separators as spaces."""
    base = F.regexp_replace(F.lower(_col(column)), rf"(?![\x00-\x7F]){UNSTABLE}", " ")
    base = F.regexp_replace(base, "[:*]", " ")
    base = F.regexp_replace(base, r"\((tm|r|c)\)", " ")
    return F.replace(base, F.lit("goty"), F.lit("game of the year"))


def _slug(base: Column) -> Column:
    kept = F.regexp_replace(base, r"[^a-z0-9\-\s\x0B\x1C-\x1F\x85\p{Z}]", "")
    return F.replace(collapse_spaces(kept), F.lit(" "), F.lit("-"))


def slug_candidates(column, template: str = K.CRITIC_URL) -> Column:
    """Candidate page addresses for a title, most likely first, no repeats.

    The second candidate swaps the first arabic number for its numeral, or,
    when there is none, the first numeral-like word for its number.
    """
    base = slug_base(column)
    arabic = F.regexp_extract(base, r"(?U)\b([0-9]+)\b", 1)
    roman = F.regexp_extract(base, r"(?U)\b([ivxlcm]+)\b", 1)

    def swapped(found, replacement):
        return F.regexp_replace(base, F.concat(F.lit(r"(?U)\b"), found, F.lit(r"\b")), replacement)

    as_roman = to_roman(arabic.try_cast("int"))
    as_arabic = from_roman(roman).cast("string")
    variant = F.when(
        arabic != "", F.when(as_roman.isNotNull(), swapped(arabic, as_roman))
    ).when(roman != "", F.when(as_arabic.isNotNull(), swapped(roman, as_arabic)))
    before, after = template.split("%s")

    def page(text):
        return F.concat(F.lit(before), _slug(text), F.lit(after))

    return F.array_distinct(F.array_compact(F.array(page(base), page(variant))))
