"""Critic pages: field extraction, cleaning, title matching and deltas."""

from __future__ import annotations

import html as markup
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens import constants as K
from reviewlens.functions.clean import SPACE, numeric, strip
from reviewlens.functions.titles import title_key
from reviewlens.operators.sampling import dedupe
from reviewlens.session import materialize

# "&amp;" comes last, so that no reference is read twice
COMMON_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&amp;": "&"}
# a tag goes together with the space around it, so pieces of text join up
TAG = rf"{SPACE}*<[^>]*>{SPACE}*"
# field -> (patterns, type of the field): each pattern has one group and is applied to what the one before it left
CRITIC_PAGE_FIELDS = {
    "Title": ([r'(?s)<div[^>]*class="[^"]*subpage-header__navigation[^"]*"[^>]*>(.*?)</div>'], "string"),
    "Metascore": (
        [r'(?s)<div[^>]*class="[^"]*score-card-left__score-number[^"]*"[^>]*>(.*?)</div>',
         r"(?s)<span[^>]*>(.*?)</span>", r"^\s*(\d+)\s*$"],
        "int",
    ),
    "NumberOfCriticReviews": (
        [r"""(?s)<(?:div|span|p)[^>]*class=["'][^"']*count[^"']*["'][^>]*>(.*?)</(?:div|span|p)>""", K.CRITIC_COUNT_PATTERN], "int",
    ),
}


def unescape(column: Column) -> Column:
    """Character references such as ``&amp;`` as the characters they stand for.

    The common ones are replaced in the JVM. Spark has no function for the full
    set of named references, so texts in which others are left pass through Arrow.
    """

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(markup.unescape, na_action="ignore")

    plain = column
    for code, sign in COMMON_REFERENCES.items():
        plain = F.regexp_replace(plain, code, sign)
    # a text whose references are all common ones never leaves the JVM's fast path: it holds no other "&"
    others = F.regexp_replace(column, "|".join(COMMON_REFERENCES), "")
    return F.when(F.contains(others, F.lit("&")), decode(F.when(F.contains(others, F.lit("&")), column))).otherwise(plain)


def extract_page_fields(
    pages: DataFrame, fields: Mapping[str, tuple[str | Sequence[str], str]] = CRITIC_PAGE_FIELDS, html: str = "html"
) -> DataFrame:
    """Add one column per field; a page without it gets null.

    A field's first pattern cuts out its block, the next ones look inside it;
    before the last of several patterns tags are taken out. Each pattern reads
    its text once.
    """

    def first(text, pattern):
        return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))

    def field(patterns, kind):
        patterns = [patterns] if isinstance(patterns, str) else list(patterns)
        found = first(F.col(html), patterns[0])
        for i, pattern in enumerate(patterns[1:], start=1):
            # digits of a tagged number stay apart from their neighbours, so single tags just go
            found = first(F.regexp_replace(found, "<[^>]*>", "") if i == len(patterns) - 1 else found, pattern)
        if kind == "string":
            return strip(unescape(F.regexp_replace(found, TAG, "")))
        return strip(found).try_cast(kind)

    return pages.withColumns({name: field(*spec) for name, spec in fields.items()})


def critic_filter() -> Column:
    """Pages with a score and enough critics."""
    return F.col("Metascore").isNotNull() & (F.col("NumberOfCriticReviews") >= K.MIN_CRITIC_REVIEWS)


def type_critics(df: DataFrame) -> DataFrame:
    """Score and critic count as numbers; unreadable ones become null."""
    return df.withColumns(
        {name: numeric(df, name) for name in ("Metascore", "NumberOfCriticReviews")}
    )


def clean_critics(df: DataFrame) -> DataFrame:
    return type_critics(df).filter(critic_filter())


def with_row_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Gapless row numbers from 1 in a global order, without sorting in one task.

    Rows are range-sorted and written once. Their number inside each sorted
    part is then shifted by the sizes of the parts before it; only those part
    sizes, one row per shuffle partition, pass through a single window and are
    broadcast. ``order`` should be unique, which also keeps the parts even.
    """
    placed = F.monotonically_increasing_id()
    rows = materialize(df.orderBy(*order).withColumn("_at", placed))
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within)
        .drop("_part", "_at", "_start")
    )


def to_json_records(df: DataFrame, order: Sequence[str], keep: Column, columns: Sequence[str]) -> DataFrame:
    """JSON text per kept row; ``id`` is the row position before the filter.

    ``id`` and ``url`` come first and empty fields are left out.
    """
    rest = [name for name in columns if name != "url"]
    first = [F.col("position").cast("string").alias("id")]
    if "url" in columns:
        first.append(F.col("url"))
    record = F.to_json(F.struct(*first, *rest), {"ignoreNullFields": "true"})
    kept = with_row_position(df, order).filter(keep)
    return kept.select("position", record.alias("record"))


def dedupe_critics(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per (platform, url), then first per (platform, title)."""
    columns = [F.col(name) for name in order]
    if "url" in df.columns:
        df = dedupe(df, ["Platform", "url"], columns)
    return dedupe(df, ["Platform", "Title"], columns)


def preview_sorted(df: DataFrame, order: Sequence[str], n: int = K.PREVIEW_ROWS) -> DataFrame:
    """First rows before and after sorting by title."""
    before = df.orderBy(*order).limit(n).withColumn("stage", F.lit("before"))
    after = df.orderBy(F.col("Title").asc_nulls_last(), *order).limit(n)
    return before.unionByName(after.withColumn("stage", F.lit("after")))


def match_titles(items: DataFrame, critics: DataFrame) -> DataFrame:
    """Items and critic pages with the same title key; equal keys fan out.

    Titles without Latin letters or digits have an empty key, which says
    nothing, and match nothing; ``empty_titles`` counts them.
    """
    keyed = items.withColumn("merge_name", title_key("app_name")).filter("merge_name <> ''")
    pages = critics.withColumn("merge_name", title_key("Title")).filter("merge_name <> ''")
    return keyed.join(pages, "merge_name")


def empty_titles(items: DataFrame, critics: DataFrame) -> DataFrame:
    """How many titles of either side have an empty key and so cannot match."""
    sides = [(items, "app_name", "items"), (critics, "Title", "critics")]
    counts = [df.agg(F.lit(side).alias("side"), F.count_if(title_key(title) == "").alias("empty_titles"))
              for df, title, side in sides]
    return counts[0].unionByName(counts[1])


def add_delta(df: DataFrame) -> DataFrame:
    """Normalised score and its distance to the player consensus, where absent."""
    if "Metascore_Normalized" not in df.columns:
        df = df.withColumn("Metascore_Normalized", F.col("Metascore") / 100.0)
    if "delta" not in df.columns:
        df = df.withColumn("delta", F.col("steam_consensus") - F.col("Metascore_Normalized"))
    return df


def both_tails(df: DataFrame, column: str = "delta", key: str = "app_id", n: int = K.TAIL_SIZE) -> DataFrame:
    """The n highest and n lowest rows together; short tables repeat rows."""
    known = df.filter(F.col(column).isNotNull())
    high = known.orderBy(F.desc(column), key).limit(n)
    low = known.orderBy(column, key).limit(n)
    return high.unionByName(low).orderBy(column, key)
