"""Exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed size. Sorting the blocks
gives every distinct block an integer name; then adjacent names are paired
and the pairs sorted and named again, until one name is left per document.
Names are ranks in a sort of the real values, so two documents end with the
same name exactly if their texts are equal. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import of_ids, stage

#: A white-space run counts as one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Characters in a block.
BLOCK_CHARS = 2048
#: Sort buckets; a bucket holds this share of the distinct values.
BUCKETS = 1 << 20
#: A value with at least this share of the rows is named from a small list of its own.
HOT_SHARE = 1 / 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def sorted_names(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add a long ``name``, the same for two rows exactly if their ``keys`` are equal.

    Rows are dealt by a hash bucket and sorted inside it; a name is the bucket
    and the dense rank. At most ``1 / HOT_SHARE`` values can hold that share of
    the rows; those are named from their own sorted list, whose size that
    bounds, and never meet in one bucket.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r["_hash"] for r in counts.where(F.col("n") >= max(1000, total * HOT_SHARE)).select("_hash").collect()]
    bucket = F.pmod("_hash", F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*keys)).cast("long")
    by_sort = lambda part: (
        part.withColumn("_bucket", bucket)
        .withColumn(name, F.shiftleft("_bucket", 40) + rank).drop("_bucket", "_hash")
    )
    if not hot:
        return by_sort(hashed)
    is_hot = F.col("_hash").isin(hot)
    # a few hundred distinct values at most, so one sorted list; negative names stay apart from the others
    listed = hashed.where(is_hot).select(*keys).distinct()
    listed = listed.withColumn(name, -F.row_number().over(Window.orderBy(*keys)).cast("long"))
    right = listed.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    few = hashed.where(is_hot).join(F.broadcast(right), same).drop("_hash", *[f"_{k}" for k in keys])
    return by_sort(hashed.where(~is_hot)).unionByName(few)


def document_names(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, sha256 hex of the normalised text, copies, level, name.

    (level, name) is equal for two rows exactly if their normalised texts are.
    """
    whole = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    cut = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
    blocks = whole.select("doc_id", F.sha2("norm", 256).alias("sha"), F.posexplode(cut).alias("place", "block"))
    named = sorted_names(blocks, ["block"], "name").drop("block")
    # a row that repeats in full repeats its places, so places are made unique again
    sequence = F.array_sort(F.array_distinct(F.collect_list(F.struct("place", "name"))))
    state = stage(
        named.groupBy("doc_id", "sha")
        .agg(sequence["name"].alias("names"), F.sum((F.col("place") == 0).cast("long")).alias("copies")),
        "names",
    )
    done, level = [], 0
    while True:
        one = F.size("names") == 1
        done.append(state.where(one).select("doc_id", "sha", "copies", F.lit(level).alias("level"),
                                            F.col("names")[0].alias("name")))
        state = state.where(~one)
        if state.isEmpty():
            break
        level += 1
        # get() gives null past the end: an odd last name pairs with nothing
        pairs = F.transform(F.sequence(F.lit(0), F.size("names") - 1, F.lit(2)), lambda j: F.struct(
            F.get("names", j).alias("a"), F.get("names", j + 1).alias("b")))
        rows = state.select("doc_id", "sha", "copies", F.posexplode(pairs).alias("place", "pair"))
        named = sorted_names(rows.select("doc_id", "sha", "copies", "place", "pair.a", "pair.b"), ["a", "b"], "name")
        sequence = F.array_sort(F.collect_list(F.struct("place", "name")))
        state = stage(named.groupBy("doc_id", "sha", "copies").agg(sequence["name"].alias("names")), "names")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each document.

    Texts are equal when they are identical after each white-space run became
    one space; the smallest doc_id of equal texts stays. A null text counts as
    empty. Rows that repeat doc_id and text give one row and count each in
    group_size. Rows without doc_id belong to their text's group and stay only
    if the whole group has no doc_id. An empty table gives an empty result;
    other columns of the input are not read.
    """
    names = document_names(docs, block_chars)
    groups = names.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return names.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, with all their columns; doc_id is taken as their key, null included."""
    return of_ids(docs, "doc_id", exact_dedup(docs, block_chars).where("kept").select("doc_id"), "left_semi")
