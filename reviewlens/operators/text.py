"""TF-IDF as joins and aggregations over (document, term) rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from reviewlens import constants as K
from reviewlens.operators.sampling import top_k_per_group
from reviewlens.session import materialize

WORD = r"[\p{L}\p{N}_]{2,}"
#: Rows (document, term) that one task takes, whatever the size of the corpus.
TERM_ROWS = 1 << 20
#: Words counted in one call; a longer document is a call of its own.
WORDS_AT_ONCE = 1 << 18


def default_stop_words() -> list[str]:
    return sorted(set(K.ENGLISH_STOP_WORDS) | set(K.CUSTOM_STOP_WORDS))


def clean_tokens(text: str) -> Column:
    """Words of already cleaned text, two letters or more."""
    return F.filter(F.split(text, " "), lambda word: F.length(word) >= 2)


def raw_tokens(text: str) -> Column:
    """Lower-case words of raw text, two characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its distinct words and pairs of neighbouring words in ``_words``, with their numbers."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("_words")), 0).to_numpy())
        for _, rows in groupby(range(len(ends)), lambda i: ends[i] // WORDS_AT_ONCE):
            rows = list(rows)
            part = batch.slice(rows[0], len(rows))
            words = part.column("_words").flatten()
            row = np.repeat(np.arange(len(rows)), pc.fill_null(pc.list_value_length(part.column("_words")), 0).to_numpy())
            if not len(words):
                continue
            near = row[1:] == row[:-1]
            pairs = pc.binary_join_element_wise(words[:-1].filter(pa.array(near)), words[1:].filter(pa.array(near)), " ")
            coded = pa.concat_arrays([words, pairs]).dictionary_encode()
            size = len(coded.dictionary)
            found, counts = np.unique(np.concatenate([row, row[1:][near]]) * size + coded.indices.to_numpy(), return_counts=True)
            keys = [part.column(i).take(pa.array(found // size)) for i, name in enumerate(part.schema.names) if name != "_words"]
            names = [name for name in part.schema.names if name != "_words"]
            yield pa.RecordBatch.from_arrays([*keys, coded.dictionary.take(pa.array(found % size)), pa.array(counts, pa.int64())], names=[*names, "term", "_tf"])


def tfidf(
    docs: DataFrame, key: str, tokens: Column, by: Sequence[str] = (), carry: Sequence[str] = (),
    stop_words: Sequence[str] | None = None, min_documents: int | None = None,
    max_share: float = K.TFIDF_MAX_SHARE, max_features: int | None = K.TFIDF_MAX_FEATURES,
    sublinear: bool = True,
) -> DataFrame:
    """Unit-length TF-IDF weights as rows (``by``…, ``carry``…, key, term, weight).

    ``key`` is unique per row, rows that repeat it count as one document; ``by`` splits the rows into separate corpora and
    ``carry`` names further columns to keep. Without ``min_documents`` a term
    needs one document in a hundred, at least 2 and at most 10. Without
    ``max_features`` every such term stays.
    """
    by, carry = list(by), list(carry)
    stop_words = default_stop_words() if stop_words is None else stop_words
    rows = [*by, *carry, key]
    # texts move once, by document; their terms are counted there, and no task holds more than a few documents' terms
    placed = docs.select(*rows, tokens.alias("_tokens")).repartition(key)
    words = placed.select(*rows, F.monotonically_increasing_id().alias("_row"), F.filter("_tokens", lambda word: ~word.isin(list(stop_words))).alias("_words"))
    schema = T.StructType([*words.drop("_words").schema.fields, T.StructField("term", T.StringType()), T.StructField("_tf", T.LongType())])
    # vocabulary and weights both read the counts
    counted = materialize(words.mapInArrow(_term_counts, schema))
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-counted.count() // TERM_ROWS))
    several = counted.groupBy(*rows).agg(F.min("_row").alias("a"), F.max("_row").alias("b")).where("a != b")
    if not several.isEmpty():
        counted = materialize(counted.repartition(parts, key, "term").groupBy(*rows, "term").agg(F.sum("_tf").alias("_tf")))
    # as a table its true size is known, so it is broadcast if it is small and the term rows then stay where they are
    vocabulary = materialize(_vocabulary(docs, counted, by, min_documents, max_share, max_features, parts))
    joined = counted.join(vocabulary, [*by, "term"])
    frequency = 1 + F.log("_tf") if sublinear else F.col("_tf").cast("double")
    weighted = joined.select(*rows, "term", (frequency * F.col("_idf")).alias("_w")).repartition(parts, key)
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return weighted.select(*rows, "term", (F.col("_w") / length).alias("weight"))


def _vocabulary(docs, counted, by, min_documents, max_share, max_features, parts) -> DataFrame:
    """Kept terms with their weights, per corpus."""
    # most pairs of words are rare, so sums before the shuffle would fill memory and save little
    seen = counted.repartition(parts, *by, "term").groupBy(*by, "term").agg(
        F.count(F.lit(1)).alias("_df"), F.sum("_tf").alias("_corpus")
    )
    if by:
        seen = seen.join(docs.groupBy(*by).agg(F.count(F.lit(1)).alias("_docs")), by)
    else:
        seen = seen.withColumn("_docs", docs.agg(F.count(F.lit(1)).alias("n")).scalar())
    fewest = (
        F.lit(min_documents) if min_documents is not None
        else F.least(F.lit(K.TFIDF_MIN_DOCUMENTS), F.greatest(F.lit(2), F.floor(F.col("_docs") / 100)))
    )
    kept = seen.filter((F.col("_df") >= fewest) & (F.col("_df") <= F.col("_docs") * max_share))
    order = [F.desc("_corpus"), F.col("term")]
    if by:
        kept = top_k_per_group(kept, by, order, max_features, salt=F.xxhash64("term"))
    elif max_features is not None:
        kept = kept.orderBy(*order).limit(max_features)
    idf = F.log((1 + F.col("_docs")) / (1 + F.col("_df"))) + 1
    return kept.select(*by, "term", idf.alias("_idf"))


def tfidf_difference(
    docs: DataFrame, key: str, text: str = "text", side: str = "side", **options
) -> DataFrame:
    """Mean weight in high documents minus mean weight in low ones, per term.

    The means run over all documents of a side, also those without any term.
    """
    weights = tfidf(docs, key, clean_tokens(text), carry=[side], **options)
    sizes = docs.agg(
        F.struct(
            F.count_if(F.col(side) == "low").alias("low"),
            F.count_if(F.col(side) == "high").alias("high"),
        )
    ).scalar()
    def mean(name):
        total = F.sum(F.when(F.col(side) == name, F.col("weight")).otherwise(0.0))
        return total / sizes.getField(name)

    return weights.groupBy("term").agg((mean("high") - mean("low")).alias("difference"))


def top_terms(differences: DataFrame, n: int = K.TOP_TERMS) -> DataFrame:
    """Most distinctive terms of each side, scores per thousand."""
    score = F.round(F.abs("difference") * 1000, 6)
    sided = differences.filter("difference <> 0").select(
        F.when(F.col("difference") > 0, "high").otherwise("low").alias("side"), "term", score.alias("score")
    )
    return top_k_per_group(sided, ["side"], [F.desc("score"), F.col("term")], n, "rank")
