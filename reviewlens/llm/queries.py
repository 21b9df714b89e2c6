"""The registered queries: each applies one operator to its whole table.

Digest columns are derived here from the operators' real outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import byte_pairs, decontaminate, exact_dedup, hard_negatives, lexical_search, line_dedup, minhash, pii, quality, sentencepieces, substring_dedup, suffix_dedup, toxicity
from reviewlens.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *(
        s[part].cast("string") for part in ("kind", "start", "end")))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *(count(k) for k in pii.BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "text")
    coded = sentencepieces.decode(sentencepieces.encode(read).drop("text"))
    decoded = F.sha2("decoded", 256)
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"), decoded.alias("decoded_sha256"),
        (decoded == F.col("text_sha256")).alias("round_trip"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hard_negatives.hard_negatives(
        rows.select("vec_id", label.alias("label"), F.when(hard_negatives.complete("embedding"), scaled).alias("vector")),
        anchors=F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_pairs.encode(docs, places=False).drop("text")
    found = byte_pairs.decode(coded, as_bytes=True)
    return found.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_personal_data": op6_personal_data,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_byte_pairs": op13_byte_pairs,
}

#: Learned scores, edit distances of characters, tokens and scans for spans are not SQL, and every 100-byte string is too
#: much of it; tests/llm checks those queries against plain Python.
ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[p : p + 4], ' ') END AS shingle
  FROM w, unnest(range(1, greatest(2, len(words) - 3))) t(p) WHERE len(words) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON y.shingle = x.shingle AND x.doc_id < y.doc_id
                    GROUP BY x.doc_id, y.doc_id) JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b
  WHERE 100 * common >= 75 * (m.n + o.n - common)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
""",
    "op5_substring_dedup": r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
later AS MATERIALIZED (
  SELECT doc_id, p FROM (SELECT doc_id, p, md5(array_to_string(words[p : p + 19], ' ')) AS k FROM w, unnest(range(1, len(words) - 18)) t(p))
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
placed AS (SELECT doc_id, q, words[q] AS word FROM w, unnest(range(1, len(words) + 1)) t(q)),
marked AS (SELECT y.doc_id, y.q, y.word, coalesce(l.p > y.q - 20, FALSE) AS gone
           FROM placed y ASOF LEFT JOIN later l ON l.doc_id = y.doc_id AND l.p <= y.q)
SELECT w.doc_id, len(w.words) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY q) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM w LEFT JOIN marked m ON m.doc_id = w.doc_id GROUP BY w.doc_id, w.words
""",
    "op10_exact_dedup": r"""
WITH x AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM x GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM x JOIN g USING (norm)
""",
    "op11_hard_negatives": r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, r.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
found AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
""",
    "op12_lexical_search": r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM i, unnest(terms) t(term) GROUP BY ALL),
totals AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d WHERE len(terms) > 0),
tf AS MATERIALIZED (SELECT doc_id, len(terms) AS n, term, count(*) AS tf FROM d, unnest(terms) t(term)
                    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // all_terms)))) AS BIGINT) AS score
  FROM tf JOIN w USING (term) JOIN q USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
""",
}
