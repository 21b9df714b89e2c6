"""DuckDB SQL for the registered queries, written independently of the Spark code."""

from __future__ import annotations

from reviewlens import constants as K
from reviewlens.adapters import THEME_ONE, THEME_TWO
from reviewlens.functions.clean import SPACE
from reviewlens.functions.titles import UNSTABLE

VIEWS = {
    "plays": """
SELECT event_id AS review_id, user_id AS app_id, event_id % 500 AS rater_id,
       event_type IN ('signup', 'purchase', 'view') AS recommended,
       value * 30 AS playtime_minutes, event_id % 7 = 0 AS received_for_free,
       CAST(floor(value) AS DOUBLE) AS votes_helpful,
       CASE WHEN event_id % 11 = 0 THEN 'Private_or_NotOwned'
            WHEN event_id % 13 = 0 THEN 'No_Stats' ELSE 'Success' END AS fetch_status,
       CAST(regexp_replace(props, '[^0-9]+', '', 'g') AS DOUBLE) AS achievements_unlocked,
       CAST(100 AS DOUBLE) AS total_achievements, 'item ' || user_id AS app_name,
       concat_ws(' ', event_type, 'rated', event_id, props) AS review
FROM events""",
    "text_reviews": """
SELECT p.review_id, d.source AS app_id, d.source AS app_name, p.rater_id, d.text AS review,
       p.recommended, p.playtime_minutes, p.received_for_free, p.votes_helpful, p.fetch_status,
       p.achievements_unlocked, p.total_achievements,
       p.achievements_unlocked / p.total_achievements * 100 AS completion_percentage
FROM documents d JOIN plays p ON p.review_id = d.doc_id""",
    "ratings": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS review_id, l.l_suppkey AS app_id, s.s_name AS app_name,
       l.l_returnflag <> 'R' AS recommended
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
    "critics": """
SELECT s_suppkey AS critic_id, upper(s_name) || '™' AS Title, 'PC' AS Platform,
       CAST(floor((s_acctbal + 1000) / 110) AS DOUBLE) AS Metascore,
       CAST(s_suppkey % 12 AS DOUBLE) AS NumberOfCriticReviews,
       'https://critics.example/' || s_suppkey AS url
FROM supplier""",
    "critics_dups": """
SELECT p_partkey, p_name AS Title, p_type AS Platform, 'u/' || (p_partkey % 100) AS url FROM part""",
    "member_vectors": """
SELECT e.vec_id, e.label AS app_id, 'item ' || e.label AS app_name,
       CASE WHEN e.vec_id % 3 <> 0 THEN 'positive' ELSE 'negative' END AS sentiment,
       d.text AS review, CAST(e.embedding AS DOUBLE[]) AS embedding
FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id""",
    "responses": """
SELECT review_id, app_id,
       CASE WHEN review_id % 11 = 0 THEN 403 WHEN review_id % 13 = 0 THEN 500 ELSE 200 END AS http_status,
       CASE WHEN review_id % 17 = 0 THEN 'not json'
            WHEN review_id % 19 = 0 THEN '{"playerstats":{}}'
            ELSE '{"playerstats":{"achievements":[' || repeat('{"achieved":1},', CAST(achievements_unlocked AS INT) % 10)
                 || '{"achieved":0}]}}' END AS body
FROM plays""",
    "classified": """
SELECT review_id, app_id, http_status, fetch_status,
       CASE WHEN fetch_status = 'Success' THEN len(regexp_extract_all(body, '"achieved":1')) ELSE 0 END
         AS achievements_unlocked,
       CASE WHEN fetch_status = 'Success' THEN len(regexp_extract_all(body, '"achieved"')) ELSE 0 END
         AS total_achievements
FROM (SELECT *, CASE WHEN http_status = 403 THEN 'Private_or_NotOwned'
                     WHEN http_status <> 200 THEN 'Error_' || http_status
                     WHEN NOT json_valid(body) THEN 'Invalid_Response'
                     WHEN contains(body, '"achieved"') THEN 'Success' ELSE 'No_Stats' END AS fetch_status
      FROM responses)""",
    "states": "SELECT c_custkey AS rater_id, c_nationkey % 4 AS state FROM customer",
    "chosen_users": """
SELECT u.rater_id FROM (SELECT DISTINCT rater_id FROM plays) u JOIN states s ON s.rater_id = u.rater_id
WHERE s.state = 3 ORDER BY md5(u.rater_id || '|42'), u.rater_id LIMIT 20""",
    "clustered": """
SELECT m.*, CAST(m.vec_id % 4 AS BIGINT) AS cluster, c.center
FROM member_vectors m JOIN (
  SELECT app_id, sentiment, cluster, list(value / length ORDER BY pos) AS center FROM (
    SELECT *, sqrt(sum(value * value) OVER (PARTITION BY app_id, sentiment, cluster)) AS length FROM (
      SELECT app_id, sentiment, vec_id % 4 AS cluster, pos, avg(embedding[pos]) AS value
      FROM member_vectors, range(1, 65) t(pos) GROUP BY ALL))
  GROUP BY ALL) c
ON c.app_id = m.app_id AND c.sentiment = m.sentiment AND c.cluster = m.vec_id % 4""",
    "clusters": """
SELECT app_id, sentiment, cluster, count(*) AS sample_count,
       arg_min(flat, (-score, vec_id)) AS representative_review, any_value(center) AS embedding
FROM (SELECT *, round(list_inner_product(embedding, center), 9) AS score, {flat} AS flat FROM clustered)
GROUP BY app_id, sentiment, cluster""",
    "items": """
SELECT app_id, app_name, count(*) AS review_count,
       avg(CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END) * 100 AS recommendation_rate
FROM member_vectors GROUP BY app_id, app_name""",
    "consensus": """
SELECT app_id, app_name, count(review_id) AS total_reviews,
       CAST(sum(CAST(recommended AS INT)) AS BIGINT) AS total_positive,
       sum(CAST(recommended AS INT)) / count(review_id) AS steam_consensus
FROM ratings GROUP BY app_id, app_name HAVING count(review_id) >= 30""",
    "good_critics": "SELECT * FROM critics WHERE Metascore IS NOT NULL AND NumberOfCriticReviews >= 5",
    "deduped_critics": """
SELECT * FROM (SELECT * FROM critics_dups QUALIFY row_number() OVER (PARTITION BY Platform, url ORDER BY p_partkey) = 1)
QUALIFY row_number() OVER (PARTITION BY Platform, Title ORDER BY p_partkey) = 1""",
    "matched": """
SELECT c.*, p.Title, p.Metascore, p.Metascore / 100.0 AS Metascore_Normalized,
       c.steam_consensus - p.Metascore / 100.0 AS delta
FROM (SELECT *, {key_name} AS merge_name FROM consensus) c
JOIN (SELECT *, {key_title} AS merge_name FROM good_critics) p ON p.merge_name = c.merge_name""",
    "completed": """
SELECT *, least(greatest(achievements_unlocked / total_achievements * 100, 0), 100) AS pct
FROM text_reviews WHERE fetch_status = 'Success' AND achievements_unlocked IS NOT NULL AND total_achievements > 0
QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY md5(CAST(review_id AS VARCHAR) || '|42'), CAST(review_id AS VARCHAR)) <= 1000""",
    "sampled": """
SELECT review_id, app_id, recommended FROM (
  SELECT *, md5(review_id || '|42') AS priority FROM (SELECT * REPLACE ({strip_review} AS review) FROM text_reviews)
  WHERE length(review) >= 20
  QUALIFY row_number() OVER (PARTITION BY app_id, recommended ORDER BY priority, review) <= 10)
QUALIFY row_number() OVER (PARTITION BY app_id, review_id ORDER BY priority, recommended DESC, review) = 1""",
    "profiles": """
SELECT i.*, CAST(coalesce(n, 0) AS BIGINT) AS sampled_negative, CAST(coalesce(p, 0) AS BIGINT) AS sampled_positive
FROM ({counts_text}) i LEFT JOIN (
  SELECT app_id, count(*) FILTER (WHERE NOT recommended) AS n, count(*) FILTER (WHERE recommended) AS p
  FROM sampled GROUP BY app_id) s ON s.app_id = i.app_id""",
}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def clean_text(x: str) -> str:
    text = f"translate(lower(coalesce({x}, '')), '’‘', {_quote(chr(39) * 2)})"
    for pattern, words in K.CONTRACTIONS:
        text = f"regexp_replace({text}, {_quote(pattern)}, {_quote(words.replace('$', chr(92)))}, 'g')"
    return f"trim(regexp_replace({text}, '[^a-z]+', ' ', 'g'))"


def title_key(x: str) -> str:
    title = f"regexp_replace(translate(lower({x}), '™®©', ''), '[:\\-/,]', ' ', 'g')"
    return collapse(f"regexp_replace({title}, '[^a-z0-9\\s]', '', 'g')")


def unescape(x: str) -> str:
    for code, sign in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "'"), ("&#x27;?", "'"), ("&amp;?", "&")):
        x = f"regexp_replace({x}, {_quote(code)}, {_quote(sign)}, 'g')"
    return x


def keyword_pattern(words) -> str:
    """Any of the words, between word bounds."""
    return r"\b(?:" + "|".join(words) + r")\b"


def names(values) -> str:
    return "[" + ", ".join(_quote(value) for value in values) + "]"


def to_roman(x: str) -> str:
    digits = [(K.ROMAN_THOUSANDS, 1000), (K.ROMAN_HUNDREDS, 100), (K.ROMAN_TENS, 10), (K.ROMAN_UNITS, 1)]
    parts = " || ".join(f"{names(n)}[(({x}) // {p}) % 10 + 1]" for n, p in digits)
    return f"CASE WHEN ({x}) BETWEEN 1 AND 4999 THEN {parts} END"


def from_roman(x: str) -> str:
    digits = [(K.ROMAN_THOUSANDS, 1000), (K.ROMAN_HUNDREDS, 100), (K.ROMAN_TENS, 10), (K.ROMAN_UNITS, 1)]
    value = " + ".join(
        f"(list_position({names(n)}, regexp_extract({x}, '{K.ROMAN_PATTERN}', {i})) - 1) * {p}"
        for i, (n, p) in enumerate(digits, start=1)
    )
    return f"CASE WHEN {x} <> '' AND regexp_matches({x}, '{K.ROMAN_PATTERN}') THEN CAST({value} AS BIGINT) END"


COUNTS = """
SELECT app_id, coalesce(arg_min(app_name, review_id), CAST(app_id AS VARCHAR)) AS app_name, count(*) AS review_count,
       CAST(sum(CAST(recommended AS INT)) AS BIGINT) AS positive_reviews,
       CAST(count(*) - sum(CAST(recommended AS INT)) AS BIGINT) AS negative_reviews,
       100.0::DOUBLE * sum(CAST(recommended AS INT)) / count(*) AS recommendation_rate
FROM {source} WHERE app_id IS NOT NULL AND recommended IS NOT NULL GROUP BY app_id"""

FILL = {
    "clusters": {"flat": strip("replace(review, chr(10), ' ')")},
    "matched": {"key_name": title_key("app_name"), "key_title": title_key("Title")},
    "sampled": {"strip_review": strip("coalesce(review, '')")},
    "profiles": {"counts_text": COUNTS.format(source="text_reviews")},
}


def with_views(wanted: str, body: str, extra: str = "") -> str:
    """Body with the named views in front, in the order given."""
    parts = []
    for name in wanted.split():
        sql = VIEWS[name]
        for slot, text in FILL.get(name, {}).items():
            sql = sql.replace("{" + slot + "}", text)
        parts.append(f"{name} AS MATERIALIZED ({sql})")
    if extra:
        parts.append(extra)
    return ("WITH RECURSIVE " if parts else "") + ", ".join(parts) + "\n" + body


def slug_rows(source: str, key: str, title: str, template: str) -> str:
    """Candidate addresses as rows (key, position, url)."""
    base = f"regexp_replace(lower({title}), {_quote(UNSTABLE)}, ' ', 'g')"
    base = f"regexp_replace(regexp_replace({base}, '[:*]', ' ', 'g'), '\\((tm|r|c)\\)', ' ', 'g')"
    before, after = template.split("%s")

    def page(x):
        slug = f"replace({collapse(f'''regexp_replace({x}, '[^a-z0-9\\s-]', '', 'g')''')}, ' ', '-')"
        return f"{_quote(before)} || {slug} || {_quote(after)}"

    return f"""
SELECT * FROM (
  SELECT {key}, 0 AS position, {page('base')} AS url FROM based
  UNION ALL
  SELECT {key}, 1, {page('variant')} FROM (
    SELECT *, CASE
        WHEN arabic <> '' THEN CASE WHEN as_roman IS NOT NULL THEN regexp_replace(base, '\\b' || arabic || '\\b', as_roman, 'g') END
        WHEN roman <> '' THEN CASE WHEN as_arabic IS NOT NULL THEN regexp_replace(base, '\\b' || roman || '\\b', as_arabic, 'g') END
      END AS variant
    FROM based)
  WHERE variant IS NOT NULL AND {page('variant')} <> {page('base')})""", f"""
found AS (SELECT *, regexp_extract(base, '\\b([0-9]+)\\b', 1) AS arabic, regexp_extract(base, '\\b([ivxlcm]+)\\b', 1) AS roman
          FROM (SELECT {key}, replace({base}, 'goty', 'game of the year') AS base FROM {source})),
based AS (SELECT *, {to_roman('TRY_CAST(arabic AS INT)')} AS as_roman, CAST({from_roman('roman')} AS VARCHAR) AS as_arabic
          FROM found)"""


TITLED = """titled AS (
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN upper(p_name) || '™: Part ' || p_size
  WHEN 1 THEN p_name || ' ' || CASE p_size % 4 WHEN 0 THEN 'VII' WHEN 1 THEN 'iv' WHEN 2 THEN 'Mix' ELSE 'IIII' END
  WHEN 2 THEN p_name || '*' || p_type || ' (R) GOTY'
  WHEN 3 THEN 'Tom''s ' || p_name || ' - Year ' || (p_partkey * 7)
  ELSE '  ' || p_name || '/' || p_type || ',  ' || p_brand || ' ' END AS title FROM part)"""

COHORT = f"""CASE WHEN playtime_minutes < 120 AND recommended THEN '{K.COHORT_EARLY}'
     WHEN playtime_minutes >= 3000 AND NOT recommended THEN '{K.COHORT_LONG}' ELSE '{K.COHORT_OTHER}' END"""
LEVELS = "levels(cohort_order, cohort) AS (VALUES " + ", ".join(
    f"({i}::BIGINT, '{c}')" for i, c in enumerate(K.COHORTS)) + ")"

BOX = """boxed AS (
SELECT cohort, q1, median, q3, least(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q1) AS whisker_low,
       greatest(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q3) AS whisker_high, count(v) AS n
FROM (SELECT cohort, v, quantile_cont(v, 0.25) OVER w AS q1, quantile_cont(v, 0.5) OVER w AS median,
             quantile_cont(v, 0.75) OVER w AS q3
      FROM (SELECT {cohort} AS cohort, CAST(length({strip}) AS DOUBLE) AS v FROM {source}) WINDOW w AS (PARTITION BY cohort))
GROUP BY cohort, q1, median, q3)"""

VOTES = f"""voted AS (SELECT {COHORT} AS cohort, votes_helpful AS v FROM plays WHERE votes_helpful >= 0 AND votes_helpful < 50000),
votes AS (SELECT cohort, avg(v) AS raw_mean, avg(v) FILTER (WHERE v <= (SELECT quantile_cont(v, 0.99) FROM voted)) AS trimmed_mean
          FROM voted GROUP BY cohort)"""
FREE = f"""free AS (SELECT {COHORT} AS cohort, avg(CAST(received_for_free AS INT)) * 100 AS free_share FROM plays GROUP BY 1)"""
SHARES = f"""shares AS (SELECT c.cohort, CASE WHEN c.cohort = '{K.COHORT_OTHER}' THEN 100 - e - l
       WHEN c.cohort = '{K.COHORT_EARLY}' THEN e ELSE l END AS share
FROM (SELECT unnest({names(K.COHORTS)}) AS cohort) c,
     (SELECT avg(CAST(coalesce(playtime_minutes < 120 AND recommended, FALSE) AS INT)) * 100 AS e,
             avg(CAST(coalesce(playtime_minutes >= 3000 AND NOT recommended, FALSE) AS INT)) * 100 AS l FROM plays))"""


def rate_by_band(source: str, pct: str) -> str:
    return f"""
SELECT band, (band * 10) || '–' || (band * 10 + 10) || '%' AS label, n, mean * 100 AS rate, se,
       mean * 100 - 1.96 * se AS low, mean * 100 + 1.96 * se AS high
FROM (SELECT b.band, coalesce(n, 0) AS n, mean, sqrt(mean * (1 - mean) / greatest(coalesce(n, 0), 1)) * 100 AS se
      FROM (SELECT unnest(range(10)) AS band) b LEFT JOIN (
        SELECT CAST(greatest(ceil({pct} / 10) - 1, 0) AS BIGINT) AS band, avg(CAST(recommended AS INT)) AS mean, count(recommended) AS n
        FROM {source} WHERE {pct} BETWEEN 0 AND 100 AND recommended IS NOT NULL GROUP BY 1) s ON s.band = b.band)"""


def theme_balance(source: str, pct: str, rating: str) -> str:
    bins = [label for _, label in K.PLAYTIME_BINS]
    return f"""
SELECT g.playtime_group, g.completion_group, g.playtime_order, g.completion_order, balance, coalesce(n, 0) AS n
FROM (SELECT p.o AS playtime_order, p.v AS playtime_group, c.o AS completion_order, c.v AS completion_group
      FROM (SELECT unnest(range(4)) AS o, unnest({names(bins)}) AS v) p,
           (SELECT unnest(range(3)) AS o, unnest({names(K.COMPLETION_GROUPS)}) AS v) c) g
LEFT JOIN (
  SELECT pg, cg, avg(CAST(regexp_matches(text, {_quote(keyword_pattern(THEME_TWO))}) AS INT)) * 100
                 - avg(CAST(regexp_matches(text, {_quote(keyword_pattern(THEME_ONE))}) AS INT)) * 100 AS balance, count(*) AS n
  FROM (SELECT {clean_text('review')} AS text,
               CASE WHEN playtime_minutes IS NULL OR playtime_minutes < 0 OR isinf(playtime_minutes) THEN NULL
                    WHEN playtime_minutes / 60 < 5 THEN {_quote(bins[0])} WHEN playtime_minutes / 60 < 20 THEN {_quote(bins[1])}
                    WHEN playtime_minutes / 60 < 100 THEN {_quote(bins[2])} ELSE {_quote(bins[3])} END AS pg,
               CASE WHEN {pct} <= 25 THEN 'Low' WHEN {pct} >= 75 THEN 'High' ELSE 'Middle' END AS cg
        FROM {source} WHERE {pct} BETWEEN 0 AND 100 AND {rating})
  WHERE text <> '' AND pg IS NOT NULL GROUP BY pg, cg) s
ON s.pg = g.playtime_group AND s.cg = g.completion_group"""


def sides(name: str, source: str, pct: str, rating: str, seed: int, key: str = "review_id") -> str:
    """Balanced low and high texts as a view (key, side, text)."""
    def side(label, condition, number):
        return f"""SELECT {key} AS id, text, '{label}' AS side,
           row_number() OVER (ORDER BY md5({key} || '|{number}'), {key}) AS rank, count(*) OVER () AS n
    FROM {name}_texts WHERE {condition}"""

    return f"""{name}_texts AS MATERIALIZED (SELECT CAST({key} AS VARCHAR) AS {key}, {pct} AS pct, {clean_text('review')} AS text FROM {source}
  WHERE {pct} BETWEEN 0 AND 100 AND {rating}),
{name}_both AS (SELECT * FROM ({side('low', "text <> '' AND pct <= 25", 42 + seed)}) UNION ALL
  SELECT * FROM ({side('high', "text <> '' AND pct >= 75", 43 + seed)})),
{name} AS MATERIALIZED (SELECT id, side, text FROM {name}_both
  WHERE rank <= least(12000, (SELECT min(n) FROM (SELECT side, min(n) AS n FROM {name}_both GROUP BY side))))"""


def tfidf(name: str, source: str, key: str, tokens: str, by: str = "", carry: str = "", least_docs: str | None = None,
          share: float = K.TFIDF_MAX_SHARE, features: int = K.TFIDF_MAX_FEATURES, sublinear: bool = True,
          stop_words: tuple[str, ...] = (*K.ENGLISH_STOP_WORDS, *K.CUSTOM_STOP_WORDS)) -> str:
    """TF-IDF weights as views; the last one is ``name``."""
    stop = ", ".join(_quote(word) for word in stop_words)
    b = f"{by}, " if by else ""
    c = f"{carry}, " if carry else ""
    part = f"PARTITION BY {by}" if by else ""
    using = f"USING ({by}, term)" if by else "USING (term)"
    docs = f"JOIN (SELECT {by}, count(*) AS docs FROM {source} GROUP BY {by}) USING ({by})" if by else \
        f", (SELECT count(*) AS docs FROM {source})"
    few = least_docs or "least(10, greatest(2, docs // 100))"
    tf = "1 + ln(tf)" if sublinear else "tf"
    return f"""
{name}_words AS MATERIALIZED (SELECT {b}{c}{key}, list_filter({tokens}, lambda w: length(w) >= 2 AND w NOT IN ({stop})) AS words FROM {source}),
{name}_tf AS MATERIALIZED (SELECT {b}{c}{key}, term, count(*) AS tf FROM (
    SELECT {b}{c}{key}, unnest(words) AS term FROM {name}_words
    UNION ALL
    SELECT {b}{c}{key}, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM {name}_words)
  GROUP BY {b}{c}{key}, term),
{name}_vocabulary AS MATERIALIZED (
  SELECT {b}term, ln((1 + docs) / (1 + df)) + 1 AS idf FROM (
    SELECT {b}term, count(*) AS df, sum(tf) AS corpus FROM {name}_tf GROUP BY {b}term) {docs}
  WHERE df >= {few} AND df <= docs * {share}
  QUALIFY row_number() OVER ({part} ORDER BY corpus DESC, term) <= {features}),
{name} AS MATERIALIZED (SELECT {b}{c}{key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight
  FROM (SELECT {b}{c}{key}, term, ({tf}) * idf AS w FROM {name}_tf JOIN {name}_vocabulary {using}))"""


def top_terms(weights: str, docs: str) -> str:
    return f"""
SELECT side, term, score, row_number() OVER (PARTITION BY side ORDER BY score DESC, term) AS rank
FROM (SELECT CASE WHEN difference > 0 THEN 'high' ELSE 'low' END AS side, term, round(abs(difference) * 1000, 6) AS score
      FROM (SELECT term, sum(CASE WHEN side = 'high' THEN weight ELSE 0 END) / (SELECT count(*) FROM {docs} WHERE side = 'high')
                       - sum(CASE WHEN side = 'low' THEN weight ELSE 0 END) / (SELECT count(*) FROM {docs} WHERE side = 'low') AS difference
            FROM {weights} GROUP BY term) WHERE difference <> 0)
QUALIFY rank <= 16"""


# rounds written out in the SQL; once nothing moves further rounds change nothing, so more than needed is still exact
TWIN_ROUNDS = 24


def kmeans(restarts: int, iterations: int, k: int = 4, size: int = 64) -> str:
    gap = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    # starts: a race for each, with times -ln(u) / squared distance to the starts before it
    views = [f"""factors AS MATERIALIZED (
  SELECT r, j, CAST('0x' || substr(h, 1, 8) AS BIGINT) % 2147483646 + 1 AS factor, CAST('0x' || substr(h, 9, 8) AS BIGINT) % 2147483647 AS shift
  FROM (SELECT r, j, md5('42|' || r || '|' || j) AS h FROM range({restarts}) t(r), range({k}) u(j))),
near0 AS MATERIALIZED (SELECT app_id, sentiment, vec_id, r, embedding AS x, CAST(NULL AS DOUBLE) AS d,
    CAST('0x' || substr(md5(vec_id || '|42'), 1, 8) AS BIGINT) % 2147483647 AS h FROM member_vectors, range({restarts}) t(r))"""]
    for j in range(k):
        views.append(f"""start{j} AS MATERIALIZED (
  SELECT app_id, sentiment, r, {j} AS cluster, arg_min(x, (CASE WHEN d IS NULL THEN lead WHEN d > 0 THEN lead / d ELSE CAST('Infinity' AS DOUBLE) END, h, vec_id)) AS c
  FROM (SELECT n.*, -ln(CAST((h * factor + shift) % 2147483647 + 1 AS DOUBLE) / 2147483648) AS lead
        FROM near{j} n JOIN factors f ON f.r = n.r AND f.j = {j}) GROUP BY app_id, sentiment, r),
near{j + 1} AS MATERIALIZED (SELECT n.* REPLACE (least(coalesce(d, CAST('Infinity' AS DOUBLE)), {gap}) AS d)
  FROM near{j} n JOIN start{j} s USING (app_id, sentiment, r))""")
    views.append("c0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM start{j}" for j in range(k)) + ")")

    def assign(centers):
        return f"""SELECT app_id, sentiment, r, vec_id, arg_min(cluster, (gap, cluster)) AS cluster, min(gap) AS gap, any_value(x) AS x
  FROM (SELECT m.app_id, m.sentiment, r, vec_id, cluster, embedding AS x, c, {gap.replace('len(x)', 'len(embedding)').replace('x[i]', 'embedding[i]')} AS gap
        FROM member_vectors m JOIN {centers} USING (app_id, sentiment)) GROUP BY app_id, sentiment, r, vec_id"""

    for i in range(1, iterations + 1):
        views.append(f"""a{i} AS MATERIALIZED ({assign(f'c{i - 1}')}),
c{i} AS MATERIALIZED (SELECT app_id, sentiment, r, cluster, list(v ORDER BY pos) AS c FROM (
  SELECT app_id, sentiment, r, cluster, pos, avg(x[pos]) AS v FROM a{i}, range(1, {size + 1}) t(pos) GROUP BY ALL) GROUP BY ALL)""")
    # the rounds written out here must have been enough
    views.append(f"""moving AS (SELECT count(*) AS n FROM a{iterations - 1} a JOIN a{iterations} b USING (app_id, sentiment, r, vec_id) WHERE a.cluster <> b.cluster),
last AS MATERIALIZED (SELECT * FROM ({assign(f'c{iterations}')}), moving WHERE CASE WHEN n > 0 THEN error('rows that still move: ' || n) ELSE TRUE END),
won AS (SELECT app_id, sentiment, arg_min(r, (inertia, r)) AS r FROM (
  SELECT app_id, sentiment, r, round(sum(gap), 6) AS inertia FROM last GROUP BY ALL) GROUP BY ALL)""")
    return ",\n".join(views)


# squarings of a matrix, after which only its largest axis is left of it
SQUARINGS = 24


def principal_axes(source: str, key: str, size: int) -> str:
    """Places ``placed`` of the source's (key, sentiment, embedding) rows on the first two principal axes of each sentiment."""
    scaled = "list_transform(q, lambda r: list_transform(r, lambda v: v / t))"
    views = [f"""middle AS MATERIALIZED (SELECT sentiment, list(v ORDER BY pos) AS mid FROM (
  SELECT sentiment, pos, avg(embedding[pos]) AS v FROM {source}, range(1, {size + 1}) t(pos) GROUP BY ALL) GROUP BY sentiment),
centred AS MATERIALIZED (SELECT {key}, sentiment, list_transform(range(1, {size + 1}), lambda i: embedding[i] - mid[i]) AS x
  FROM {source} JOIN middle USING (sentiment)),
sides AS MATERIALIZED (SELECT sentiment, i, list(x[i] ORDER BY {key}) AS line FROM centred, range(1, {size + 1}) t(i) GROUP BY sentiment, i),
matrix0 AS MATERIALIZED (SELECT sentiment, list(row ORDER BY i) AS m FROM (
  SELECT a.sentiment, a.i, list(list_inner_product(a.line, b.line) ORDER BY b.i) AS row FROM sides a JOIN sides b USING (sentiment) GROUP BY ALL) GROUP BY sentiment)"""]
    for axis in (1, 2):
        before = f"matrix{axis - 1}"
        trace = f"list_sum(list_transform(range(1, {size + 1}), lambda i: q[i][i]))"
        for i in range(SQUARINGS + 1):
            q = "m" if i == 0 else "list_transform(m, lambda r: list_transform(m, lambda c: list_inner_product(r, c)))"
            views.append(f"""p{axis}_{i} AS MATERIALIZED (SELECT sentiment, CASE WHEN t > 0 THEN {scaled} ELSE q END AS m
  FROM (SELECT *, {trace} AS t FROM (SELECT sentiment, {q} AS q FROM {before if i == 0 else f'p{axis}_{i - 1}'})))""")
        views.append(f"""axis{axis} AS MATERIALIZED (SELECT sentiment, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n * s) ELSE v END AS axis
  FROM (SELECT *, sqrt(list_inner_product(v, v)) AS n, sign(list_extract(v, list_position(list_transform(v, lambda x: abs(x)), list_max(list_transform(v, lambda x: abs(x)))))) AS s
        FROM (SELECT sentiment, m[list_position(list_transform(range(1, {size + 1}), lambda i: m[i][i]), list_max(list_transform(range(1, {size + 1}), lambda i: m[i][i])))] AS v
              FROM p{axis}_{SQUARINGS}))),
matrix{axis} AS MATERIALIZED (SELECT sentiment, list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 1}), lambda j: m[i][j] - w * axis[i] * axis[j])) AS m
  FROM (SELECT b.sentiment, b.m, a.axis, list_inner_product(a.axis, list_transform(b.m, lambda r: list_inner_product(r, a.axis))) AS w
        FROM {before} b JOIN axis{axis} a USING (sentiment)))""")
    views.append(f"""mapped AS MATERIALIZED (SELECT {key}, sentiment, list_inner_product(x, a.axis) AS pc1, list_inner_product(x, b.axis) AS pc2
  FROM centred JOIN axis1 a USING (sentiment) JOIN axis2 b USING (sentiment))""")
    return ",\n".join(views)


def latent_views(latent: int, size: int, rounds: int) -> str:
    """Axes ``axes`` (c1, c2, …) of the unit vectors ``unit`` (doc_id, pos, w), by as many rounds of block power iteration."""
    columns = range(1, latent + 1)
    start = lambda c: f"(p * 7919 + {c - 1} * 104729 + p * p * 31 * {c}) % 1009 / 1009.0::DOUBLE - 0.5"
    views = ["y0 AS MATERIALIZED (SELECT " + ", ".join(f"list({start(c)} ORDER BY p) AS y{c}" for c in columns) + f" FROM range({size}) t(p))"]
    for i in range(rounds + 1):
        before = f"y{i}"
        for c in columns:
            # one column after the other is freed of those before it
            for e in range(1, c):
                views.append(f"g{i}_{c}_{e} AS MATERIALIZED (SELECT * REPLACE (list_transform(list_zip(y{c}, y{e}), lambda p: p[1] - d * p[2]) AS y{c}) "
                             f"FROM (SELECT *, list_inner_product(y{c}, y{e}) AS d FROM {before}))".replace("SELECT * REPLACE", "SELECT * EXCLUDE (d) REPLACE"))
                before = f"g{i}_{c}_{e}"
            views.append(f"g{i}_{c} AS MATERIALIZED (SELECT * EXCLUDE (d) REPLACE (list_transform(y{c}, lambda x: x / d) AS y{c}) "
                         f"FROM (SELECT *, sqrt(list_inner_product(y{c}, y{c})) AS d FROM {before}))")
            before = f"g{i}_{c}"
        views.append(f"axes{i} AS MATERIALIZED (SELECT * FROM {before})")
        if i < rounds:
            along = ", ".join(f"sum(w * y{c}[pos + 1]) AS s{c}" for c in columns)
            back = ", ".join(f"sum(w * s{c}) AS v{c}" for c in columns)
            views.append(f"s{i} AS MATERIALIZED (SELECT doc_id, {along} FROM unit, axes{i} GROUP BY doc_id)")
            views.append(f"y{i + 1} AS MATERIALIZED (SELECT " + ", ".join(f"list(coalesce(v{c}, 0) ORDER BY p) AS y{c}" for c in columns)
                         + f" FROM range({size}) t(p) LEFT JOIN (SELECT pos, {back} FROM unit JOIN s{i} USING (doc_id) GROUP BY pos) z ON z.pos = p)")
    views.append(f"axes AS MATERIALIZED (SELECT * FROM axes{rounds})")
    return ",\n".join(views)


def vector_of(vec_id: int) -> str:
    return f"(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = {vec_id})"


def excerpt(x: str) -> str:
    text = collapse(x)
    return f"CASE WHEN length({text}) <= 420 THEN {text} ELSE regexp_replace(substring({text}, 1, 420), ' [^ ]*$', '') || '…' END"


SCORED = f"""scored AS MATERIALIZED (
SELECT i.app_id, i.app_name, i.recommendation_rate, i.review_count, s.* EXCLUDE (app_id) FROM items i JOIN (
  SELECT app_id, max(ws) FILTER (WHERE sentiment = 'positive') AS wanted_similarity,
         coalesce(max(avs) FILTER (WHERE sentiment = 'negative'), 0) AS avoid_similarity,
         arg_max(representative_review, (readable, ws, -cluster)) FILTER (WHERE sentiment = 'positive') AS positive_review,
         coalesce(arg_max(representative_review, (readable, sample_count, -cluster)) FILTER (WHERE sentiment = 'negative'), '') AS negative_review
  FROM (SELECT *, round(list_inner_product(CAST(CAST(embedding AS FLOAT[]) AS DOUBLE[]), {vector_of(0)}), 9) AS ws,
               round(list_inner_product(CAST(CAST(embedding AS FLOAT[]) AS DOUBLE[]), {vector_of(1)}), 9) AS avs,
               CASE WHEN length(coalesce(representative_review, '')) >= 90 THEN 1 ELSE 0 END AS readable FROM clusters)
  GROUP BY app_id) s ON s.app_id = i.app_id WHERE i.recommendation_rate >= 60 AND wanted_similarity IS NOT NULL),
pool AS (SELECT *, CASE WHEN wmax - wmin > 1e-9 THEN (wanted_similarity - wmin) / (wmax - wmin) ELSE 0 END
            - 0.75 * CASE WHEN amax - amin > 1e-9 THEN (avoid_similarity - amin) / (amax - amin) ELSE 0 END AS rank_score
  FROM (SELECT *, max(wanted_similarity) OVER () AS wmax, min(wanted_similarity) OVER () AS wmin,
               max(avoid_similarity) OVER () AS amax, min(avoid_similarity) OVER () AS amin
        FROM (SELECT * FROM scored ORDER BY wanted_similarity DESC, app_id LIMIT 20))),
placed AS (SELECT *, row_number() OVER (ORDER BY round(rank_score, 9) DESC, recommendation_rate DESC, app_id) AS rank,
                  row_number() OVER (ORDER BY wanted_similarity DESC, app_id) AS plain FROM pool)"""
SEARCH = "member_vectors clustered clusters items"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    words = names(("True", " TRUE ", "1", "1.0", "yes", "0.0", "no", "recommended",
                   "Not Recommended", "t", "", "0", "false", "positive", "2", " NO "))

    def vocabulary(x, vocab):
        yes, no = K.BOOLEAN_WORDS[vocab]
        return f"CASE WHEN {x} IN ({names(yes)[1:-1]}) THEN TRUE WHEN {x} IN ({names(no)[1:-1]}) THEN FALSE END"

    out["parse_boolean"] = f"""
SELECT review_id, word, {vocabulary('w', 'extended')} AS extended, {vocabulary('w', 'basic')} AS basic,
       CASE WHEN w IN ({names(K.BOOLEAN_WORDS['rating'][0])[1:-1]}) THEN 1.0::DOUBLE
            WHEN w IN ({names(K.BOOLEAN_WORDS['rating'][1])[1:-1]}) THEN 0.0::DOUBLE END AS rating
FROM (SELECT *, lower(trim(word)) AS w FROM (SELECT event_id AS review_id, {words}[event_id % 17 + 1] AS word FROM events))"""
    out["coerce_numeric"] = r"""
SELECT event_id, raw, TRY_CAST(trim(raw) AS DOUBLE) AS value FROM (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN ' ' || number || '.50 ' WHEN 2 THEN number || 'e2'
                        WHEN 3 THEN number || '..' ELSE '-' || number END AS raw
  FROM (SELECT *, regexp_extract(props, ': ([0-9]+)', 1) AS number FROM events))"""
    out["clean_id"] = r"""
SELECT review_id, raw, CASE WHEN lower(v) NOT IN ('', 'nan', 'none', '<na>') THEN v END AS id FROM (
  SELECT review_id, raw, regexp_replace(trim(raw), '\.0$', '') AS v FROM (
    SELECT event_id AS review_id, CASE event_id % 6 WHEN 0 THEN ' ' || event_id || '.0 ' WHEN 1 THEN event_id || ''
           WHEN 2 THEN 'NaN' WHEN 3 THEN ' <NA> ' WHEN 4 THEN event_id || '.05' END AS raw FROM events))"""
    out["cohort_flags"] = with_views("plays text_reviews", f"""
SELECT review_id, round(playtime_minutes / 60, 6) AS playtime_review_hours, length({strip('review')}) AS review_length,
       received_for_free, votes_helpful,
       CAST(coalesce(playtime_minutes < 120 AND recommended, FALSE) AS BIGINT) AS is_early_positive,
       CAST(coalesce(playtime_minutes >= 3000 AND NOT recommended, FALSE) AS BIGINT) AS is_long_play_negative, {COHORT} AS cohort
FROM text_reviews""")
    out["clean_text"] = f"SELECT * FROM (SELECT doc_id, {clean_text('text')} AS text FROM documents) WHERE text <> ''"
    out["theme_flags"] = f"""
SELECT doc_id, regexp_matches(t, {_quote(keyword_pattern(THEME_ONE))}) AS first_theme,
       regexp_matches(t, {_quote(keyword_pattern(THEME_TWO))}) AS second_theme
FROM (SELECT doc_id, {clean_text('text')} AS t FROM documents) WHERE t <> ''"""
    out["title_key"] = with_views("", f"SELECT p_partkey, title, {title_key('title')} AS title_key FROM titled", TITLED)
    body, views = slug_rows("titled", "p_partkey", "title", K.CRITIC_URL)
    out["slug_candidates"] = with_views("", f"SELECT p_partkey, CAST(position AS BIGINT) AS position, url FROM ({body})",
                                        TITLED + "," + views)
    out["roman_numerals"] = f"""
SELECT p_partkey, number, roman, numeral, {from_roman('numeral')} AS back FROM (
  SELECT *, CASE WHEN p_partkey % 3 = 0 THEN roman || 'i' ELSE roman END AS numeral FROM (
    SELECT p_partkey, number, {to_roman('number')} AS roman FROM (SELECT p_partkey, p_partkey + p_size AS number FROM part)))"""
    out["item_filter"] = with_views("ratings", """
SELECT DISTINCT app_id, app_name FROM ratings WHERE app_id = 42 OR contains(lower(app_name), 'er#00000000')""")
    out["excerpt"] = f"SELECT doc_id, {excerpt('text')} AS excerpt FROM documents"
    out["unit_vectors"] = """
SELECT vec_id, CAST(pos - 1 AS BIGINT) AS pos, round(v[pos] / sqrt(list_inner_product(v, v)), 6) AS value
FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (label + 1)) AS v FROM embeddings), range(1, 65) t(pos)"""
    out["dot_scores"] = f"""
SELECT vec_id, round(list_inner_product(CAST(embedding AS DOUBLE[]), {vector_of(0)}), 6) AS score FROM embeddings"""
    out["page_fields"] = rf"""
SELECT page_id, CASE WHEN regexp_matches(h, '(?s)<title>(.*?)</title>')
                     THEN {strip(unescape(r"regexp_replace(regexp_extract(h, '(?s)<title>(.*?)</title>', 1), '\s*<[^>]*>\s*', '', 'g')"))} END AS Title,
       TRY_CAST(nullif(regexp_extract(h, 'track\((\d+)\)', 1), '') AS BIGINT) AS Metascore,
       TRY_CAST(nullif(regexp_extract(h, 'ad (\d+)', 1), '') AS BIGINT) AS NumberOfCriticReviews,
       TRY_CAST(nullif(regexp_extract(h, 'page=(\d+)', 1), '') AS BIGINT) AS page_number
FROM (SELECT page_id, html || chr(10) || url AS h FROM pages)"""
    out["classify_responses"] = with_views("plays responses classified", """
SELECT review_id, app_id, CAST(http_status AS BIGINT) AS http_status, fetch_status,
       CAST(achievements_unlocked AS BIGINT) AS achievements_unlocked, CAST(total_achievements AS BIGINT) AS total_achievements
FROM classified""")
    out["completion"] = with_views("plays text_reviews completed", """
SELECT CAST(review_id AS VARCHAR) AS review_id, app_id, round(pct, 6) AS completion_percentage FROM completed""")
    out["enrich_reviews"] = with_views("plays responses classified", """
SELECT CAST(p.review_id AS VARCHAR) AS review_id, CAST(p.app_id AS VARCHAR) AS app_id, p.recommended,
       CASE WHEN c.fetch_status = 'Error_500' THEN 'No_Stats' ELSE c.fetch_status END AS fetch_status,
       CAST(c.achievements_unlocked AS BIGINT) AS achievements_unlocked, CAST(c.total_achievements AS BIGINT) AS total_achievements
FROM plays p JOIN classified c ON c.review_id = p.review_id""")
    out["public_users"] = with_views("plays states chosen_users", "SELECT rater_id FROM chosen_users")
    out["public_user_reviews"] = with_views("plays states chosen_users", """
SELECT review_id, rater_id, app_id FROM plays WHERE rater_id IN (SELECT rater_id FROM chosen_users)""")
    out["pending_targets"] = with_views("plays", """
SELECT review_id, app_id FROM plays WHERE review_id NOT IN (SELECT review_id FROM plays WHERE fetch_status = 'Success')""")
    body, views = slug_rows("(SELECT DISTINCT app_name FROM consensus)", "app_name", "app_name", "u/%s")
    out["pending_urls"] = with_views("ratings consensus", """
SELECT app_name, CAST(position AS BIGINT) AS position, url FROM addresses
WHERE app_name NOT IN (SELECT app_name FROM addresses WHERE url LIKE '%3') AND NOT regexp_matches(url, '[57]$')""",
                                     views.strip() + f", addresses AS ({body})")
    out["cap_per_group"] = with_views("plays", """
SELECT review_id, app_id FROM plays
QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY md5(review_id || '|42'), review_id) <= 20""")
    out["hash_sample"] = with_views("plays text_reviews sampled", "SELECT * FROM sampled")
    out["dedupe_first"] = """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1"""
    out["dedupe_last"] = """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id"""
    out["dedupe_critics"] = with_views("critics_dups deduped_critics", "SELECT * FROM deduped_critics")
    out["balanced_sample"] = with_views("plays text_reviews", "SELECT CAST(id AS BIGINT) AS review_id, side FROM picked",
                                        sides("picked", "text_reviews", "completion_percentage", "recommended", 10))
    out["sample_n"] = with_views("plays", "SELECT review_id FROM plays ORDER BY md5(review_id || '|42'), review_id LIMIT 500")
    out["cohort_shares"] = with_views("plays", "SELECT cohort, round(share, 6) AS share FROM shares", SHARES)
    out["cohort_free_share"] = with_views("plays", """
SELECT cohort_order, cohort, round(free_share, 6) AS free_share FROM levels LEFT JOIN free USING (cohort)""", f"{LEVELS}, {FREE}")
    out["helpful_votes"] = with_views("plays", """
SELECT cohort_order, cohort, round(raw_mean, 6) AS raw_mean, round(trimmed_mean, 6) AS trimmed_mean
FROM levels LEFT JOIN votes USING (cohort)""", f"{LEVELS}, {VOTES}")
    box = BOX.format(cohort=COHORT, strip=strip("coalesce(review, '')"), source="text_reviews")
    out["box_stats"] = with_views("plays text_reviews", """
SELECT cohort_order, cohort, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, n
FROM levels LEFT JOIN boxed USING (cohort)""", f"{LEVELS}, {box}")
    out["item_quartiles"] = with_views("plays", " UNION ALL ".join(
        f"SELECT app_id, {p}::DOUBLE AS prob, round(quantile_cont(playtime_minutes, {p}), 6) AS quantile FROM plays GROUP BY app_id"
        for p in (0.25, 0.5, 0.99)))
    out["playtime_density"] = with_views("plays", """
SELECT CAST(step AS BIGINT) AS step, round(pow(10, low + (high - low) * step / 199.0), 6) AS at,
       round(sum(exp(-0.5 * pow((low + (high - low) * step / 199.0 - x) / width, 2))) / (any_value(n) * any_value(width) * sqrt(2 * pi())), 6) AS density
FROM points, (SELECT *, lo - 3 * width AS low, hi + 3 * width AS high FROM (
       SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(count(*), -0.2) AS width FROM points)), range(200) t(step)
GROUP BY step, low, high""", """points AS MATERIALIZED (SELECT round(log10(playtime_minutes / 60) / 0.001) * 0.001 AS x FROM plays WHERE playtime_minutes / 60 > 0.01)""")
    out["cohort_study_curve"] = out["playtime_density"]
    out["consensus"] = with_views("ratings consensus", "SELECT * REPLACE (round(steam_consensus, 6) AS steam_consensus) FROM consensus")
    out["sorted_baseline"] = with_views("ratings consensus", """
SELECT * REPLACE (round(steam_consensus, 6) AS steam_consensus), row_number() OVER (ORDER BY app_name, app_id) AS position FROM consensus""")
    out["critic_page_fields"] = """
SELECT page_id, 'Page & ' || page_id || '.' AS Title, CASE WHEN page_id % 4 > 1 THEN page_id % 101 END AS Metascore,
       CASE WHEN page_id % 3 > 0 THEN page_id % 57 END AS NumberOfCriticReviews FROM pages"""
    out["status_counts"] = with_views("plays", "SELECT fetch_status, count(*) AS n FROM plays GROUP BY fetch_status")
    out["stage_report"] = with_views("plays", """
SELECT step, stage, rows, dropped, round(rows / (SELECT count(*) FROM plays) * 100, 6) AS pct_kept FROM (
  SELECT *, lag(rows, 1, rows) OVER (ORDER BY step) - rows AS dropped FROM (
    SELECT 0::BIGINT AS step, 'all rows' AS stage, count(*) AS rows FROM plays
    UNION ALL SELECT 1, 'has ids', count(*) FROM plays WHERE review_id IS NOT NULL AND app_id IS NOT NULL
    UNION ALL SELECT 2, 'fetched', count(*) FROM ok
    UNION ALL SELECT 3, 'has numbers', count(*) FROM ok WHERE achievements_unlocked IS NOT NULL AND total_achievements IS NOT NULL
    UNION ALL SELECT 4, 'has achievements', count(*) FROM ok WHERE achievements_unlocked IS NOT NULL AND total_achievements > 0))
UNION ALL SELECT 9, 'duplicate raters', count(rater_id), count(rater_id) - count(DISTINCT rater_id), NULL FROM plays""",
                                     """ok AS (SELECT * FROM plays WHERE review_id IS NOT NULL AND app_id IS NOT NULL AND fetch_status = 'Success')""")
    out["modal_name"] = with_views("plays", """
SELECT app_name, count(*) AS n FROM plays GROUP BY app_name ORDER BY n DESC, app_name LIMIT 1""")
    out["rate_by_band"] = with_views("plays text_reviews", f"""
SELECT * REPLACE (round(rate, 6) AS rate, round(se, 6) AS se, round(low, 6) AS low, round(high, 6) AS high)
FROM ({rate_by_band('text_reviews', 'completion_percentage')})""")
    for name, rating in (("pos", "recommended"), ("neg", "NOT recommended")):
        out[f"theme_balance_{name}"] = with_views("plays text_reviews", f"""
SELECT * REPLACE (round(balance, 6) AS balance) FROM ({theme_balance('text_reviews', 'completion_percentage', rating)})""")
    out["json_records"] = with_views("critics", """
SELECT position, '{"id":"' || position || '","url":"' || url || '","Title":"' || Title || '","Platform":"' || Platform
       || '","Metascore":' || Metascore || ',"NumberOfCriticReviews":' || NumberOfCriticReviews || '}' AS record
FROM (SELECT *, row_number() OVER (ORDER BY critic_id) AS position FROM critics)
WHERE Metascore IS NOT NULL AND NumberOfCriticReviews >= 5""")
    matched = "ratings consensus critics good_critics matched"
    out["consensus_delta"] = with_views(matched, """
SELECT app_id, app_name, Title, round(steam_consensus, 6) AS steam_consensus,
       round(Metascore_Normalized, 6) AS Metascore_Normalized, round(delta, 6) AS delta FROM matched""")
    out["critic_study"] = with_views(matched, """
SELECT app_id, app_name, total_reviews, total_positive, round(steam_consensus, 6) AS steam_consensus, Title, Metascore,
       round(delta, 6) AS delta FROM matched""")
    out["outlier_share"] = with_views(matched, """
SELECT count(*) AS total, count(*) FILTER (WHERE abs(delta) > 0.25) AS outliers,
       round(count(*) FILTER (WHERE abs(delta) > 0.25) / count(*) * 100, 6) AS outlier_pct FROM matched""")
    out["delta_tails"] = with_views(matched, """
SELECT app_id, app_name, round(delta, 6) AS delta FROM (
  (SELECT * FROM matched ORDER BY delta DESC, app_id LIMIT 5) UNION ALL (SELECT * FROM matched ORDER BY delta, app_id LIMIT 5))""")
    out["title_preview"] = with_views("critics_dups deduped_critics", """
(SELECT 'before' AS stage, p_partkey, Title, Platform FROM deduped_critics ORDER BY p_partkey LIMIT 10)
UNION ALL (SELECT 'after', p_partkey, Title, Platform FROM deduped_critics ORDER BY Title NULLS LAST, p_partkey LIMIT 10)""")
    docs = f"docs AS MATERIALIZED (SELECT * FROM (SELECT doc_id, {clean_text('text')} AS text FROM documents) WHERE text <> '')"
    out["tfidf"] = with_views("", "SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
                              docs + "," + tfidf("weights", "docs", "doc_id", "string_split(text, ' ')"))
    for name, rating, seed in (("pos", "recommended", 10), ("neg", "NOT recommended", 20)):
        out[f"tfidf_diff_{name}"] = with_views(
            "plays text_reviews", f"SELECT * FROM ({top_terms('weights', 'picked')})",
            sides("picked", "text_reviews", "completion_percentage", rating, seed) + ","
            + tfidf("weights", "picked", "id", "string_split(text, ' ')", carry="side"))
    out["encode_text"] = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents),
counts AS (SELECT doc_id, CAST('0x' || substr(md5(word), 1, 7) AS INT) % 384 AS pos, count(*) AS n FROM words GROUP BY ALL),
weights AS (SELECT doc_id, pos, n * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS w
            FROM counts JOIN (SELECT pos, count(*) AS df FROM counts GROUP BY pos) USING (pos)),
scaled AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, round(CAST(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE), 4) AS value FROM weights)
SELECT * FROM scaled WHERE value <> 0"""
    coded = out["encode_text"].split("scaled AS")[0]
    places = ", ".join(f"coalesce(s{c}, 0)" for c in range(1, 5))
    out["encode_latent"] = coded + r"""unit AS MATERIALIZED (SELECT doc_id, pos, CAST(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE) AS w FROM weights),
""" + latent_views(4, 384, 8) + f"""
SELECT doc_id, CAST(i AS BIGINT) AS pos, round(CAST(CAST(CASE WHEN n > 1e-12 THEN seen[i + 1] / n ELSE 0 END AS FLOAT) AS DOUBLE), 4) + 0.0 AS value
FROM (SELECT doc_id, seen, sqrt(list_inner_product(seen, seen)) AS n FROM (
  SELECT d.doc_id, [{places}] AS seen FROM documents d LEFT JOIN (
    SELECT doc_id, {', '.join(f'sum(w * y{c}[pos + 1]) AS s{c}' for c in range(1, 5))} FROM unit, axes GROUP BY doc_id) p ON p.doc_id = d.doc_id)), range(4) t(i)"""
    out["centroids"] = with_views("member_vectors", """
SELECT app_id, sentiment, CAST(pos - 1 AS BIGINT) AS pos, round(avg(embedding[pos]), 6) AS value
FROM member_vectors, range(1, 65) t(pos) GROUP BY app_id, sentiment, pos""")
    out["grouped_kmeans"] = with_views("member_vectors", """
SELECT app_id, sentiment, vec_id, CAST(cluster AS BIGINT) AS cluster FROM last JOIN won USING (app_id, sentiment, r)""", kmeans(K.KMEANS_RESTARTS, TWIN_ROUNDS))
    out["pca_2d"] = with_views("member_vectors", """
SELECT vec_id, sentiment, round(pc1, 4) AS pc1, round(pc2, 4) AS pc2 FROM mapped""", principal_axes("member_vectors", "vec_id", 64))
    out["representatives"] = with_views("member_vectors clustered clusters", """
SELECT app_id, sentiment, cluster, sample_count, representative_review FROM clusters""")
    out["cluster_shares"] = with_views("member_vectors clustered", """
SELECT g.app_id, g.sentiment, CAST(k AS BIGINT) AS cluster, count(c.vec_id) AS n, round(count(c.vec_id) / any_value(g.n) * 100, 6) AS share
FROM (SELECT app_id, sentiment, count(*) AS n FROM clustered GROUP BY ALL) g CROSS JOIN range(4) t(k)
LEFT JOIN clustered c ON c.app_id = g.app_id AND c.sentiment = g.sentiment AND c.cluster = k GROUP BY g.app_id, g.sentiment, k""")
    label_views = tfidf("weights", "clustered", "vec_id", r"regexp_extract_all(lower(review), '[\p{L}\p{N}_]{2,}')",
                        by="app_id, sentiment", carry="cluster", least_docs="2", share=K.LABEL_MAX_SHARE,
                        features=K.LABEL_MAX_FEATURES, sublinear=False, stop_words=tuple(K.ENGLISH_STOP_WORDS)).strip() + """,
terms AS MATERIALIZED (SELECT app_id, sentiment, k AS cluster, term, round(inside / ns - coalesce((total - inside) / nullif(docs - ns, 0), 0), 9) AS score
  FROM (SELECT v.app_id, v.sentiment, v.term, s.k, any_value(s.n) AS ns, any_value(s.docs) AS docs, sum(w.weight) AS total,
               coalesce(sum(w.weight) FILTER (WHERE w.cluster = s.k), 0) AS inside
        FROM weights_vocabulary v
        JOIN (SELECT *, sum(n) OVER (PARTITION BY app_id, sentiment) AS docs FROM (
                SELECT app_id, sentiment, cluster AS k, count(*) AS n FROM clustered GROUP BY app_id, sentiment, cluster)) s ON s.app_id = v.app_id AND s.sentiment = v.sentiment
        JOIN weights w ON w.app_id = v.app_id AND w.sentiment = v.sentiment AND w.term = v.term
        GROUP BY v.app_id, v.sentiment, v.term, s.k))"""
    out["cluster_terms"] = with_views("member_vectors clustered", """
SELECT app_id, sentiment, CAST(cluster AS BIGINT) AS cluster, term, score FROM terms""", label_views)
    def label_walk(banned: str) -> str:
        """Ranked usable terms per cluster, and the greedy walk over them."""
        return rf"""
ranked AS MATERIALIZED (SELECT app_id, sentiment, cluster, term, row_number() OVER (PARTITION BY app_id, sentiment, cluster ORDER BY score DESC, term) AS i
  FROM terms WHERE NOT list_has_any(string_split(term, ' '), {banned}) AND NOT regexp_matches(term, '\p{{Nd}}')),
walk AS (SELECT DISTINCT app_id, sentiment, cluster, 0::BIGINT AS i, []::VARCHAR[] AS chosen FROM terms
  UNION ALL
  SELECT w.app_id, w.sentiment, w.cluster, r.i, CASE WHEN len(list_filter(w.chosen, lambda c: contains(c, r.term) OR contains(r.term, c))) > 0
         THEN w.chosen ELSE list_append(w.chosen, r.term) END
  FROM walk w JOIN ranked r ON r.app_id = w.app_id AND r.sentiment = w.sentiment AND r.cluster = w.cluster AND r.i = w.i + 1
  WHERE len(w.chosen) < 3),
labels AS (SELECT app_id, sentiment, CAST(cluster AS BIGINT) AS cluster,
       CASE WHEN len(chosen) = 0 THEN 'mixed reviews' ELSE array_to_string(chosen, ', ') END AS description
  FROM walk QUALIFY row_number() OVER (PARTITION BY app_id, sentiment, cluster ORDER BY i DESC) = 1)"""

    banned = names(K.LABEL_STOP_WORDS)
    out["describe_clusters"] = with_views("member_vectors clustered", "SELECT * FROM labels", label_views + "," + label_walk(banned))
    out["item_profiles"] = with_views("plays text_reviews sampled profiles", """
SELECT * REPLACE (round(recommendation_rate, 6) AS recommendation_rate) FROM profiles""")
    out["run_manifest"] = with_views("plays text_reviews sampled profiles member_vectors clustered clusters", """
SELECT 'documents' AS source, 'hashed-tfidf' AS model, count(*) AS games, (SELECT count(*) FROM clusters) AS clusters,
       CAST(sum(sampled_positive + sampled_negative) AS BIGINT) AS review_sample_size, 42::BIGINT AS random_seed FROM profiles""")
    out["rank_items"] = with_views(SEARCH, f"""
SELECT row_number() OVER (ORDER BY wanted_similarity DESC, recommendation_rate DESC, app_id) AS rank, app_id, app_name,
       round(recommendation_rate, 6) AS recommendation_rate, wanted_similarity,
       greatest(0, wanted_similarity) * 100 AS match_pct, {excerpt('positive_review')} AS positive_review,
       {excerpt('negative_review')} AS negative_review
FROM scored QUALIFY rank <= 5""", SCORED)
    out["rank_items_avoid"] = with_views(SEARCH, """
SELECT rank, app_id, wanted_similarity, avoid_similarity,
       round(rank_score, 6) AS rank_score FROM placed WHERE rank <= 5""", SCORED)
    out["rank_items_batch"] = with_views(SEARCH, f"""
SELECT request_id, rank, app_id, app_name, wanted_similarity, avoid_similarity, round(rank_score, 6) AS rank_score,
       {excerpt('positive_review')} AS positive_review, {excerpt('negative_review')} AS negative_review
FROM ranked WHERE rank <= 5""", f"""
requests AS (SELECT w.vec_id AS request_id, CAST(w.embedding AS DOUBLE[]) AS wanted, CAST(a.embedding AS DOUBLE[]) AS avoid
  FROM embeddings w LEFT JOIN embeddings a ON a.vec_id = w.vec_id + 1 AND w.vec_id % 30 <> 0 WHERE w.vec_id % 10 = 0),
compared AS MATERIALIZED (SELECT r.request_id, r.avoid IS NOT NULL AS with_avoid, c.*,
    round(list_inner_product(CAST(CAST(c.embedding AS FLOAT[]) AS DOUBLE[]), r.wanted), 9) AS ws,
    round(list_inner_product(CAST(CAST(c.embedding AS FLOAT[]) AS DOUBLE[]), r.avoid), 9) AS avs,
    CASE WHEN length(coalesce(representative_review, '')) >= {K.READABLE_CHARS} THEN 1 ELSE 0 END AS readable FROM clusters c, requests r),
every AS (SELECT s.*, i.app_name, i.recommendation_rate FROM items i JOIN (
  SELECT request_id, with_avoid, app_id, max(ws) FILTER (WHERE sentiment = 'positive') AS wanted_similarity,
         coalesce(max(avs) FILTER (WHERE sentiment = 'negative'), 0) AS avoid_similarity,
         arg_max(representative_review, (readable, ws, -cluster)) FILTER (WHERE sentiment = 'positive') AS positive_review,
         coalesce(arg_max(representative_review, (readable, sample_count, -cluster)) FILTER (WHERE sentiment = 'negative'), '') AS negative_review
  FROM compared GROUP BY request_id, with_avoid, app_id) s ON s.app_id = i.app_id
  WHERE i.recommendation_rate >= 60 AND wanted_similarity IS NOT NULL),
listed AS (SELECT *, max(wanted_similarity) OVER w AS wmax, min(wanted_similarity) OVER w AS wmin,
                  max(avoid_similarity) OVER w AS amax, min(avoid_similarity) OVER w AS amin
  FROM (SELECT * FROM every QUALIFY NOT with_avoid OR row_number() OVER (PARTITION BY request_id ORDER BY wanted_similarity DESC, app_id) <= {K.CANDIDATE_POOL})
  WINDOW w AS (PARTITION BY request_id)),
scored_lists AS (SELECT *, CASE WHEN NOT with_avoid THEN wanted_similarity ELSE
    CASE WHEN wmax - wmin > 1e-9 THEN (wanted_similarity - wmin) / (wmax - wmin) ELSE 0 END
    - {K.AVOID_PENALTY} * CASE WHEN amax - amin > 1e-9 THEN (avoid_similarity - amin) / (amax - amin) ELSE 0 END END AS rank_score FROM listed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(rank_score, 9) DESC, recommendation_rate DESC, app_id) AS rank FROM scored_lists)""")
    out["moved_down"] = with_views(SEARCH, "SELECT app_id, app_name FROM placed WHERE plain <= 3 AND rank > 3", SCORED)
    out["item_search"] = with_views(SEARCH, f"""
SELECT app_id, app_name, rank, greatest(0, wanted_similarity) * 100 AS match_pct, {excerpt('positive_review')} AS positive_review
FROM placed WHERE rank <= 3
UNION ALL SELECT app_id, app_name, NULL, NULL, NULL FROM placed WHERE plain <= 3 AND rank > 3""", SCORED)
    out["random_pick"] = with_views(SEARCH, """
SELECT c.app_id, c.app_name, round(c.recommendation_rate, 6) AS recommendation_rate,
       arg_min(t.representative_review, (-readable, md5(t.app_id || '|' || t.cluster || '|43'), t.cluster)) FILTER (WHERE sentiment = 'positive') AS positive_review,
       coalesce(arg_max(t.representative_review, (readable, sample_count, -t.cluster)) FILTER (WHERE sentiment = 'negative'), '') AS negative_review
FROM (SELECT * FROM items WHERE recommendation_rate >= 60 AND app_id IN (SELECT app_id FROM clusters WHERE sentiment = 'positive')
      ORDER BY md5(app_id || '|42'), app_id LIMIT 1) c
JOIN (SELECT *, CASE WHEN length(coalesce(representative_review, '')) >= 90 THEN 1 ELSE 0 END AS readable FROM clusters) t ON t.app_id = c.app_id
GROUP BY c.app_id, c.app_name, c.recommendation_rate""")
    out["stream_item_counts"] = with_views("plays", f"""
SELECT * REPLACE (round(recommendation_rate, 6) AS recommendation_rate) FROM ({COUNTS.format(source='plays')})""")
    out["stream_hash_sample"] = with_views("plays", """
SELECT review_id, app_id, recommended FROM plays WHERE length(trim(review)) >= 20 AND recommended IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY app_id, recommended ORDER BY md5(review_id || '|42'), review) <= 10""")
    out["stream_resume"] = with_views("plays responses classified", """
SELECT review_id, fetch_status, CAST(achievements_unlocked AS BIGINT) AS achievements_unlocked FROM classified""")
    letters = ", ".join(f"length(t) - length(replace(t, '{chr(c)}', ''))" for c in range(97, 123))

    def letter_themes(rows: str) -> str:
        """Members of (review_id, app_id, recommended, review) rows with their theme and its closeness."""
        return f"""member_vectors AS MATERIALIZED (
SELECT review_id AS vec_id, app_id, sentiment, review,
       CAST(CAST(CASE WHEN length > 0 THEN list_transform(v, lambda x: x / length) ELSE v END AS FLOAT[]) AS DOUBLE[]) AS embedding
FROM (SELECT *, sqrt(list_inner_product(v, v)) AS length FROM (
  SELECT *, CAST([{letters}] AS DOUBLE[]) AS v FROM (
    SELECT review_id, app_id, CASE WHEN recommended THEN 'positive' ELSE 'negative' END AS sentiment, review, lower(review) AS t
    FROM ({rows}))))),
""" + kmeans(K.KMEANS_RESTARTS, TWIN_ROUNDS, size=26) + f""",
centers AS (SELECT app_id, sentiment, cluster, c AS at, sqrt(list_inner_product(c, c)) AS length FROM c{TWIN_ROUNDS} JOIN won USING (app_id, sentiment, r)),
themed AS MATERIALIZED (SELECT m.*, l.cluster,
       round(list_inner_product(m.embedding, list_transform(n.at, lambda x: CASE WHEN n.length > 0 THEN x / n.length ELSE x END)), 9) AS score
  FROM last l JOIN won USING (app_id, sentiment, r) JOIN member_vectors m ON m.vec_id = l.vec_id
  JOIN centers n ON n.app_id = l.app_id AND n.sentiment = l.sentiment AND n.cluster = l.cluster)"""

    profile = letter_themes(f"""SELECT s.review_id, s.app_id, s.recommended, {strip("coalesce(r.review, '')")} AS review
FROM sampled s JOIN text_reviews r ON r.review_id = s.review_id""")
    closest = f"""arg_min({strip("replace(t.review, chr(10), ' ')")}, (-t.score, t.vec_id)) AS representative_review"""
    out["item_profile_study"] = with_views("plays text_reviews sampled profiles", f"""
SELECT t.app_id, t.app_id AS app_name, t.sentiment, CAST(t.cluster AS BIGINT) AS cluster, count(*) AS sample_count,
       {closest}, any_value(p.review_count) AS review_count, any_value(p.sampled_positive) AS sampled_positive
FROM themed t JOIN profiles p ON p.app_id = t.app_id GROUP BY t.app_id, t.sentiment, t.cluster""", profile)
    one_item = f"""picked AS MATERIALIZED (SELECT review_id, 'src1' AS app_id, app_name, recommended, review FROM (
  SELECT * REPLACE ({strip("coalesce(review, '')")} AS review) FROM text_reviews WHERE contains(lower(app_name), 'src1'))
  WHERE length(review) >= 20
  QUALIFY row_number() OVER (PARTITION BY recommended ORDER BY md5(review_id || '|42'), review) <= 150),
title AS (SELECT app_name FROM picked GROUP BY app_name ORDER BY count(*) DESC, app_name LIMIT 1),
"""
    own_words = f"list_concat({banned}, [(SELECT app_name FROM title)])"
    out["theme_map_labels"] = with_views("plays text_reviews", f"""
SELECT (SELECT app_name FROM title) AS app_name, t.sentiment, CAST(t.cluster AS BIGINT) AS cluster,
       coalesce(any_value(l.description), 'mixed reviews') AS description, count(*) AS sample_count,
       round(count(*) / any_value(t.n) * 100, 6) AS share, {closest}
FROM (SELECT *, count(*) OVER (PARTITION BY sentiment) AS n FROM themed) t
LEFT JOIN labels l ON l.sentiment = t.sentiment AND l.cluster = t.cluster GROUP BY t.sentiment, t.cluster""",
                                         one_item + letter_themes("SELECT * FROM picked") + """,
clustered AS MATERIALIZED (SELECT * FROM themed),
""" + label_views + "," + label_walk(own_words))
    plays_box = BOX.format(cohort=COHORT, strip=strip("coalesce(review, '')"), source="plays")
    out["cohort_study"] = with_views("plays", """
SELECT cohort_order, cohort, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, n, round(share, 6) AS share,
       round(free_share, 6) AS free_share, round(raw_mean, 6) AS raw_mean, round(trimmed_mean, 6) AS trimmed_mean
FROM levels JOIN boxed USING (cohort) JOIN shares USING (cohort) JOIN free USING (cohort) JOIN votes USING (cohort)""",
                                     ", ".join([LEVELS, plays_box, SHARES, FREE, VOTES]))
    out["enrichment_study"] = with_views("plays states responses classified", """
SELECT CAST(p.review_id AS VARCHAR) AS review_id, CAST(p.app_id AS VARCHAR) AS app_id, c.fetch_status,
       CAST(c.achievements_unlocked AS BIGINT) AS achievements_unlocked, CAST(c.total_achievements AS BIGINT) AS total_achievements
FROM plays p JOIN classified c ON c.review_id = p.review_id JOIN chosen ON chosen.rater_id = p.rater_id""", """
chosen AS (SELECT u.rater_id FROM (SELECT DISTINCT rater_id FROM plays) u JOIN states s ON s.rater_id = u.rater_id
  WHERE s.state = 3 ORDER BY md5(u.rater_id || '|42'), CAST(u.rater_id AS VARCHAR) LIMIT 20)""")
    study = []
    parts = ["SELECT 'rate' AS part, label AS item, rate AS value FROM (" + rate_by_band("completed", "pct") + ")"]
    for name, rating, seed in (("positive", "recommended", 10), ("negative", "NOT recommended", 20)):
        parts.append(f"""SELECT '{name}_themes', playtime_group || ' / ' || completion_group, balance
FROM ({theme_balance('completed', 'pct', rating)})""")
        study.append(sides(name, "completed", "pct", rating, seed))
        study.append(tfidf(f"{name}_weights", name, "id", "string_split(text, ' ')", carry="side"))
        parts.append(f"SELECT '{name}_' || side, term, score FROM ({top_terms(f'{name}_weights', name)})")
    out["completion_study"] = with_views("plays text_reviews completed", f"""
SELECT part, item, round(value, 6) AS value FROM ({' UNION ALL '.join(parts)})""", ",\n".join(study))
    return out
