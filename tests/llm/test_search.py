"""Hard negatives and ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import hard_negatives, lexical_search, queries
from reviewlens.operators import blocks

# --- hard negatives ----------------------------------------------------------------


def plain_negatives(rows, is_anchor, positives=5, negatives=3):
    whole = {}
    for vec_id, label, vector in rows:
        if None not in (vec_id, label, vector) and None not in vector:
            whole[vec_id] = min(whole.get(vec_id, (label, vector)), (label, vector))
    out = set()
    for a, (label, vector) in whole.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, other) for i, (other, v) in whole.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(i, -s) for s, i, other in scored if other != label and -50 * minus <= -100 * s <= -95 * minus]
            out |= {(a, p, rank, n, -minus, score) for rank, (n, score) in enumerate(fits[:negatives], 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumns(
        {name: F.lit("x") for name in ("_a", "_r", "score", "key", "anchor_id", "windows")})


@pytest.mark.parametrize("block", [20, 2048])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, rng.randint(0, 2), [rng.randint(-3, 6) for _ in range(4)]) for i in range(-20, 60)]
    # ties, a hot label with equal vectors, zero scores, other lengths, nulls, repeats
    rows += [(100 + i, 1, [1, 1, 0, 0]) for i in range(40)] + [(200 + i, 7, [0, 0, 0, 0]) for i in range(6)]
    rows += [(300, 1, [2]), (301, 2, [1, 2, 3, 4, 5, 6]), (302, 1, []), (303, None, [1]), (304, 1, None), (305, 1, [1, None]), (None, 1, [1])]
    rows += [rows[0], rows[0], (5, 0, [9, 9, 9, 9]), (400, 9, [1, 1, 1, 1])]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 5 == 0).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == plain_negatives(rows, lambda i: i % 5 == 0)
    assert any(r["positive_score"] == 0 for r in found)


def test_hard_negatives_of_empty_and_large_values(spark):
    nothing = hard_negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 5 == 0)
    assert nothing.count() == 0
    assert nothing.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(0, 0, [2**26, 1]), (1, 0, [2**28, 3]), (2, 1, [2**27 + 2**26 + 1, 2]), (3, 1, [2**26, 9])]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") == 0)
    assert {tuple(r) for r in found.collect()} == plain_negatives(rows, lambda i: i == 0) != set()
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(vectors(spark, rows), F.lit(True), high=101)


def test_keys_sort_as_their_numbers():
    rng = np.random.default_rng(4)
    limits = np.array([-(2**63), -1, 0, 1, 2**63 - 1])
    numbers = lambda: np.concatenate([limits, rng.integers(-5, 5, 200), rng.permutation(limits)])
    anchor, score, other = numbers(), numbers(), numbers()
    keys = np.concatenate([hard_negatives.packed(anchor, score, kind, other) for kind in (0, 1)]).astype(hard_negatives.KEY)
    held = [keys[i : i + 1].tobytes() for i in range(len(keys))]
    rows = [(int(a), -int(s), k, int(o)) for k in (0, 1) for a, s, o in zip(anchor, score, other)]
    assert [r for _, r in sorted(zip(held, rows))] == sorted(rows)


# --- lexical search ----------------------------------------------------------------


def plain_ranking(docs, items, top=20):
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, all_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, counts in held:
            m = 75 + 25 * counts.total() * n_docs // all_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t, times in Counter(terms(text)).items() if t in counts)
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(item, rank, d, -minus) for rank, (minus, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    words = ["one", "Two", "three", "FOUR", "été", "的", "x1", "a", "b", "c", "d"]
    sentence = lambda most: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "_", "\x1c", "’"]) for _ in range(rng.randint(0, most)))
    return [(i, sentence(30)) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_ranked_documents(spark, monkeypatch, small):
    if small:
        for name, value in (("CELLS", 50), ("INDEX_ENTRIES", 8), ("PIECE_BYTES", 10)):
            monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(1)
    docs = corpus(rng, 150)
    docs += [(200, None), (201, ""), (202, ".,;"), (None, "one two"), (None, None), (3, docs[3][1]), (3, "one one"), (203, "One " * 100_000)]
    docs += [(300 + i, "ONE two one") for i in range(40)]
    items = [(i, rng.choice(["one two", "three four été", "的 x1 a a a", "b", "c d one"])) for i in range(6)]
    items += [(50, None), (51, ""), (52, "--"), (None, "four four"), (53, "one"), (53, "one"), (53, "two"), (54, "nowhere")]
    extra = {name: F.lit("x") for name in ("item", "score", "rank", "terms", "mark", "part")}
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(extra).repartition(5)
    found = lexical_search.ranked_documents(frame, spark.createDataFrame(items, "item_id long, text string").withColumns(extra))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = plain_ranking(docs, [i for i in items if i[1] is not None])
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_ranking_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{name} long, text string") for name in ("doc_id", "item_id"))
    full = spark.createDataFrame([(1, "one two")], "id long, text string")
    for d, i in ((docs, items), (full.withColumnRenamed("id", "doc_id"), items), (docs, full.withColumnRenamed("id", "item_id"))):
        found = lexical_search.ranked_documents(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_lexical_search"])
def test_equals_sql(spark, sf, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = queries.QUERIES[name](spark, sf)
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(names) == sorted(found.columns) and expected
    assert sorted(tuple(r[c] for c in names) for r in found.collect()) == sorted(expected)
