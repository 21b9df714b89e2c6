import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from reviewlens.operators import text
from reviewlens.session import materialize

STOP = ["the", "of"]


def brute_tfidf(docs, stop, low, share, limit, sublinear):
    """Weights of {id: text} by direct counting."""
    counts = {}
    for key, body in docs.items():
        words = [w for w in body.split() if len(w) >= 2 and w not in stop]
        counts[key] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    df, corpus = Counter(), Counter()
    for c in counts.values():
        df.update(c.keys())
        corpus.update(c)
    kept = [t for t in df if low <= df[t] <= share * len(docs)]
    kept = sorted(kept, key=lambda t: (-corpus[t], t))[:limit]
    out = {}
    for key, c in counts.items():
        w = {t: (1 + math.log(c[t]) if sublinear else c[t]) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in kept if t in c}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(key, t): x / norm for t, x in w.items()})
    return out


@pytest.fixture(scope="module")
def bodies():
    rng = np.random.default_rng(8)
    words = ["the", "of", "a", "sun", "moon", "star", "sea", "sand", "wind", "rain"]
    bodies = {i: " ".join(rng.choice(words, rng.integers(1, 15))) for i in range(60)}
    bodies[60] = "the of the"
    bodies[61] = ""
    return bodies


@pytest.mark.parametrize("low,share,limit,sublinear", [(2, 0.96, 7000, True), (1, 1.0, 12, False), (5, 0.5, 30, True)])
def test_tfidf_equals_direct_counting(spark, bodies, low, share, limit, sublinear):
    docs = spark.createDataFrame(list(bodies.items()), "id long, text string").repartition(5)
    found = text.tfidf(docs, "id", text.clean_tokens("text"), stop_words=STOP, min_documents=low,
                       max_share=share, max_features=limit, sublinear=sublinear)
    found = {(r["id"], r["term"]): r["weight"] for r in found.collect()}
    expected = brute_tfidf(bodies, STOP, low, share, limit, sublinear)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_rows_of_one_key_are_one_document(spark):
    docs = spark.createDataFrame([(1, "sun moon"), (1, "sun sand"), (2, "sun moon sun"), (3, None), (4, "")], "id long, text string")
    found = text.tfidf(docs, "id", text.clean_tokens("text"), stop_words=STOP, min_documents=2, max_share=1.0)
    found = {(r["id"], r["term"]): r["weight"] for r in found.collect()}
    sun, moon = (1 + math.log(2)) * (math.log(6 / 3) + 1), math.log(6 / 3) + 1
    norm = math.sqrt(sun**2 + 2 * moon**2)
    expected = {(i, t): w / norm for i in (1, 2) for t, w in (("sun", sun), ("moon", moon), ("sun moon", moon))}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_terms_are_counted_without_holding_those_of_other_documents(spark, bodies, monkeypatch):
    # no aggregate keeps (document, term) rows of a whole partition in memory, however many there are
    written = []
    monkeypatch.setattr(text, "materialize", lambda df: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or materialize(df))
    docs = spark.createDataFrame(list(bodies.items()), "id long, text string")
    found = text.tfidf(docs, "id", text.clean_tokens("text"), stop_words=STOP, min_documents=2, max_share=1.0)
    assert found.count() and not any("Aggregate" in plan and "id#" in plan.split("Aggregate")[1].split("\n")[0] for plan in written)


def test_pairs_bridge_stop_words(spark):
    docs = spark.createDataFrame([(1, "sun of the moon"), (2, "sun moon")], "id long, text string")
    found = text.tfidf(docs, "id", text.clean_tokens("text"), stop_words=STOP, min_documents=2, max_share=1.0)
    assert {r["term"] for r in found.collect()} == {"sun", "moon", "sun moon"}


def test_separate_corpora(spark, bodies):
    rows = [(key, f"g{key % 3}", body) for key, body in bodies.items()]
    docs = spark.createDataFrame(rows, "id long, g string, text string")
    found = text.tfidf(docs, "id", text.clean_tokens("text"), by=["g"], stop_words=STOP, min_documents=2, max_share=0.9, max_features=9)
    found = {(r["id"], r["term"]): r["weight"] for r in found.collect()}
    expected = {}
    for g in range(3):
        expected.update(brute_tfidf({k: b for k, b in bodies.items() if k % 3 == g}, STOP, 2, 0.9, 9, True))
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_default_minimum_follows_corpus_size(spark):
    rows = [(i, "sun" if i < 3 else "moon") for i in range(400)]
    docs = spark.createDataFrame(rows, "id long, text string")
    found = text.tfidf(docs, "id", text.clean_tokens("text"), max_share=1.0)
    assert {r["term"] for r in found.select("term").distinct().collect()} == {"moon"}


def test_difference_counts_empty_documents(spark, bodies):
    rows = [(k, "low" if k % 2 else "high", b) for k, b in bodies.items()]
    docs = spark.createDataFrame(rows, "id long, side string, text string")
    found = text.tfidf_difference(docs, "id", stop_words=STOP, min_documents=2)
    weights = brute_tfidf(bodies, STOP, 2, 0.96, 7000, True)
    expected = defaultdict(float)
    for (key, term), w in weights.items():
        expected[term] += -w / 31 if key % 2 else w / 31
    found = {r["term"]: r["difference"] for r in found.collect()}
    assert found.keys() == expected.keys()
    assert all(found[t] == pytest.approx(expected[t], abs=1e-12) for t in expected)


def test_top_terms(spark):
    rows = [("a", 0.5), ("b", -0.25), ("c", 0.5), ("d", 0.0), ("e", 0.75)]
    found = text.top_terms(spark.createDataFrame(rows, "term string, difference double"), 2)
    assert sorted((r["side"], r["rank"], r["term"], r["score"]) for r in found.collect()) == [
        ("high", 1, "e", 750), ("high", 2, "a", 500), ("low", 1, "b", 250)]


def test_raw_tokens(evaluate):
    assert evaluate(["Né à 2 l'été_1!"], lambda c: text.raw_tokens(c)) == [["né", "été_1"]]
    assert evaluate(["a bc"], lambda c: text.clean_tokens(c)) == [["bc"]]


def test_default_stop_words_hold_both_lists():
    words = text.default_stop_words()
    assert {"the", "steam", "wouldnt"} <= set(words) and len(words) == len(set(words))
