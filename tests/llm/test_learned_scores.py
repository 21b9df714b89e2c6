"""The learned operators against plain loops."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from reviewlens.llm import quality, toxicity
from reviewlens.llm.common import table

# --- toxicity --------------------------------------------------------------------------


def plain_terms(rows):
    """Terms and weights from (text, label) rows."""
    n_toxic = sum(label for _, label in rows)
    n_clean = len(rows) - n_toxic
    toxic, clean = Counter(), Counter()
    for text, label in rows:
        for stem in {w[:n] for w in toxicity.folded(text).split() for n in range(3, 11) if len(w) >= n}:
            (toxic if label else clean)[stem] += 1
    weigh = lambda s: math.log((toxic[s] + 0.2) / (n_toxic + 0.4) * (n_clean + 0.4) / (clean[s] + 0.2))
    found = {s: weigh(s) for s, n in toxic.items() if n >= max(4, 0.004 * n_toxic) and weigh(s) >= 1.5}
    found = dict(sorted(found.items(), key=lambda e: (-e[1] * math.sqrt(toxic[e[0]]), e[0]))[:2000])
    longest = {s: w for s, w in found.items() if not any(t[:-1] == s and toxic[t] == toxic[s] for t in found)}
    terms = {}
    for stem in sorted(longest, key=lambda s: (len(s), s)):
        shorter = [terms[stem[:n]] for n in range(3, len(stem)) if stem[:n] in terms]
        if not shorter or longest[stem] > max(shorter) + 1:
            terms[stem] = longest[stem]
    return terms


def plain_features(text, terms):
    plain = toxicity.folded(text)
    skipped = set()
    for phrase in map(toxicity.folded, toxicity.EXCEPTIONS):
        for i in range(len(plain)):
            if plain.startswith(phrase, i):
                skipped |= set(range(i, i + len(phrase) - 1))
    weights = []
    for i, sign in enumerate(plain):
        here = [w for t, w in terms.items() if sign == " " and plain.startswith(t, i + 1)]
        if here and i not in skipped:
            weights.append(max(here))
    return math.log1p(sum(weights)), math.log1p(100 * sum(weights) * 6 / max(len(plain), 60)), max(weights, default=0.0)


def plain_curve(x, y, ridge=1e-2):
    """Logistic regression by Newton steps with plain sums."""
    w = [0.0] * 4
    for _ in range(30):
        slope, bend = [ridge * v for v in w], [[ridge * (i == j) for j in range(4)] for i in range(4)]
        for row, label in zip(x, y):
            row = [*row, 1.0]
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(row, w))))))
            for i in range(4):
                slope[i] += (p - label) * row[i]
                for j in range(4):
                    bend[i][j] += p * (1 - p) * row[i] * row[j]
        w = [a - b for a, b in zip(w, np.linalg.solve(bend, slope))]
    return w


def test_toxicity_equals_plain_loops(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    learned = [i for i in truth if i in texts and zlib.crc32(str(i).encode()) % 5 != 0]
    rows = [(texts[i], truth[i]) for i in learned]
    terms = plain_terms(rows)
    lexicon = toxicity.learn(docs, labels)
    assert lexicon.terms == pytest.approx(terms) and terms
    curve = plain_curve([plain_features(t, terms) for t, _ in rows], [label for _, label in rows])
    scores = {i: 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip([*plain_features(t, terms), 1.0], curve)))))) for i, t in texts.items()}
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert {i: r["score"] for i, r in found.items()} == pytest.approx(scores, abs=1e-6)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found.values())


# --- quality ---------------------------------------------------------------------------


def plain_passages(text):
    """Feature rows of a text's passages, byte by byte and word by word."""
    blank = set(b" \t\n\v\f\r")
    words, at = [], 0
    while at < len(text):
        if text[at] in blank:
            at += 1
            continue
        end = at
        while end < len(text) and text[end] not in blank:
            end += 1
        words.append((at, end))
        at = end
    if not words:
        return [[0.0] * quality.WIDTH]

    def kind(b):
        if 97 <= b <= 122:
            return 0
        if 65 <= b <= 90:
            return 1
        if 48 <= b <= 57:
            return 2
        if b in b" \t\v\f":
            return 3
        return 4 if b in b"\n\r" else 6 if b >= 128 else 5

    # one blank follows each text
    kinds = [kind(b) for b in text + b" "]
    out = []
    for low in range(0, len(words), 40):
        part = words[low : low + 40]
        begin, end = part[0][0], words[low + 40][0] if low + 40 < len(words) else len(text) + 1
        grid = Counter(kinds[i] * 49 + kinds[i + 1] * 7 + kinds[i + 2] for i in range(begin, min(end, len(kinds) - 2)))
        row = [math.sqrt(grid[c] / (end - begin)) for c in range(343)]
        sizes, strings = [b - a for a, b in part], [text[a:b] for a, b in words]
        mean = sum(sizes) / len(part)
        row += [mean / 10, math.sqrt(max(sum(s * s for s in sizes) / len(part) - mean**2, 0)) / 10]
        places = range(low, low + len(part))
        row.append(sum(i > 0 and strings[i] == strings[i - 1] for i in places) / len(part))
        row.append(sum(strings[i] in strings[low:i] for i in places) / len(part))
        row.append(sum(strings[i] in strings[:i] for i in places) / len(part))
        row += [math.log1p(len(words)) / 10, sum(s <= 1 for s in sizes) / len(part)]
        out.append(row)
    return out


def plain_score(w, rows):
    """Gated attention over one document's passages with plain loops."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    passages, pulls = [], []
    for row in rows:
        n = [(v - m) / s for v, m, s in zip(row, w["mean"], w["scale"])]
        h = [math.tanh(sum(v * w["W"][i][j] for i, v in enumerate(n)) + w["b"][j]) for j in range(quality.HIDDEN)]
        gate = [math.tanh(sum(v * w["V"][i][j] for i, v in enumerate(h))) * sigmoid(sum(v * w["U"][i][j] for i, v in enumerate(h))) for j in range(quality.GATE)]
        passages.append(h)
        pulls.append(math.exp(sum(a * b for a, b in zip(gate, w["a"]))))
    share = [p / sum(pulls) for p in pulls]
    z = [sum(s * h[j] for s, h in zip(share, passages)) for j in range(quality.HIDDEN)]
    return sigmoid(sum(a * b for a, b in zip(z, w["c"])) + float(w["d"]))


@pytest.fixture(scope="module")
def model(spark):
    # weights of a short training, enough for every part to matter
    docs, labels = (table(spark, "/root/testdata/sf0.001", name) for name in ("documents", "labels"))
    return quality.learn(docs, labels, rounds=3)


def test_quality_equals_plain_loops(spark, sf, model):
    docs = table(spark, sf, "documents")
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    weights = {k: v.tolist() for k, v in model.weights.items()}
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect() if len(r["text"] or "") < 3000}
    assert len(texts) > 100
    expected = {i: plain_score(weights, plain_passages(t)) for i, t in texts.items()}
    # passages are kept in single precision
    assert {i: found[i] for i in texts} == pytest.approx(expected, abs=1e-5)


def test_gradient_equals_finite_differences(model):
    rng = np.random.default_rng(3)
    counts = np.array([1, 3, 2, 4])
    x, y = rng.normal(0, 1, (10, quality.WIDTH)), np.array([0.0, 1.0, 1.0, 0.0])
    weights = {k: np.array(v, dtype=float) for k, v in model.weights.items()} | {"mean": np.zeros(quality.WIDTH), "scale": np.ones(quality.WIDTH)}

    def loss(w):
        p = quality.Model(w).attend(x, counts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + 5e-5 * ((w["W"] ** 2).sum() + (w["c"] ** 2).sum())

    found = quality.slopes(quality.Model(weights), x, counts, y)
    for name, slope in found.items():
        slope = np.asarray(slope)
        for place in [tuple(rng.integers(0, n) for n in slope.shape) for _ in range(6)]:
            moved = []
            for step in (1e-5, -1e-5):
                other = {k: v.copy() for k, v in weights.items()}
                other[name][place] += step
                moved.append(loss(other))
            assert slope[place] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-4, abs=1e-8), name
