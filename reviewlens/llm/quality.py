"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages. Every passage is encoded as a vector; a gated
attention, learned from document labels alone, weighs the passages; the
weighted sum is the document's representation, which a logistic output scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.anchors import mixed
from reviewlens.llm.common import arrow_map, slices, texts_of
from reviewlens.llm.labelled import remainder, training_rows
from reviewlens.llm.words import words_of

FOLDS, HELD_OUT = 4, 2
#: predicted is 1 from this score on.
CUT = 0.7
#: Most labelled documents that are learned from.
TRAINING_LIMIT = 3_000
PASSAGE_WORDS = 40
HIDDEN, GATE = 24, 16
ROUNDS, BATCH, RATE = 30, 64, 4e-3

#: Class of each byte: small letter, capital, digit, blank, line end, sign, part of a longer character.
_CLASS = np.full(256, 5, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12]], _CLASS[[10, 13]], _CLASS[128:] = 3, 4, 6
_TRIGRAMS = 7**3
EXTRA = 7
WIDTH = _TRIGRAMS + EXTRA


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature row of every passage, and the number of passages of each text (1 for a text without words).

    A passage is PASSAGE_WORDS consecutive words with what stands between
    them. Features are the shares of byte-class trigrams, word lengths, and how
    far words repeat in the passage and in the document.
    """
    words = words_of(texts)
    sizes = np.diff(words.bounds)
    counts = np.maximum(1, -(-sizes // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros((first[-1], WIDTH), dtype=np.float32)
    if not len(words.codes):
        return out, counts
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(doc)) - words.bounds[:-1][doc]
    passage = first[:-1][doc] + place // PASSAGE_WORDS
    # bytes from a passage's first word to the next passage's or the text's end
    heads = np.flatnonzero(place % PASSAGE_WORDS == 0)
    begin = words.start[heads]
    text_end = np.cumsum([len(t) + 1 for t in texts])
    end = np.minimum(np.append(begin[1:], len(words.buffer)), text_end[doc[heads]])
    kind = _CLASS[words.buffer]
    tri = kind[:-2] * 49 + kind[1:-1] * 7 + kind[2:]
    owner = np.full(len(words.buffer) + 1, -1, dtype=np.int64)
    rows = passage[heads]
    change = np.zeros(len(words.buffer) + 1, dtype=np.int64)
    np.add.at(change, begin, np.arange(1, len(rows) + 1))
    # the last trigram ends with the blank after the text, so no other text of the batch has a part in it
    np.subtract.at(change, np.maximum(begin, np.minimum(end, text_end[doc[heads]] - 2)), np.arange(1, len(rows) + 1))
    owner = np.cumsum(change)[: len(tri)] - 1
    here = owner >= 0
    grid = np.bincount(owner[here] * _TRIGRAMS + tri[here], minlength=len(rows) * _TRIGRAMS).reshape(len(rows), -1)
    out[rows, :_TRIGRAMS] = np.sqrt(grid / np.maximum(end - begin, 1)[:, None])
    size = np.bincount(passage, minlength=len(out)).astype(np.float32)
    size[size == 0] = 1
    per = lambda values: np.bincount(passage, weights=values, minlength=len(out)) / size
    length = (words.end - words.start).astype(np.float64)
    again = np.zeros(len(doc))
    again[1:] = (words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])
    out[:, _TRIGRAMS] = per(length) / 10
    out[:, _TRIGRAMS + 1] = np.sqrt(np.maximum(per(length**2) - per(length) ** 2, 0)) / 10
    out[:, _TRIGRAMS + 2] = per(again)
    out[:, _TRIGRAMS + 3] = per(_repeated(words.codes, passage))
    out[:, _TRIGRAMS + 4] = per(_repeated(words.codes, doc))
    out[:, _TRIGRAMS + 5] = np.log1p(np.repeat(sizes, counts)) / 10
    out[:, _TRIGRAMS + 6] = per(length <= 1)
    return out, counts


def _repeated(codes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """1 for each word that stands earlier in its group, else 0."""
    keys = codes ^ mixed(group.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    found = np.zeros(len(keys))
    found[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return found


@dataclass
class Model:
    """Encoder, gate and output weights; features are centred and scaled first."""

    weights: dict[str, np.ndarray]

    def attend(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        n = (x - w["mean"]) / w["scale"]
        h = np.tanh(n @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        share = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(share[:, None] * h, starts, axis=0)
        return {"n": n, "h": h, "t": t, "g": g, "share": share, "z": z, "bag": bag, "starts": starts,
                "p": 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))}

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.attend(x, counts)["p"]


def slopes(model: Model, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss of the documents, with a small decay of W and c."""
    s, u = model.attend(x, counts), model.weights
    miss = (s["p"] - y) / len(y)
    back = (miss[:, None] * u["c"])[s["bag"]]
    dh = s["share"][:, None] * back
    pull = (back * s["h"]).sum(1)
    de = s["share"] * (pull - np.add.reduceat(s["share"] * pull, s["starts"])[s["bag"]])
    dt, dg = de[:, None] * u["a"] * s["g"], de[:, None] * u["a"] * s["t"]
    dt, dg = dt * (1 - s["t"] ** 2), dg * s["g"] * (1 - s["g"])
    dh += dt @ u["V"].T + dg @ u["U"].T
    da = dh * (1 - s["h"] ** 2)
    return {"W": s["n"].T @ da + 1e-4 * u["W"], "b": da.sum(0), "V": s["h"].T @ dt, "U": s["h"].T @ dg,
            "a": (s["t"] * s["g"]).T @ de, "c": s["z"].T @ miss + 1e-4 * u["c"], "d": miss.sum()}


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, seed: int = 1) -> Model:
    """Gradient steps (Adam) on the logistic loss of the documents."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"W": draw(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE),
         "a": draw(GATE), "c": draw(HIDDEN), "d": np.array(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))}
    model = Model(w | {"mean": x.mean(0), "scale": x.std(0) + 0.02})
    first = np.concatenate([[0], np.cumsum(counts)])
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(counts))
        for lot in np.array_split(order, max(1, len(order) // BATCH)):
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in lot])
            u = model.weights
            step += 1
            for k, v in slopes(model, x[rows], counts[lot], y[lot]).items():
                m = moment[k]
                m[0] = 0.9 * m[0] + 0.1 * v
                m[1] = 0.999 * m[1] + 0.001 * v * v
                u[k] = u[k] - RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_LIMIT, rounds: int = ROUNDS) -> Model:
    """A model from at most ``limit`` labelled documents outside the held-out fold; their whole texts are encoded."""
    rows = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, limit)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, counts = encode(texts_of(batch.column("text")))
        parts = np.split(x.astype(np.float16), np.cumsum(counts)[:-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["doc_id", "label", "bag"])

    # the passages of at most ``limit`` documents are all the driver gets
    seen = arrow_map(rows, work, "doc_id long, label int, bag binary").toPandas().sort_values("doc_id")
    y = seen["label"].to_numpy(dtype=float)
    if not len(y):
        return Model({})
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, WIDTH) for b in seen["bag"]]
    return fit(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), y, rounds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row; the whole text is read.

    A null text counts as empty; a text without words is one passage of zeros.
    Without any label to learn from every score is 0.5. Rows that repeat are
    scored each; a null doc_id stays null and counts as not held out. Other
    columns of the input are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x, counts = encode(texts_of(part.column("text")))
                value = model.score(x, counts) if model.weights else np.full(len(counts), 0.5)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return plain.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_LIMIT) -> DataFrame:
    """Learn from the labels, then score every document."""
    return score(docs, learn(docs, labels, limit))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents predicted to be good, with all their columns; rows are read once and never shuffled.

    Every row is judged by its own text, a null one as an empty one.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x, counts = encode(texts_of(part.column("text")))
                value = model.score(x, counts) if model.weights else np.ones(len(counts))
                yield part.filter(pa.array(value >= CUT)).select(names)

    return docs.mapInArrow(run, docs.schema)
