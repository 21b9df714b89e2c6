"""Toxicity by a learned, weighted lexicon that Aho-Corasick matches in folded text.

Folding undoes look-alike letters and digit substitutions. Terms are word
starts learned from labelled documents; a term inside an exception phrase does
not count. The weights found are normalised by the length of the text, and a
logistic curve fitted on the same labelled documents turns them into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import arrow_map, slices
from reviewlens.llm.labelled import remainder, training_rows

FOLDS, HELD_OUT = 5, 0
#: Most labelled documents that are learned from.
TRAINING_LIMIT = 20_000
#: Lengths of the word starts that can become terms, and the most terms kept.
STEMS = range(3, 11)
TERM_LIMIT = 2_000
#: A term appears in at least this share of the toxic training documents, and in LEAST_DOCS.
LEAST_SHARE, LEAST_DOCS = 0.004, 4
#: Least logarithm of the odds of a term.
LEAST_WEIGHT = 1.5
#: Harmless uses; a term inside such a phrase is passed over.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "scum line", "worthless check")

# Letters and signs that look like Latin letters.
LOOK_ALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
_FOLD = {ord(sign): letter for sign, letter in LOOK_ALIKES.items()}
# full-width forms, zero-width signs and soft hyphens by rule
_FOLD |= {0xFF41 + i: chr(97 + i) for i in range(26)}
_FOLD |= dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD])
_BREAKS = re.compile(r"[^\w]+|_+")


def folded(text: str) -> str:
    """Lower case, look-alikes and digits as letters, every other sign a single space, spaces around."""
    return f" {_BREAKS.sub(' ', text.lower().translate(_FOLD))} "


@dataclass
class Lexicon:
    """Weight of each term (a word start), and the logistic curve over the features."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...] = ()

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(f" {term}", (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(folded(phrase), (len(folded(phrase)) - 1, None))
        if len(found):
            found.make_automaton()
        return found


def features(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Of the terms outside exception phrases: logarithm of the whole weight, weight by length, largest weight."""
    plain = folded(text)
    best: dict[int, float] = {}
    passed: list[tuple[int, int]] = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(plain):
            start = end - length
            if weight is None:
                passed.append((start, end))
            else:
                best[start] = max(best.get(start, 0.0), weight)
    for a, b in passed:
        for start in [s for s in best if a <= s < b]:
            del best[start]
    total = sum(best.values())
    # a word has about six letters; the share is of the weight a text of insults alone would have
    share = total * 6 / max(len(plain), 60)
    return math.log1p(total), math.log1p(100 * share), max(best.values(), default=0.0)


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
        words = set(folded(text).split())
        stems = {w[:n] for w in words for n in STEMS if n <= len(w)}
        (toxic if label else clean).update(stems)
    names = list(toxic)  # a term is seen in a toxic document at least once; the clean counts of others are of no use
    rest = [s for s in clean if s not in toxic]
    for part, t in ((names, toxic), (rest, None)):
        if part:
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([t[s] if t else 0 for s in part], pa.int64()),
                 pa.array([clean[s] for s in part], pa.int64())], names=["stem", "toxic", "clean"])


def learn_terms(rows: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Word starts whose odds speak for label 1, with the logarithm of the odds as weight."""
    least = max(LEAST_DOCS, LEAST_SHARE * n_toxic)
    odds = F.log((F.col("toxic") + 0.2) / (n_toxic + 0.4) * (n_clean + 0.4) / (F.col("clean") + 0.2))
    found = (
        arrow_map(rows, _counted, "stem string, toxic long, clean long")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least).withColumn("weight", odds).where(F.col("weight") >= LEAST_WEIGHT)
        # at most TERM_LIMIT rows reach the driver
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "stem").limit(TERM_LIMIT).collect()
    )
    # of word starts that mark the same documents the longest one says most exactly what was found
    toxic = {row["stem"]: row["toxic"] for row in found}
    extended = {row["stem"][:-1] for row in found if row["toxic"] == toxic.get(row["stem"][:-1])}
    found = [row for row in found if row["stem"] not in extended]
    terms: dict[str, float] = {}
    for row in sorted(found, key=lambda r: (len(r["stem"]), r["stem"])):
        stem, weight = row["stem"], row["weight"]
        # a longer start adds nothing to a shorter one that says as much
        known = max((terms[stem[:n]] for n in STEMS if stem[:n] in terms and n < len(stem)), default=None)
        if known is None or weight > known + 1:
            terms[stem] = weight
    return terms


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and a constant by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_LIMIT, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon and its curve from at most ``limit`` labelled documents outside the held-out fold."""
    rows = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, limit).select("text", "label").persist()
    try:
        sums = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
        n_toxic, n = sums[0] or 0, sums[1]
        lexicon = Lexicon(learn_terms(rows, n_toxic, n - n_toxic), exceptions)

        def measured(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            automaton = lexicon.automaton()
            found = [features(t, automaton) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("label")], names=["a", "b", "c", "label"])

        # three numbers for each of at most ``limit`` documents
        seen = arrow_map(rows, measured, "a double, b double, c double, label int").toPandas().to_numpy(dtype=float)
    finally:
        rows.unpersist()
    if not n_toxic or n_toxic == n:
        # one label only: its share is all there is to learn
        share = (n_toxic + 0.5) / (n + 1)
        return Lexicon(lexicon.terms, exceptions, (0.0, 0.0, 0.0, math.log(share / (1 - share))))
    seen = seen[np.lexsort(seen.T)]
    return Lexicon(lexicon.terms, exceptions, tuple(logistic(seen[:, :3], seen[:, 3]).tolist()))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score and predicted for each row; the whole text is read.

    A null text counts as empty and gets the score of a text without terms.
    Rows that repeat are scored each; a null doc_id stays null and counts as
    not held out. Other columns of the input are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        curve = np.array(lexicon.curve)
        for batch in batches:
            for part in slices(batch):
                found = np.array([features(t or "", automaton) for t in part.column("text").to_pylist()])
                value = 1 / (1 + np.exp(-np.clip(found @ curve[:-1] + curve[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return plain.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_LIMIT) -> DataFrame:
    """Learn from the labels, then score every document."""
    return score(docs, learn(docs, labels, limit))
