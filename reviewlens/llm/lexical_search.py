"""Ranked lexical search turned round: documents stream through an index of the items' terms.

The items' inverted index is small and is broadcast; every document's term
counts run through it, and each task keeps a bounded heap per item. Heaps are
merged at the end, so no list of an item's matches is ever built. Weights and
lengths are counted over all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import arrow_map, slices, stage, texts_of
from reviewlens.operators.sampling import top_k_per_group

#: Documents returned for each item.
TOP = 20
#: Entries (item and term) and bytes of terms in one index; more items make several, each of which sees all documents.
#: Items with one of 65,536 hash values stay together, so an index holds at most this or the items of one value.
INDEX_ENTRIES, INDEX_BYTES = 500_000, 32_000_000
#: Scores and index entries worked on at once in a task.
CELLS = 2_000_000
#: Bytes of a text whose terms are listed at once.
PIECE_BYTES = 1_000_000

#: Bytes outside of terms become spaces, A-Z become a-z.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a whole text."""
    text, counts, start = text.translate(_FOLD), Counter(), 0
    while start < len(text):
        cut = text.find(b" ", start + PIECE_BYTES)
        cut = len(text) if cut < 0 else cut
        counts.update(text[start:cut].split())
        start = cut
    return counts


@dataclass
class Index:
    """Inverted index of a lot of items: the entries of term t are places bounds[t] to bounds[t + 1] of ``items`` and ``times``."""

    terms: dict[bytes, int]
    bounds: np.ndarray
    items: np.ndarray
    times: np.ndarray
    n_items: int

    @staticmethod
    def of(entries: list[tuple[int, bytes, int]], n_items: int) -> Index:
        """From entries (item, term, times)."""
        terms = {term: i for i, term in enumerate(sorted({term for _, term, _ in entries}))}
        of_term = np.array([terms[term] for _, term, _ in entries], dtype=np.int64)
        order = np.argsort(of_term, kind="stable")
        bounds = np.searchsorted(of_term[order], np.arange(len(terms) + 1))
        column = lambda at: np.array([entry[at] for entry in entries], dtype=np.int64)[order]
        return Index(terms, bounds, column(0), column(2), n_items)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, mark, term, times) of each item's distinct terms; ``mark`` tells texts with one item_id apart."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = [term_counts(text) for text in texts_of(batch.column("text"))]
        row = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(row), batch.column("mark").take(row), pa.array([t for c in counts for t in c], pa.binary()),
             pa.array([n for c in counts for n in c.values()], pa.int64())], names=["item_id", "mark", "term", "times"])

    plain = items.select("item_id", F.md5(F.col("text").cast("string")).alias("mark"), F.col("text").cast("string").alias("text"))
    kind = dict(plain.dtypes)["item_id"]
    distinct = plain.where("text IS NOT NULL").dropDuplicates(["item_id", "mark"])
    return arrow_map(distinct, work, f"item_id {kind}, mark string, term binary, times long")


def item_lots(terms: DataFrame) -> list[tuple[int, int]]:
    """Ranges of hash values (low, high) whose items fit one index; the driver sees a sum per value."""
    sizes = terms.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("term")).alias("size")).collect()
    lots, low, entries, size = [], None, 0, 0
    for row in sorted(sizes, key=lambda row: row["part"]):
        if low is not None and (entries + row["n"] > INDEX_ENTRIES or size + row["size"] > INDEX_BYTES):
            lots.append((low, row["part"] - 1))
            low = None
        if low is None:
            low, entries, size = row["part"], 0, 0
        entries, size = entries + row["n"], size + row["size"]
    return lots if low is None else [*lots, (low, 65_535)]


def counted_documents(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n_terms, terms, times) of every document with a term: all its terms' number, and the counts of those in the index."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        n_terms, numbers, times = [], [], []
        for text in texts_of(batch.column("text")):
            counts = term_counts(text)
            n_terms.append(counts.total())
            here = counts.keys() & known.keys()
            numbers.append([known[term] for term in here])
            times.append([counts[term] for term in here])
        out = pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_terms, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
            names=["doc_id", "n_terms", "terms", "times"])
        yield out.filter(pa.array([n > 0 for n in n_terms], pa.bool_()))

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(plain, work, "doc_id long, n_terms long, terms array<int>, times array<long>")


class Heaps:
    """The best documents of each item so far; a smaller doc_id wins a tie."""

    def __init__(self, index: Index, weights: np.ndarray, n_docs: int, all_terms: int, top: int):
        self.index, self.weights, self.n_docs, self.all_terms, self.top = index, weights, n_docs, all_terms, top
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(index.n_items)]
        self.least = np.ones(index.n_items, dtype=np.int64)

    def add(self, doc_ids: np.ndarray, n_terms: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray) -> None:
        """Documents with ``sizes[i]`` terms of the index each, their numbers and counts one after the other."""
        entries = self.index.bounds[terms + 1] - self.index.bounds[terms]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cells = np.concatenate([[0], np.cumsum(entries)])[ends]
        cost = cells + self.index.n_items * np.arange(len(ends))
        start = 0
        while start < len(doc_ids):
            stop = max(start + 1, int(np.searchsorted(cost, cost[start] + CELLS, side="right")) - 1)
            part = slice(ends[start], ends[stop])
            self._add(doc_ids[start:stop], n_terms[start:stop], sizes[start:stop], terms[part], times[part], entries[part])
            start = stop

    def _add(self, doc_ids, n_terms, sizes, terms, times, entries) -> None:
        lengths = np.array([75 + 25 * n * self.n_docs // self.all_terms for n in n_terms.tolist()], dtype=np.int64)
        row = np.repeat(np.arange(len(doc_ids)), sizes)
        gain = self.weights[terms] * (1_000_000_000 * times // (1000 * times + 12 * lengths[row]))
        at = np.repeat(self.index.bounds[terms] - (np.cumsum(entries) - entries), entries) + np.arange(entries.sum())
        scores = np.zeros((len(doc_ids), self.index.n_items), dtype=np.int64)
        np.add.at(scores.reshape(-1), np.repeat(row * self.index.n_items, entries) + self.index.items[at],
                  np.repeat(gain, entries) * self.index.times[at])
        least = self.least
        if len(doc_ids) > self.top:
            # of these documents only an item's first few can get into its heap
            least = np.maximum(least, np.partition(scores, -self.top, axis=0)[-self.top])
        docs, items = np.nonzero(scores >= least)
        for doc, item, score in zip(doc_ids[docs].tolist(), items.tolist(), scores[docs, items].tolist()):
            heap = self.heaps[item]
            if len(heap) < self.top:
                heapq.heappush(heap, (score, -doc))
            else:
                heapq.heappushpop(heap, (score, -doc))
            if len(heap) == self.top:
                self.least[item] = heap[0][0]

    def batch(self) -> pa.RecordBatch:
        rows = [(item, -doc, score) for item, heap in enumerate(self.heaps) for score, doc in heap]
        columns = zip(*rows) if rows else ([], [], [])
        kinds = (pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["item", "doc_id", "score"])


def best_documents(counted: DataFrame, index, weights: np.ndarray, n_docs: int, all_terms: int, top: int) -> DataFrame:
    """(item, rank, doc_id, score): every task's heaps, merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.value, weights, n_docs, all_terms, top)
        for batch in batches:
            for part in slices(batch):
                terms, times = part.column("terms"), part.column("times")
                heaps.add(part.column("doc_id").to_numpy(), part.column("n_terms").to_numpy(),
                          terms.value_lengths().to_numpy(), terms.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy())
        yield heaps.batch()

    rows = counted.where("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(run, "item int, doc_id long, score long")
    return top_k_per_group(rows, ["item"], [F.desc("score"), F.col("doc_id")], top, "rank")


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` highest-scoring documents.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z
    lower-cased. With N documents that have a term and L terms in them, a term
    in df of them weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``; tf
    occurrences in a document of n terms count ``10^9 tf div (1000 tf + 12 m)``
    with ``m = 75 + 25 n N div L``. A score sums both factors' products over the
    item's terms, repeats included; documents without a common term are left
    out. Equal scores go by doc_id; ranks start at 1.

    Null or empty texts have no terms: such documents are not counted, such
    items return nothing. Every row is a document of its own, also where a
    doc_id repeats; rows without doc_id are counted but not returned. Items
    that repeat in full count once, an item_id with several texts is ranked for
    each of them. Other columns are not read.
    """
    spark = docs.sparkSession
    part = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("item_id").cast("string"), "mark")), 1, 4), 16, 10).cast("int")
    terms = stage(item_terms(items).withColumn("part", part), "item-terms")
    lots, parts, totals = item_lots(terms), [], None
    for low, high in lots:
        # bounded: an index's worth of entries
        rows = terms.where(F.col("part").between(low, high)).collect()
        names = sorted({(r["item_id"], r["mark"]) for r in rows}, key=str)
        number = {name: i for i, name in enumerate(names)}
        index = Index.of([(number[r["item_id"], r["mark"]], bytes(r["term"]), r["times"]) for r in rows], len(names))
        shared = spark.sparkContext.broadcast(index)
        counted = stage(counted_documents(docs, shared), "term-counts")
        if totals is None:
            totals = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        n_docs, all_terms = totals
        found = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect())
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(i, 0) + 1))) for i in range(len(index.terms))], dtype=np.int64)
        best = best_documents(counted, shared, weights, n_docs, all_terms, top)
        kind = dict(terms.dtypes)["item_id"]
        named = spark.createDataFrame([(i, name[0]) for i, name in enumerate(names)], f"item int, item_id {kind}")
        best = best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        # one index after the other: the next is not sent before this one has done its work
        parts.append(best if len(lots) == 1 else stage(best, "ranked"))
    if not parts:
        return items.select("item_id").limit(0).withColumns(
            {"rank": F.lit(0), "doc_id": F.lit(0).cast("long"), "score": F.lit(0).cast("long")})
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
