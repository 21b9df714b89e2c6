"""Repeated byte strings by difference-cover suffix sorting.

Spark deals the text out so that equal strings meet in one task: strings of
``LENGTH`` bytes with one anchor (see ``anchors``) go to one place, once for
each distinct surrounding. A task sorts the suffixes of its text by the
difference cover modulo 3: it names the sampled suffixes by triples, names
triples of names until they span ``LENGTH`` bytes, merges the remaining
suffixes in by their first byte and the name behind it, and compares adjacent
prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import arrow_map, stage, texts_of
from reviewlens.llm.repeats import marked_units, removed_elements, span_arrays, with_spans
from reviewlens.llm.words import BYTE_CODES

#: Bytes of a string, and of the anchors inside it.
LENGTH, ANCHOR = 100, 32
#: Bytes sorted at once; a slot with more text is compared string by string instead, through a shuffle.
LOT_BYTES = 1_000_000
_WORD = 8


def _dense(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order by the keys, the first one foremost, and for each prefix of the keys whether a row begins a new value."""
    order = np.lexsort(keys[::-1])
    new, seen = np.zeros(len(order), dtype=bool), []
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
        seen.append(new.copy())
    return order, seen


def sorted_suffixes(codes: np.ndarray, length: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first ``length`` codes. Codes are 0 to 255; past the end they are 0."""
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(2 * length + 4 * _WORD, dtype=np.uint8)])
    room = n + 2 * length
    # eight codes as one letter, at every place
    word = np.zeros(room, dtype=np.uint64)
    for j in range(_WORD):
        word = word << np.uint64(8) | padded[j : j + room]
    sample = np.flatnonzero(np.arange(n) % 3)
    if not len(sample):
        return np.arange(n)

    def named(keys: list[np.ndarray]) -> np.ndarray:
        order, seen = _dense(keys)
        names = np.zeros(room, dtype=np.int64)
        names[sample[order]] = np.cumsum(seen[-1])
        return names

    # names of sampled suffixes by triples of letters, then by triples of names; places a span apart are both sampled
    span, levels = 3 * _WORD, []
    if length > span:
        levels.append((span, named([word[sample], word[sample + _WORD], word[sample + 2 * _WORD]])))
        while 3 * span < length - 1:
            name = levels[-1][1]
            levels.append((3 * span, named([name[sample], name[sample + span], name[sample + 2 * span]])))
            span *= 3
    keys, at = [], 0
    for size, name in reversed(levels):
        while length - at >= size + 2:
            keys.append(name[sample + at])
            at += size
    while length - at > 7:
        keys.append(word[sample + at] >> np.uint64(16))
        at += 6
    tail = word[sample + at] >> np.uint64(8 * (_WORD - (length - at)))
    # prefixes that are two, one and no codes shorter have names in one and the same order
    order, seen = _dense([*keys, tail >> np.uint64(16), tail >> np.uint64(8), tail])
    in_order = sample[order]
    shorter = []
    for new in seen[-3:-1]:
        names = np.zeros(room, dtype=np.int64)
        names[in_order] = np.cumsum(new)
        shorter.append(names)
    less_two, less_one = shorter
    code = padded.astype(np.int64)
    after_one = lambda i: code[i] << 40 | less_one[i + 1]
    after_two = lambda i: code[i] << 48 | code[i + 1] << 40 | less_two[i + 2]
    # the remaining suffixes among themselves, then merged with either kind of sampled ones
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(after_one(rest), kind="stable")]
    first, second = in_order[in_order % 3 == 1], in_order[in_order % 3 == 2]
    before = np.searchsorted(after_one(first), after_one(rest)) + np.searchsorted(after_two(second), after_two(rest))
    out = np.empty(n, dtype=np.int64)
    mine = before + np.arange(len(rest))
    others = np.ones(n, dtype=bool)
    others[mine] = False
    out[mine], out[others] = rest, in_order
    return out


def equal_neighbours(codes: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in order, whether its first ``length`` codes equal those of the one before."""
    padded = np.concatenate([codes, np.zeros(length + _WORD, dtype=np.uint8)])
    word = np.zeros(len(codes) + length, dtype=np.uint64)
    for j in range(_WORD):
        word = word << np.uint64(8) | padded[j : j + len(word)]
    same = np.arange(1, len(order))
    for at in [*range(0, length - _WORD, _WORD), length - _WORD]:
        same = same[word[order[same] + at] == word[order[same - 1] + at]]
    out = np.zeros(len(order), dtype=bool)
    out[same] = True
    return out


def later_strings(contents: list[bytes], doc: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, low, count) runs of strings that stand at a smaller (doc, place) too.

    Content i is the text of the strings that start at low[i] and after in document doc[i].
    """
    # codes from 1 on (UTF-8 has no byte 255), and a 0 after each content
    codes = np.frombuffer(b"\xff".join([*contents, b""]), dtype=np.uint8) + np.uint8(1)
    sizes = np.array([len(c) + 1 for c in contents])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = sorted_suffixes(codes, length)
    same = equal_neighbours(codes, order, length)
    group = np.cumsum(~same)
    some = same.copy()
    some[:-1] |= same[1:]
    place, group = order[some], group[some]
    content = np.searchsorted(starts, place, "right") - 1
    # strings that reach past their content hold a 0 and equal nothing in another text
    fits = place - starts[content] + length < sizes[content]
    place, group, content = place[fits], group[fits], content[fits]
    where, at = doc[content], low[content] + place - starts[content]
    by = np.lexsort((at, where, group))
    where, at, group = where[by], at[by], group[by]
    head = np.ones(len(group), dtype=bool)
    head[1:] = group[1:] != group[:-1]
    first = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    later = (where != where[first]) | (at != at[first])
    where, at = where[later], at[later]
    by = np.lexsort((at, where))
    where, at = where[by], at[by]
    new = np.ones(len(where), dtype=bool)
    new[1:] = (where[1:] != where[:-1]) | (at[1:] > at[:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(where)) - 1
    return where[head], at[head], at[last] - at[head] + 1 if len(head) else at[head]


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes = BYTE_CODES[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def contents(docs: DataFrame, open_units: DataFrame) -> DataFrame:
    """(slot, doc_id, version, low, content) of each open unit."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = texts_of(batch.column("text"))
        row, spans = span_arrays(batch.column("spans"))
        found = [texts[r][a : a + c + LENGTH - 1] for r, a, c in zip(row.tolist(), spans["low"].tolist(), spans["count"].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(spans["slot"], pa.int64()), *(batch.column(name).take(pa.array(row)) for name in ("doc_id", "version")),
             pa.array(spans["low"], pa.int32()), pa.array(found, pa.binary())], names=["slot", "doc_id", "version", "low", "content"])

    return arrow_map(with_spans(docs, open_units, "inner", "slot"), work, "slot long, doc_id long, version long, low int, content binary")


def _in_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole slots, some LOT_BYTES of text at a time; rows come sorted by slot."""
    held: list[tuple[int, int, int, int, bytes]] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if size > LOT_BYTES and row[0] != held[-1][0]:
                yield _later(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield _later(held)


def _later(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    _, doc, version, low, texts = zip(*rows)
    # documents by number, in the order of doc_id and version
    both, number = np.unique(np.array([doc, version]), axis=1, return_inverse=True)
    found = later_strings(list(texts), number.ravel(), np.array(low, dtype=np.int64), LENGTH)
    at = np.asarray(found[0], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(both[0][at], pa.int64()), pa.array(both[1][at], pa.int64()), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int32())],
        names=["doc_id", "version", "low", "count"])


def one_by_one(found: DataFrame) -> DataFrame:
    """The same runs for slots with more text than a lot: every string by itself, counted before the shuffle."""
    places = F.sequence(F.lit(0), F.length("content") - LENGTH)
    strings = found.select("doc_id", "version", "low", "content", F.explode(places).alias("i")).select(
        "doc_id", "version", (F.col("low") + F.col("i")).cast("int").alias("low"), F.expr(f"substring(content, i + 1, {LENGTH})").alias("string"))
    first = strings.groupBy("string").agg(F.min(F.struct("doc_id", "version", "low")).alias("first"))
    later = strings.join(first, "string").where(F.struct("doc_id", "version", "low") > F.col("first"))
    return later.select("doc_id", "version", "low", F.lit(1).alias("count"))


def repeated_spans(docs: DataFrame, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """(doc_id, version, low, count): runs of strings that stand earlier too."""
    units = marked_units(docs, _coded, LENGTH, ANCHOR)
    covered, open_units = units.where("covered").select("doc_id", "version", "low", "count"), units.where("NOT covered")
    texts = F.sum(F.col("count") + LENGTH - 1)
    wide = stage(open_units.groupBy("slot").agg(texts.alias("size")).where(F.col("size") > 4 * lot_bytes).select("slot"), "wide")
    found = contents(docs, open_units.join(wide, "slot", "left_anti"))
    dealt = found.repartition("slot").sortWithinPartitions("slot")
    spans = covered.unionByName(dealt.mapInArrow(_in_lots, "doc_id long, version long, low int, count int"))
    if not wide.isEmpty():
        spans = spans.unionByName(one_by_one(contents(docs, open_units.join(wide, "slot", "left_semi"))))
    return stage(spans, "spans")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that stay."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, found = span_arrays(batch.column("spans"))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
        texts = texts_of(batch.column("text"))
        n_bytes, n_spans, kept = [len(t) for t in texts], [], []
        for i, text in enumerate(texts):
            part = slice(ends[i], ends[i + 1])
            if ends[i] == ends[i + 1]:
                n_spans.append(0)
                kept.append(text)
                continue
            gone = removed_elements(len(text), found["low"][part], found["count"][part], LENGTH)
            n_spans.append(int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum()))
            kept.append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
        removed = [n - len(k) for n, k in zip(n_bytes, kept)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_bytes, removed, n_spans)), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return arrow_map(with_spans(docs, spans, "left"), work,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def suffix_dedup(docs: DataFrame, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept bytes for each row.

    Texts are UTF-8 bytes, null texts empty. Every byte is removed that a
    string of 100 bytes covers which also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one. Strings are judged on the
    input. Rows that repeat in full are one document; of rows that share a
    doc_id and differ in text, each is a document of its own, ordered by a hash
    of the text. Rows without doc_id lose nothing and are no one's source.
    Other columns are not read.
    """
    return cut(docs, repeated_spans(docs, lot_bytes))


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
