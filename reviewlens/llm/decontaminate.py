"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Windows of a benchmark item's size that can hold the item are cut from the
documents: an occurrence with few edits keeps some of the item's fixed 8-byte
segments near their places (pigeonhole rule) and most of its 4-byte grams, so
windows that hold too few of either are passed over without loss. The CGK
random walk maps windows and items to strings whose Hamming distance follows
the edit distance; sampled places of several walks are LSH keys. Windows and
items that share a key are aligned, and the exact edit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.anchors import mixed
from reviewlens.llm.common import arrow_map, of_ids, texts_of

#: An item occurs where at most this part of its bytes, rounded down, is edited.
MAX_EDITS = 0.1
#: Walks of the embedding, LSH samples of each walk, and places in a sample.
WALKS, SAMPLES, PLACES = 8, 8, 4
#: Bytes of items that are sent to all tasks at once; a larger benchmark is searched in lots of this size.
LOT_BYTES = 16_000_000
_SEGMENT, _GRAM = 8, 4
_TABLE_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[9:14] = 32


def folded(text: bytes) -> bytes:
    """A-Z in lower case, every white space a space; no byte changes its place."""
    return _FOLDED[np.frombuffer(text, dtype=np.uint8)].tobytes()


def edits_allowed(size):
    return (np.asarray(size) * MAX_EDITS).astype(np.int64)


@dataclass
class Items:
    """Benchmark items of one lot: ids, folded texts, and their segments sorted by value."""

    ids: list[int]
    texts: list[bytes]

    def __post_init__(self):
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        rows = [(t[o : o + _SEGMENT], i, o) for i, t in enumerate(self.texts) for o in range(0, len(t) - _SEGMENT + 1, _SEGMENT)]
        value = np.frombuffer(b"".join(r[0] for r in rows), dtype="<u8")
        order = np.argsort(value, kind="stable")
        self.value = value[order]
        self.item = np.array([r[1] for r in rows], dtype=np.int64)[order]
        self.offset = np.array([r[2] for r in rows], dtype=np.int64)[order]
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.value * _SPREAD) >> np.uint64(64 - _TABLE_BITS)] = True
        self.grams = [_grams(t) for t in self.texts]
        # segments that must survive the allowed edits
        self.least = np.maximum(1, self.sizes // _SEGMENT - edits_allowed(self.sizes))

    def __reduce__(self):
        return Items, (self.ids, self.texts)


def _grams(text: bytes) -> set[bytes]:
    return {text[i : i + _GRAM] for i in range(len(text) - _GRAM + 1)}


def segment_hits(buffer: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(item, place where the item would begin) for each segment of an item found in the buffer."""
    places = []
    raw = buffer.tobytes()
    for shift in range(_SEGMENT):
        count = (len(raw) - shift) // _SEGMENT
        if count > 0:
            value = np.frombuffer(raw, dtype="<u8", count=count, offset=shift)
            places.append(np.flatnonzero(items.table[(value * _SPREAD) >> np.uint64(64 - _TABLE_BITS)]) * _SEGMENT + shift)
    if not places or not len(items.value):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place = np.concatenate(places)
    windows = np.lib.stride_tricks.sliding_window_view(buffer, _SEGMENT)[place]
    value = np.ascontiguousarray(windows).view("<u8").ravel()
    low = np.searchsorted(items.value, value, "left")
    count = np.searchsorted(items.value, value, "right") - low
    rows = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
    return items.item[rows], np.repeat(place, count) - items.offset[rows]


def candidate_windows(buffer: np.ndarray, bounds: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """(text number, item, start in the buffer) of windows that hold enough segments of an item near their places."""
    item, begin = segment_hits(buffer, items)
    reach = len(buffer) + int(items.sizes.max(initial=0)) + 1
    key = item * (2 * reach) + begin + reach
    order = np.argsort(key)
    key, item, begin = key[order], item[order], begin[order]
    slack = edits_allowed(items.sizes)[item]
    near = np.searchsorted(key, key + slack, "right") - np.searchsorted(key, key - slack, "left")
    keep = near >= items.least[item]
    keep[1:] &= key[1:] != key[:-1]
    item, begin, slack = item[keep], begin[keep], slack[keep]
    # a window lies in one text, but for the edits allowed
    middle = np.clip(begin + items.sizes[item] // 2, 0, len(buffer) - 1)
    text = np.searchsorted(bounds, middle, "right") - 1
    fits = (begin >= bounds[text] - slack) & (begin + items.sizes[item] <= bounds[text + 1] - 1 + slack)
    return text[fits], item[fits], np.clip(begin[fits], bounds[text[fits]], None)


def walks(windows: list[bytes]) -> np.ndarray:
    """CGK embedding: for each window and walk a string three times as long, past the window's end filled with 0.

    At each step the walk writes the byte it stands on and moves on by a
    random bit of (walk, step, byte).
    """
    longest = max(map(len, windows))
    grid = np.zeros((len(windows), longest + 1), dtype=np.uint8)
    for i, w in enumerate(windows):
        grid[i, : len(w)] = np.frombuffer(w, dtype=np.uint8)
    steps = 3 * longest
    out = np.empty((steps, len(windows), WALKS), dtype=np.uint8)
    at = np.zeros((len(windows), WALKS), dtype=np.int64)
    row = np.arange(len(windows))[:, None]
    walk = np.arange(WALKS, dtype=np.uint64)[None, :] << np.uint64(40)
    for step in range(steps):
        byte = grid[row, np.minimum(at, longest)]
        out[step] = byte
        at += (mixed(walk | np.uint64(step << 8) | byte) >> np.uint64(63)).astype(np.int64)
    return out


def lsh_keys(windows: list[bytes]) -> np.ndarray:
    """Row per window of WALKS * SAMPLES keys: the size of the window and PLACES sampled places of a walk."""
    size = np.array([len(w) for w in windows])
    out = walks(windows)
    keys = np.empty((len(windows), WALKS * SAMPLES), dtype=np.uint64)
    row = np.arange(len(windows))
    for k in range(WALKS * SAMPLES):
        key = size.astype(np.uint64) << np.uint64(32) | np.uint64(k)
        for p in range(PLACES):
            draw = int(mixed(np.array([k * PLACES + p + 1], dtype=np.uint64))[0] >> np.uint64(11)) / (1 << 53)
            key = mixed(key ^ out[(draw * 3 * size).astype(np.int64), row, k % WALKS])
        keys[:, k] = key
    return keys


def best_alignment(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance between the item and any part of the text, and where that part ends (bit-parallel)."""
    size = len(item)
    where: dict[int, int] = {}
    for i, byte in enumerate(item):
        where[byte] = where.get(byte, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, now = full, 0, size
    best, end = size, 0
    for place, byte in enumerate(text):
        match = where.get(byte, 0)
        across = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | (~(across | plus) & full), plus & across
        if up & top:
            now += 1
        elif down & top:
            now -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (~((match | minus) | up) & full), up & (match | minus)
        if now < best:
            best, end = now, place + 1
    return best, end


def _lots(benchmark: DataFrame) -> Iterator[Items]:
    """Items in id order, in lots of at most LOT_BYTES; a longer item is a lot of its own."""
    plain = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("length(text) > 0 AND item_id IS NOT NULL")
    ids, texts, size = [], [], 0
    # one lot at a time is all the driver holds
    for row in plain.distinct().orderBy("item_id", "text").toLocalIterator():
        text = folded(row["text"].encode())
        if ids and size + len(text) > LOT_BYTES:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(text)
        size += len(text)
    if ids:
        yield Items(ids, texts)


def _search(docs: DataFrame, items: Items) -> DataFrame:
    spark = docs.sparkSession

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [folded(t) for t in texts_of(batch.column("text"))]
        # a byte that no UTF-8 text holds keeps texts apart
        buffer = np.frombuffer(b"\xff".join([*texts, b""]), dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        text, item, begin = candidate_windows(buffer, bounds, items)
        if not len(text):
            return
        size = items.sizes[item]
        slack, top = edits_allowed(size), bounds[text + 1] - 1
        raw = buffer.tobytes()
        windows, around, shift, first, seen = [], [], [], [], set()
        rows = zip(range(len(text)), item.tolist(), begin.tolist(), size.tolist(), slack.tolist(), bounds[text].tolist(), top.tolist())
        for i, number, at, n, edits, bottom, end in rows:
            # the same place and size is one window, whatever item led to it
            if (at, n) in seen:
                continue
            low, high = max(at - edits, bottom), min(at + n + edits, end)
            # an edit takes at most _GRAM of an item's grams away
            wanted = items.grams[number]
            if len(wanted & _grams(raw[low:high])) < len(wanted) - _GRAM * edits:
                continue
            seen.add((at, n))
            first.append(i)
            windows.append(raw[at : min(at + n, end)].ljust(n, b"\0"))
            around.append(raw[low:high])
            shift.append(low - bottom)
        first = np.array(first, dtype=np.int64)
        for a in range(0, len(windows), 1000):
            part = slice(a, a + 1000)
            keys = lsh_keys(windows[part]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(text[first[part]])), pa.array(size[first[part]]),
                 pa.array(shift[part], pa.int64()), pa.array(around[part], pa.binary()),
                 pa.array(list(keys), pa.list_(pa.int64()))], names=["doc_id", "size", "shift", "around", "keys"])

    windows = arrow_map(docs, cut, "doc_id long, size long, shift long, around binary, keys array<long>")
    keyed = windows.select("doc_id", "size", "shift", "around", F.explode("keys").alias("key"))
    rows = []
    for a in range(0, len(items.ids), 1000):
        for i, keys in enumerate(lsh_keys(items.texts[a : a + 1000]).view(np.int64).tolist(), start=a):
            rows += [(i, items.ids[i], key) for key in keys]
    wanted = spark.createDataFrame(rows, "item int, item_id long, key long")
    pairs = keyed.join(wanted, "key").groupBy("doc_id", "item", "item_id", "shift", "size").agg(F.first("around").alias("around"))

    def align(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for number, around in zip(batch.column("item").to_pylist(), batch.column("around").to_pylist()):
            item = items.texts[number]
            edits, end = best_alignment(item, around)
            # the part's start: the best alignment of the reversed strings from that end
            start = end - best_alignment(item[::-1], around[:end][::-1])[1] if edits <= len(item) * MAX_EDITS else 0
            found.append((edits, start, end))
        edits, start, end = (np.array(c, dtype=np.int64) for c in zip(*found))
        shift = batch.column("shift").to_numpy()
        good = edits <= edits_allowed(items.sizes[batch.column("item").to_numpy()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("item_id"), pa.array(edits), pa.array(shift + start), pa.array(shift + end)],
            names=["doc_id", "item_id", "edits", "start_byte", "end_byte"]).filter(pa.array(good))

    return arrow_map(pairs, align, "doc_id long, item_id long, edits long, start_byte long, end_byte long")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, edits, start_byte, end_byte, occurrences.

    An item occurs where at most a tenth of its bytes (rounded down) differ by
    insertions, deletions and changes; A-Z count as lower case and all white
    space as spaces. The best occurrence is reported, the first of equal ones.
    Null and empty texts and items give no rows; items that share an id count
    as versions of one item; rows that repeat doc_id count as one document, and
    rows without doc_id are reported under null. Items of under 8 bytes are
    too short for a segment and are not searched. Other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, edits long, start_byte long, end_byte long"
    found = docs.sparkSession.createDataFrame([], schema)
    for items in _lots(benchmark):
        found = found.unionByName(_search(plain, items))
    best = F.min(F.struct("edits", "start_byte", "end_byte"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b"), F.countDistinct("end_byte").alias("occurrences")).select(
        "doc_id", "item_id", "b.edits", "b.start_byte", "b.end_byte", "occurrences")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns.

    Null and empty texts hold none. doc_id is the key, null included: rows that
    repeat it stay or go together.
    """
    return of_ids(docs, "doc_id", contamination(docs, benchmark).select("doc_id"), "left_anti")
