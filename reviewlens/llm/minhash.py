"""MinHash near-duplicates: universal hash minima, banding, verification, components.

Candidates share a band of their signatures. Documents are first compared with
a hub, the smallest member of one of their buckets; members of a bucket that
are still in different components are then compared with each other in blocks.
A candidate must pass the signature estimate, then the exact shingle sets of
both texts. Equal word sequences are one node, so copies never fill a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.anchors import mixed
from reviewlens.llm.common import arrow_map, of_ids, stage, texts_of, thinned
from reviewlens.llm.components import components
from reviewlens.llm.words import shingle_sets, words_of

SHINGLE_WORDS = 5
#: Similarity in hundredths.
THRESHOLD = 75
#: 32 bands of 4 minima: a pair at similarity 0.75 shares no band with probability (1 - 0.75^4)^32, about 5e-6.
BANDS, BAND_ROWS = 32, 4
#: Hundredths by which the agreement of two signatures may lie under the threshold: over 5 standard deviations.
MARGIN = 20
#: Rounds in which each document is compared with one hub, and members of a bucket whose texts meet in one block after that.
HUB_ROUNDS, BLOCK = 1, 1024
#: Such blocks in one chunk of a bucket, whose signatures meet; they are far smaller than texts.
CHUNK_BLOCKS = 8
#: Members of a bucket up to which its pairs are rows; a pair that meets in many buckets is one row then.
FEW = 4
#: Tasks that compare blocks, to one shuffle partition.
TASKS_TO_A_PARTITION = 4
#: Words of text in one block; a longer text is a block of its own.
BLOCK_WORDS = 1_000_000

_MINIMA = BANDS * BAND_ROWS
_FACTORS = mixed(np.arange(1, _MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mixed(np.arange(_MINIMA + 1, 2 * _MINIMA + 1, dtype=np.uint64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Row per set: of the minimum of each universal hash ``(a * x + b mod 2^64) >> 32`` the last 16 bits. No set may be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), _MINIMA), dtype=np.uint16)
    for i in range(_MINIMA):
        least = np.minimum.reduceat((flat * _FACTORS[i] + _OFFSETS[i]) >> np.uint64(32), starts)
        out[:, i] = least & np.uint64(0xFFFF)
    return out


def _signed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = words_of(texts_of(batch.column("text")), lower=True)
    sets = shingle_sets(words, SHINGLE_WORDS)
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    signs = [None] * len(sets)
    if len(full):
        for i, row in zip(full.tolist(), signatures([sets[i] for i in full.tolist()])):
            signs[i] = row.tobytes()
    sequence = words.sequence_digests()
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sequence[:, 0]),
         pa.array(sequence[:, 1]), pa.array(np.diff(words.bounds), pa.int64()), pa.array(signs, pa.binary())],
        names=["doc_id", "n_shingles", "s1", "s2", "n_words", "signature"])


def signed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, word-sequence digest (s1, s2), n_words and signature of each document."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(plain, _signed, "doc_id long, n_shingles long, s1 long, s2 long, n_words long, signature binary")


def _agreeing(a: pa.Array, b: pa.Array) -> np.ndarray:
    left = np.frombuffer(b"".join(a.to_pylist()), dtype=np.uint16).reshape(-1, _MINIMA)
    right = np.frombuffer(b"".join(b.to_pylist()), dtype=np.uint16).reshape(-1, _MINIMA)
    return (left == right).sum(axis=1)


def by_estimate(pairs: DataFrame, signs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (u, v) whose signatures agree in all but MARGIN hundredths of what the threshold asks."""

    def near(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = _agreeing(batch.column("a"), batch.column("b")) * 100 >= (threshold - MARGIN) * _MINIMA
        yield batch.filter(pa.array(keep)).select(["u", "v"])

    side = lambda node, name: signs.select(F.col("doc_id").alias(node), F.col("signature").alias(name))
    return arrow_map(pairs.join(side("u", "a"), "u").join(side("v", "b"), "v"), near, "u long, v long")


def similar(left: list[bytes], right: list[bytes], threshold: int = THRESHOLD) -> np.ndarray:
    """Whether 100 * intersection >= threshold * union holds for the shingle sets of each pair of texts."""
    a = shingle_sets(words_of(left, lower=True), SHINGLE_WORDS)
    b = shingle_sets(words_of(right, lower=True), SHINGLE_WORDS)
    return np.array([_similar(x, y, threshold) for x, y in zip(a, b)], dtype=bool)


def _similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= threshold * (len(a) + len(b) - common)


def verified(pairs: DataFrame, docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (u, v) whose whole texts are similar."""

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = similar(texts_of(batch.column("a")), texts_of(batch.column("b")), threshold)
        yield batch.filter(pa.array(keep)).select(["u", "v"])

    pairs = stage(pairs, "pairs")
    texts = texts_for(docs, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")))
    side = lambda node, name: texts.select(F.col("doc_id").alias(node), F.col("text").alias(name))
    # pairs grow with the documents and are never broadcast, so the plan is the same for any number of them
    return arrow_map(pairs.hint("merge").join(side("v", "b"), "v").join(side("u", "a"), "u"), check, "u long, v long")


def texts_for(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in ``ids``, one row each, as a staged table."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = thinned(plain, "doc_id", ids).join(ids.distinct().hint("merge"), "doc_id", "left_semi")
    return stage(found.groupBy("doc_id").agg(F.max("text").alias("text")), "texts")


def _blocks(chunk: np.ndarray, n_words: np.ndarray, block: int) -> np.ndarray:
    """Number of the block of each row: up to ``block`` rows and about BLOCK_WORDS words of one chunk."""
    out = np.zeros(len(chunk), dtype=np.int64)
    for part in np.unique(chunk):
        of = np.flatnonzero(chunk == part)
        before = np.cumsum(n_words[of]) - n_words[of]
        out[of] = out.max() + 1 + np.maximum(np.arange(len(of)) // block, before // BLOCK_WORDS)
    return np.unique(out, return_inverse=True)[1]


def _block_members(rows: pd.DataFrame, threshold: int, block: int) -> pd.DataFrame:
    """The rows of one pair of chunks whose signature agrees well enough with one of another component, by pairs of blocks.

    A pair is looked at in the bucket of the first band its signatures share.
    """
    rows = rows.sort_values(["chunk", "doc_id"])
    chunk = rows["chunk"].to_numpy()
    band, here = int(rows["band"].iloc[0]), chunk == rows["low"].iloc[0]
    part = _blocks(chunk, rows["n_words"].to_numpy(), block)
    component, size = rows["component"].to_numpy(), rows["n_shingles"].to_numpy()
    signs = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint16).reshape(-1, _MINIMA)
    wanted = np.zeros((len(rows), part.max() + 1), dtype=bool)
    for i in np.flatnonzero(here).tolist():
        # within one chunk each pair once, across two chunks every pair
        rest = np.arange(i + 1, len(rows)) if here.all() else np.flatnonzero(~here)
        fits = 100 * np.minimum(size[rest], size[i]) >= threshold * np.maximum(size[rest], size[i])
        rest = rest[(component[rest] != component[i]) & fits]
        same = signs[rest] == signs[i]
        rest = rest[same.sum(axis=1) * 100 >= (threshold - MARGIN) * _MINIMA]
        first = (signs[rest] == signs[i]).reshape(len(rest), BANDS, BAND_ROWS).all(axis=2).argmax(axis=1)
        rest = rest[first == band]
        wanted[i, part[rest]] = True
        wanted[rest, part[i]] = True
    at, other = np.nonzero(wanted)
    found = rows[["key", "low", "high", "doc_id"]].iloc[at]
    return found.assign(block_low=np.minimum(part[at], other), block_high=np.maximum(part[at], other))[_MEMBER]


_MEMBER = ["key", "low", "high", "block_low", "block_high", "doc_id"]


def _common(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 matrices over the shingles that two sets or more hold."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [start, start + width]))
        holds = np.zeros((len(sets), width), dtype=np.float32)
        holds[row[part], column[part] - start] = 1
        common += holds @ holds.T
    return common.astype(np.int64)


def _block_links(rows: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Links enough to join the similar texts of one pair of blocks."""
    rows = rows.sort_values("doc_id")
    ids = rows["doc_id"].to_numpy()
    sets = shingle_sets(words_of([(t or "").encode() for t in rows["text"]], lower=True), SHINGLE_WORDS)
    common, size = _common(sets), np.array([len(s) for s in sets])
    linked = (common > 0) & (100 * common >= threshold * (size[:, None] + size[None, :] - common))
    # the smallest row that each row reaches
    least = np.arange(len(ids))
    while True:
        moved = np.minimum(least, np.where(linked, least[None, :], len(ids)).min(axis=1))
        if (moved == least).all():
            break
        least = moved
    away = least != np.arange(len(ids))
    return pd.DataFrame({"u": ids[least[away]], "v": ids[away]}, dtype="int64")


def _owned(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket rows with the component of their document."""
    return buckets.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))


def hub_pairs(owned: DataFrame) -> DataFrame:
    """(u, v): each document with the smallest hub, of its buckets, that lies in another component."""
    hubs = owned.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.min("doc_id").alias("u"),
        F.min(F.struct("doc_id", "component"))["component"].alias("other")).where("least != most")
    rows, hubs = owned.alias("r"), hubs.select("key", "u", "other").alias("h")
    apart = rows.join(hubs, (F.col("r.key") == F.col("h.key")) & (F.col("r.component") != F.col("h.other")))
    return apart.groupBy(F.col("r.doc_id").alias("v")).agg(F.min("h.u").alias("u")).select("u", "v")


def chunk_rows(rest: DataFrame, size: int) -> DataFrame:
    """The rows of open buckets, each in every pair of chunks (low, high) it is compared in.

    A bucket of up to ``size`` members is one chunk. In a larger one a component
    of that many members has chunks of its own, which never meet each other, and
    the members of all smaller components share the others. So beside one large
    component rows grow with its members; only members that lie in many
    components still cost each of them a row for every ``size`` others.
    """
    columns = ["key", "band", "doc_id", "component"]
    one = rest.where(F.col("n") <= size).select(*columns, *[F.lit(0).alias(x) for x in ("chunk", "low", "high")])
    large = rest.where(F.col("n") > size).select(*columns)
    sizes = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"))
    sizes = sizes.withColumn("owner", F.when(F.col("members") >= size, F.col("component").cast("string")).otherwise(""))
    parts = sizes.groupBy("key", "owner").agg(F.ceil(F.sum("members") / size).cast("int").alias("parts"))
    chunks = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", "owner", "part", F.row_number().over(Window.partitionBy("key").orderBy("owner", "part")).alias("chunk"))
    a, b = chunks.alias("a"), chunks.alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.chunk") <= F.col("b.chunk")) & ((F.col("a.owner") != F.col("b.owner")) | (F.col("a.owner") == ""))
    met = a.join(b, meet).select(
        F.col("a.key").alias("key"), F.col("a.chunk").alias("low"), F.col("b.chunk").alias("high"),
        F.explode(F.array_distinct(F.array(*[F.struct(f"{x}.owner", f"{x}.part", f"{x}.chunk") for x in "ab"]))).alias("of"))
    met = met.select("key", "of.*", "low", "high")
    owned = large.join(sizes.join(parts, ["key", "owner"]).drop("members"), ["key", "component"])
    placed = owned.withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")).join(met, ["key", "owner", "part"])
    return one.unionByName(placed.select(one.columns))


def remaining_links(owned: DataFrame, signs: DataFrame, docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links in the buckets whose members still lie in two components or more.

    Most such buckets have FEW members or less: their pairs, no more than three for
    every two members, are compared once each. The members of a larger one are cut
    into chunks of bounded size, and every two chunks that differ in components meet
    in a task with their signatures, which leaves the members that have a partner;
    those meet with their texts, block by block. Tasks give members and links, never
    pairs, so a group of documents that are a little too different costs
    comparisons but no rows.
    """
    is_open = owned.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("n")).where("a != b")
    rest = stage(owned.join(is_open.select("key", "n"), "key").select("key", "n", "band", "doc_id", "component"), "open")
    few = rest.where(F.col("n") <= FEW)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.component") != F.col("b.component"))).select(
        F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v")).distinct()
    of_few = verified(by_estimate(stage(pairs, "pairs"), signs, threshold), docs, threshold)
    # a pair whose first band is a bucket of few members has been looked at there
    block = BLOCK
    rows = chunk_rows(rest.where(F.col("n") > FEW), block * CHUNK_BLOCKS)
    sign = signs.select("doc_id", "n_shingles", "n_words", "signature")
    # comparisons cost time and few bytes, so they are dealt to more tasks than their size asks for
    tasks = TASKS_TO_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = rows.join(sign, "doc_id").repartition(tasks, "key", "low", "high").groupBy("key", "low", "high").applyInPandas(
        lambda rows: _block_members(rows, threshold, block),
        "key long, low int, high int, block_low int, block_high int, doc_id long")
    members = stage(near, "members")
    full = members.join(texts_for(docs, members.select("doc_id")), "doc_id")
    of_blocks = full.groupBy(*[x for x in _MEMBER if x != "doc_id"]).applyInPandas(
        lambda rows: _block_links(rows, threshold), "u long, v long")
    return of_few.unionByName(of_blocks).distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document.

    Two documents are linked if the sets of their distinct 5-word shingles
    (words lower-cased in A-Z; a shorter text is one shingle) have similarity
    ``threshold`` hundredths or more. component_id is the smallest doc_id that
    links reach; kept marks that document. Texts that are null, empty or
    without words have no shingle and are linked with nothing. doc_id is the
    key: rows that repeat it get the component of that id, rows without it get
    no component and are kept. Other columns of the input are not read.
    """
    signed = stage(signed_documents(docs), "signed")
    nodes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = nodes.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    # one signature for each word sequence
    signs = stage(
        nodes.select("doc_id", "n_shingles", "n_words", "signature").join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"]), "signs")
    keys = [F.xxhash64(F.lit(i), F.substring("signature", 1 + 2 * BAND_ROWS * i, 2 * BAND_ROWS)) for i in range(BANDS)]
    every = signs.select("doc_id", F.posexplode(F.array(*keys)).alias("band", "key"))
    # almost all buckets hold one document, which they can link with nothing
    shared = stage(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared")
    buckets = stage(thinned(every, "key", shared).join(shared, "key", "left_semi"), "buckets")
    found = signs.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component")).limit(0)
    links = None
    # one comparison per document joins almost all of a group, whatever its size
    for _ in range(HUB_ROUNDS):
        near = verified(by_estimate(stage(hub_pairs(_owned(buckets, found)), "pairs"), signs, threshold), docs, threshold)
        links = stage(near if links is None else links.unionByName(near), "links")
        found = components(links)
    more = stage(remaining_links(_owned(buckets, found), signs, docs, threshold), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    classes = classes.join(found, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    out = signed.join(classes, ["s1", "s2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group of near-duplicates stays, with all its columns.

    Documents without words and rows without doc_id stay; doc_id is the key, so
    rows that repeat it stay or go together.
    """
    return of_ids(docs, "doc_id", near_duplicates(docs, threshold).where("kept").select("doc_id"), "left_semi")
