"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid end to end and indexed by a suffix
array. Every piece of the vocabulary is looked up by binary search; the ranges
found are the piece's occurrences, edges from its first to its last place.
Edges are sorted by place and relaxed from left to right: an edge extends the
best known path if its piece can follow the path's last piece, that is if the
merge rule keeps the two apart. Exactly one path reaches each place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_WORDS = re.compile("▁+[^▁]*")
#: Bytes that the words a worker remembers from batch to batch may take, and the longest of them, in characters.
REMEMBERED_BYTES, REMEMBERED_CHARS = 64_000_000, 64
#: Arrow bytes of text encoded at once: looking up all pieces costs the same for any number of words.
BATCH_BYTES = 4_000_000


class Vocabulary:
    """Pieces and scores of a BPE model with byte fallback; small enough to travel with every task."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces, self.kinds = pieces, kinds
        self.score = {p: s for p, s, k in zip(pieces, scores, kinds) if k == "piece"}
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "piece"}
        self.byte_ids = [i for i, k in enumerate(kinds) if k == "byte"]
        self.longest = max(map(len, self.ids), default=1)
        self.known: dict[str, bytes] = {}
        self.size = 0
        self._merges()
        self.alphabet = {c for p in self.usable for c in p}
        self.codes: dict[str, int] = {}
        self.coded: tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(model.get_piece_size())
        kind = lambda i: "byte" if model.is_byte(i) else "special" if model.is_control(i) or model.is_unknown(i) else "piece"
        return cls([model.id_to_piece(i) for i in n], [model.get_score(i) for i in n], [kind(i) for i in n])

    def __reduce__(self):
        scores = [self.score.get(p, 0.0) for p in self.pieces]
        return _vocabulary, (self.pieces, scores, self.kinds)

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Pieces of a short text by the merge rule (best score first, leftmost of equal ones), and the last merge."""
        parts, last = list(text), None
        while len(parts) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            i = scores.index(best)
            last = parts[i], parts[i + 1]
            parts[i : i + 2] = ["".join(last)]
        return parts, last

    def _merges(self) -> None:
        """Tables of the merge rule: when each piece is merged, from what, and what any two pieces merge to."""
        size = len(self.pieces)
        # early merges have small ranks; a single sign is never merged
        ranks = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        pairs: dict[int, int] = {}
        self.usable = []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = ranks[self.score[piece]]
            parts, last = self.merged(piece)
            if parts != [piece]:
                continue  # a piece that its own merges never form has no edge
            self.usable.append(piece)
            if last:
                self.rank[i] = ranks[self.score[piece]]
                self.left[i], self.right[i] = self.ids[last[0]], self.ids[last[1]]
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    def can_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merge rule leaves pieces a and b as they are when they stand side by side.

        Merges inside a and b are undone from the last to the first. While the
        two inner ends stand side by side, a merge across them must not have
        come before the merge that was undone last.
        """
        good = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(todo) and len(self.pair_keys):
            key = a * len(self.pieces) + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossed = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit)
            good[todo[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~crossed & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            # of equal ranks the left merge comes first: a's own merge wins against the crossing one, b's does not
            limit = np.where(undo_a, ra, rb + 1)[on]
            a, b = np.where(undo_a, self.right[a], a)[on], np.where(undo_a, b, self.left[b])[on]
            todo = todo[on]
        return good


    def search_keys(self, characters: list[str], width: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bits of a code, then for all pieces of characters met so far the least and greatest key of a suffix that begins with
        the piece, the pieces' lengths and ids. Built anew only when a character of some piece is met for the first time."""
        fresh = [c for c in characters if c in self.alphabet and c not in self.codes]
        self.codes.update((c, i) for i, c in enumerate(fresh, len(self.codes) + 1))
        if fresh or self.coded is None:
            # the last code stands for all characters that no piece holds
            bits = 8 if len(self.codes) < 254 else 16 if len(self.codes) < 65_534 else 32
            n_keys = -(-width // (64 // bits))
            pieces = [p for p in self.usable if self.codes.keys() >= set(p)]
            low = [b"".join([self.codes[c].to_bytes(bits // 8, "big") for c in p]) for p in pieces]
            kind = f"S{8 * n_keys}"
            self.coded = (bits, np.array(low, dtype=kind), np.array([x.ljust(8 * n_keys, b"\xff") for x in low], dtype=kind),
                          np.array([len(p) for p in pieces], dtype=np.int64), np.array([self.ids[p] for p in pieces], dtype=np.int64))
        return self.coded


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(pieces: list[str], scores: list[float], kinds: list[str]) -> Vocabulary:
    """One vocabulary per worker process, so that what it remembers serves all its tasks."""
    key = hash((tuple(pieces), tuple(scores)))
    if key not in _loaded:
        _loaded[key] = Vocabulary(pieces, scores, kinds)
    return _loaded[key]


def suffix_keys(codes: np.ndarray, longest: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``longest`` codes: the places, and the sorted prefixes as byte strings."""
    per = 64 // bits
    n_keys = -(-longest // per)
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(n_keys * per, dtype=np.uint64)])
    keys = []
    for k in range(n_keys):
        key = np.zeros(len(codes), dtype=np.uint64)
        for j in range(per):
            at = k * per + j
            key = key << np.uint64(bits) | padded[at : at + len(codes)]
        keys.append(key)
    order = np.lexsort(keys[::-1])
    prefixes = np.stack([k[order] for k in keys], axis=1).astype(">u8")
    return order, np.ascontiguousarray(prefixes).view(f"S{8 * n_keys}").ravel()


def piece_edges(text: str, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of pieces in ``text`` as (place, length, piece id)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    used = np.zeros(int(points.max()) + 1, dtype=bool)
    used[points] = True
    alphabet = np.flatnonzero(used)
    characters = list(map(chr, alphabet.tolist()))
    bits, low, high, lengths, piece_ids = vocabulary.search_keys(characters, vocabulary.longest)
    code_of = np.zeros(len(used), dtype=np.uint64)
    code_of[alphabet] = [vocabulary.codes.get(c, (1 << bits) - 2) for c in characters]
    order, prefixes = suffix_keys(code_of[points], vocabulary.longest, bits)
    begin = np.searchsorted(prefixes, low, "left")
    count = np.searchsorted(prefixes, high, "right") - begin
    found = np.flatnonzero(count)
    begin, count = begin[found], count[found]
    rows = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
    return order[rows], np.repeat(lengths[found], count), np.repeat(piece_ids[found], count)


def encode_words(words: list[str], vocabulary: Vocabulary) -> dict[str, bytes]:
    """Ids (32-bit, little-endian) of each distinct word."""
    if not words:
        return {}
    # the sign between words belongs to no piece, so no edge runs from one word into the next
    text = "\n".join([*(w.replace("\n", "\0") for w in words), ""])
    size = np.array([len(w) for w in words])
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    place, length, ids = piece_edges(text, vocabulary)
    start_of = np.repeat(start, size + 1)
    within = place - start_of[place]
    by_place = np.argsort(within.astype(np.uint16) if size.max() < 65_536 else within, kind="stable")
    place, length, ids, within = place[by_place], length[by_place], ids[by_place], within[by_place]
    # last piece of the one valid path to each place: NONE before one is found, ALONE for a sign outside the vocabulary
    none, alone = -2, -1
    last = np.full(len(text) + 1, none, dtype=np.int64)
    back = np.zeros(len(text) + 1, dtype=np.int64)
    last[start] = alone
    lone = np.ones(len(text), dtype=bool)
    lone[place[length == 1]] = False
    lone[start + size] = False
    lone = np.flatnonzero(lone)
    lone_within = lone - start_of[lone]
    lone = lone[np.argsort(lone_within, kind="stable")]
    lone_within = np.sort(lone_within)
    steps = np.arange(size.max() + 1)
    edge_at, lone_at = np.searchsorted(within, steps), np.searchsorted(lone_within, steps)
    for i in range(size.max()):
        e = slice(edge_at[i], edge_at[i + 1])
        p = place[e]
        left = last[p]
        open_ = np.flatnonzero((left != none) & (last[p + length[e]] == none))
        if len(open_):
            p, left, right, end = p[open_], left[open_], ids[e][open_], (p + length[e])[open_]
            fits = vocabulary.can_follow(np.maximum(left, 0), right) | (left == alone)
            last[end[fits]], back[end[fits]] = right[fits], p[fits]
        p = lone[lone_at[i] : lone_at[i + 1]]
        p = p[last[p] != none]
        last[p + 1], back[p + 1] = alone, p
    # walk all words back at once; each round yields one piece of every word that is not finished
    at, owner, rounds = start + size, np.arange(len(words)), []
    while len(at):
        on = at > start[owner]
        at, owner = at[on], owner[on]
        rounds.append((owner, last[at], at))
        at = back[at]
    owner, found, end = (np.concatenate(x) for x in zip(*rounds))
    order = np.argsort(owner * (len(text) + 1) + end, kind="stable")
    owner, found, end = owner[order], found[order], end[order]
    bounds = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
    flat = found.astype("<i4").tobytes()
    out = {w: flat[a:b] for w, a, b in zip(words, bounds, bounds[1:])}
    for w in np.unique(owner[found == alone]).tolist():
        mine = slice(bounds[w] // 4, bounds[w + 1] // 4)
        path = []
        for piece, stop in zip(found[mine].tolist(), (end[mine] - start[w]).tolist()):
            if piece == alone:
                path += [vocabulary.byte_ids[b] for b in words[w][stop - 1].encode("utf-8", "surrogatepass")]
            else:
                path.append(piece)
        out[words[w]] = np.array(path, dtype="<i4").tobytes()
    return out


def encode_texts(texts: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of each whole text. Pieces never run on from one word into the next space, so words are coded on their own."""
    split = [_WORDS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    known = vocabulary.known
    if vocabulary.size > REMEMBERED_BYTES:
        known.clear()
        vocabulary.size = 0
    now = encode_words(list({w for words in split for w in words if w not in known}), vocabulary)
    known |= now
    out = [b"".join(map(known.__getitem__, words)) for words in split]
    for word, ids in now.items():
        if len(word) > REMEMBERED_CHARS:
            del known[word]
        else:
            vocabulary.size += len(word) + len(ids) + 200
    return out


def encode(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """All columns of ``docs`` and ``token_ids``; the whole text is encoded.

    A null or empty text has no ids. A column of the input that is called
    token_ids is replaced. The vocabulary is read on the driver and travels
    with the tasks, so executors need no file of it.
    """
    vocabulary = Vocabulary.load(path)
    docs = docs.drop("token_ids")
    kind = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BATCH_BYTES):
                ids = encode_texts([t or "" for t in part.column("text").to_pylist()], vocabulary)
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                column = pa.ListArray.from_arrays(pa.array(ends), flat).cast(kind)
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, "token_ids"])

    schema = docs.select("*", F.array(F.lit(0)).alias("token_ids")).schema
    return docs.mapInArrow(run, schema)


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "surrogatepass" if ids else "strict")
    return text[1:] if text[:1] == " " else text


def decode(encoded: DataFrame, path: str = MODEL_PATH, column: str = "decoded") -> DataFrame:
    """All columns and ``column``, the text that ``token_ids`` stand for. Null ids give an empty text.

    The space sign U+2581 inside a text comes back as a space; every other text
    comes back as it was.
    """
    vocabulary = Vocabulary.load(path)
    table = [b"" if k == "special" else bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(SPACE, " ").encode()
             for p, k in zip(vocabulary.pieces, vocabulary.kinds)]
    encoded = encoded.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [decode_ids(x.values.to_numpy().tolist() if x.is_valid else [], table) for x in part.column("token_ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, column])

    return encoded.mapInArrow(run, encoded.select("*", F.lit("").alias(column)).schema)
