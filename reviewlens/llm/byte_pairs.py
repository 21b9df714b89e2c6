"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Every byte stands for one printable character, so a vocabulary of byte strings
becomes one of plain strings, and decoding turns the table round. A batch's
texts are cut into words by the vocabulary's pattern; the library encodes each
distinct word once. Tokens carry places in the text, counted in characters.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices

RANKS_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes that a worker's memory of words and their ids may take, and the longest word in it, in characters.
REMEMBERED_BYTES, REMEMBERED_CHARS = 128_000_000, 64
#: Characters after which a long text is cut where the next run of white space begins with a space.
PIECE_CHARS = 1_000_000
#: A space that starts a run of white space: no word runs across that place.
_STARTS = re.compile(r"(?<![\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]) ")


def byte_table() -> list[str]:
    """The character of each byte: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


@functools.cache
def later_characters(name: str) -> frozenset[str]:
    """What the module ``regex``, which follows a later Unicode, takes for a letter or a number and the tokenizer libraries do not."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    theirs = {x for x, _ in pre_tokenizers.Split(Regex(name), "removed", invert=True).pre_tokenize_str(every)}
    return frozenset(set(regex.findall(name, every)) - theirs)


class Words:
    """Cuts a text into the matches of a pattern; ``later`` holds the later characters of each class in it."""

    def __init__(self, pattern: str, later: dict[str, frozenset[str]]):
        self.pattern, self.later = pattern, later
        self.plain = regex.compile(pattern).findall
        self.unknown = frozenset().union(*later.values())

    def __call__(self, text: str) -> list[str]:
        return self.plain(text) if self.unknown.isdisjoint(text) else self.exact(text)

    @functools.cached_property
    def exact(self):
        pattern = self.pattern
        for name, unknown in self.later.items():
            pattern = pattern.replace(name, f"[{name}--[{''.join(map(regex.escape, sorted(unknown)))}]]")
        return regex.compile(pattern, regex.V1).findall


@dataclass
class Ranks:
    """A vocabulary: the bytes of each id, in order of rank, and the pattern that cuts texts into words."""

    tokens: list[bytes]
    pattern: str
    later: dict[str, frozenset[str]]
    digest: str

    @staticmethod
    def load(path: str = RANKS_PATH, pattern: str = public_tokenizers.PATTERN) -> Ranks:
        with open(path, "rb") as file:
            content = file.read()
        by_id = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, content.splitlines())}
        if sorted(by_id) != list(range(len(by_id))):
            raise ValueError(f"{path}: ranks must run from 0 without a gap")
        later = {name: later_characters(name) for name in (r"\p{L}", r"\p{N}") if name in pattern}
        digest = hashlib.sha256(content + pattern.encode()).hexdigest()
        return Ranks([by_id[i] for i in range(len(by_id))], pattern, later, digest)

    def merges(self) -> list[tuple[str, str]]:
        """Every two tokens that make up a third, in order of its rank: the pair of lowest rank is joined first."""
        table, known = byte_table(), set(self.tokens)
        shown = lambda part: "".join(table[b] for b in part)
        return [(shown(token[:i]), shown(token[i:])) for token in self.tokens for i in range(1, len(token))
                if token[:i] in known and token[i:] in known]


class Coder:
    """Encodes texts in one worker process; words met before are remembered within a bound of bytes."""

    def __init__(self, ranks: Ranks):
        # tasks are what runs in parallel
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        table = byte_table()
        vocabulary = {"".join(table[b] for b in token): i for i, token in enumerate(ranks.tokens)}
        # a word that is a token needs no merging, and may not be reached by any
        self.library = Tokenizer(models.BPE(vocab=vocabulary, merges=ranks.merges(), ignore_merges=True, cache_capacity=0))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = Words(ranks.pattern, ranks.later)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        if self.size > REMEMBERED_BYTES:
            self.known.clear()
            self.size = 0
        cut = [[word for piece in _pieces(text) for word in self.words(piece)] for text in texts]
        new = list({word for words in cut for word in words if word not in self.known})
        now = {w: array("i", e.ids).tobytes() for w, e in zip(new, self.library.encode_batch_fast(new))}
        self.known |= now
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32) for words in cut]
        for word, ids in now.items():
            if len(word) > REMEMBERED_CHARS:
                del self.known[word]
            else:
                self.size += len(word) + len(ids) + 200
        return out


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts, the next one from the first space after PIECE_CHARS that starts a run of white space."""
    start = 0
    while len(text) - start > PIECE_CHARS and (cut := _STARTS.search(text, start + PIECE_CHARS)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


_coders: dict[str, Coder] = {}


def coder_of(ranks: Ranks) -> Coder:
    """The worker's coder for a vocabulary, built when it is first needed."""
    if ranks.digest not in _coders:
        _coders[ranks.digest] = Coder(ranks)
    return _coders[ranks.digest]


def token_places(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last of tokens that hold ``sizes`` bytes each.

    A token with part of a character has the whole character as its place.
    """
    begins = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    character = np.cumsum(begins, dtype=np.int32) - 1
    end = np.cumsum(sizes, dtype=np.int64)
    return character[end - sizes], character[end - 1] + 1


def _lists(arrays: list[np.ndarray], kind: str) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, kind), *arrays]).astype(kind)))


def encode(docs: DataFrame, path: str = RANKS_PATH, pattern: str = public_tokenizers.PATTERN, places: bool = True) -> DataFrame:
    """All columns of ``docs`` and ``token_ids``, ``token_starts``, ``token_ends`` of the whole text.

    Starts and ends are places in characters, the end one after the last;
    without ``places`` only the ids are added. Special tokens are ordinary
    text. A null or empty text has no ids. Every row is coded for itself, so
    repeated rows and ids do no harm. Columns of the input with the names of
    the new ones are replaced. The vocabulary is read on the driver and travels
    with the tasks.
    """
    ranks = Ranks.load(path, pattern)
    names = ["token_ids", "token_starts", "token_ends"][: 3 if places else 1]
    docs = docs.drop(*names)
    lengths = np.array([len(t) for t in ranks.tokens], dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = coder.ids(texts)
                columns = [_lists(ids, "int32")]
                if places:
                    found = [token_places(t.encode(), lengths[i]) for t, i in zip(texts, ids)]
                    columns += [_lists([f[side] for f in found], "int32") for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *names])

    schema = docs.select("*", *[F.array(F.lit(0)).alias(name) for name in names]).schema
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = RANKS_PATH, column: str = "decoded", as_bytes: bool = False) -> DataFrame:
    """All columns and ``column``, what ``token_ids`` stand for, as text or with ``as_bytes`` as it is.

    Bytes are joined before they are read as characters, so a character that is
    split between tokens comes back whole; bytes that make up no character, as
    in a part of an encoding, become U+FFFD in a text. Null ids, and null lists
    of them, stand for nothing; an id outside the vocabulary for U+FFFD.
    """
    tokens = Ranks.load(path).tokens
    unknown = "�".encode()
    encoded = encoded.drop(column)
    kind = pa.binary() if as_bytes else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = dict(enumerate(tokens))
        for batch in batches:
            for part in slices(batch):
                joined = [_joined(ids, table, unknown) for ids in part.column("token_ids")]
                out = joined if as_bytes else [x.decode("utf-8", "replace") for x in joined]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, kind)], names=[*part.schema.names, column])

    empty = F.lit("").cast("binary") if as_bytes else F.lit("")
    return encoded.mapInArrow(run, encoded.select("*", empty.alias(column)).schema)


def _joined(ids: pa.ListScalar, table: dict[int, bytes], unknown: bytes) -> bytes:
    if not ids.is_valid:
        return b""
    known = ids.values.drop_null().to_numpy(zero_copy_only=False).tolist()
    try:
        return b"".join(map(table.__getitem__, known))
    except KeyError:
        return b"".join([table.get(i, unknown) for i in known])
