"""Byte-level BPE against the library that defines it."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reviewlens.llm import byte_pairs, queries
from reviewlens.llm.common import table


@pytest.fixture(scope="module")
def ranks():
    return byte_pairs.Ranks.load()


@pytest.fixture(scope="module")
def coder(ranks):
    return byte_pairs.Coder(ranks)


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks.tokens)}, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aAé1 \n\t'sl—的😀　\x1c", max_size=60))
def test_ids_equal_the_library(coder, plain, text):
    assert coder.ids([text])[0].tolist() == plain.encode_ordinary(text)


def test_characters_of_later_unicode(coder, plain, ranks):
    later = sorted(set().union(*ranks.later.values()))
    rng = random.Random(5)
    texts = ["".join(rng.choice([rng.choice(later or "a"), "a", "1", " ", "뮞"]) for _ in range(30)) for _ in range(300)]
    assert [i.tolist() for i in coder.ids(texts)] == [plain.encode_ordinary(t) for t in texts]


def test_long_texts_are_cut_where_no_word_crosses(coder, plain, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(byte_pairs, "PIECE_CHARS", 20)
    for alphabet in ("ab  \n", "ab1.' \t", "a", " ", "é 　"):
        for _ in range(50):
            text = "".join(rng.choice(alphabet) for _ in range(300))
            assert coder.ids([text])[0].tolist() == plain.encode_ordinary(text)
    assert coder.ids(["ab" * 300_000])[0].tolist() == plain.encode_ordinary("ab" * 300_000)


def test_memory_is_bounded(ranks, plain, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED_BYTES", 2_000)
    own = byte_pairs.Coder(ranks)
    for i in range(50):
        text = " ".join(f"word{i}x{j}" for j in range(20)) + "y" * 500
        assert own.ids([text])[0].tolist() == plain.encode_ordinary(text)
        assert own.size < 20_000 and all(len(w) <= byte_pairs.REMEMBERED_CHARS for w in own.known)


def frame(spark, rows):
    names = ("token_ids", "token_starts", "token_ends", "decoded", "ids")
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in names})


def test_encode_and_decode(spark, coder, plain):
    rows = [(1, "one  two\nthree's 😀é"), (2, None), (3, ""), (None, "of no id"), (1, "another text"), (1, "another text"), (4, "a b " * 400_000)]
    coded = byte_pairs.encode(frame(spark, rows))
    assert coded.columns == ["doc_id", "text", "decoded", "ids", "token_ids", "token_starts", "token_ends"]
    found = byte_pairs.decode(coded).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in found) == sorted((d or 0, t or "") for d, t in rows)
    for r in found:
        text = r["text"] or ""
        assert r["decoded"] == text and r["ids"] == "x"
        assert r["token_ids"] == plain.encode_ordinary(text)
        if len(text) < 100:
            words = coder.words(text)
            starts = [sum(map(len, words[:i])) for i in range(len(words))]
            expected = [(s + a, s + b) for s, w in zip(starts, words) for a, b in coder.library.encode(w).offsets]
            assert list(zip(r["token_starts"], r["token_ends"])) == expected
    assert byte_pairs.decode(byte_pairs.encode(frame(spark, []))).count() == 0


def test_decode_of_parts_and_strangers(spark, plain):
    smile = plain.encode_ordinary("😀")
    assert len(smile) > 1
    rows = [(1, smile), (2, smile[:1]), (3, None), (4, [None, *plain.encode_ordinary("a b"), None]), (5, [10**6]), (6, [-1])]
    coded = spark.createDataFrame(rows, "doc_id long, token_ids array<int>")
    texts = {r["doc_id"]: r["decoded"] for r in byte_pairs.decode(coded).collect()}
    assert texts == {1: "😀", 2: "�", 3: "", 4: "a b", 5: "�", 6: "�"}
    held = {r["doc_id"]: bytes(r["decoded"]) for r in byte_pairs.decode(coded, as_bytes=True).collect()}
    assert held[1] == "😀".encode() and "😀".encode().startswith(held[2]) and held[2]


def test_query(spark, sf, plain):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = set()
    for r in table(spark, sf, "documents").collect():
        ids = plain.encode_ordinary(r["text"] or "")
        expected.add((r["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    found = queries.op13_byte_pairs(spark, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in found.collect()} == expected
