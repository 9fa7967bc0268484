import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strata.llm import byte_bpe
from strata.llm.byte_bpe import ByteBPE, PerfectHash, decode_documents, encode_documents, load, merge_bytes, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["It's I'LL don't", None, "", " ", "  \n\t x", "a" * 5000, "é" * 3000, "日本語" * 900, "<|endoftext|> 12345 ½", "🙂👩‍👩‍👧  x",
       "x\x00\x1cy z", "\U00010ee7a 1\U000323e7", "՘aቇf0", "same", "same"]


@pytest.fixture(scope="module")
def bpe():
    return load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_perfect_hash_is_minimal_and_exact(bpe):
    tokens = list(bpe.ranks)
    assert (bpe.index.find(tokens) == np.arange(len(tokens))).all()
    assert sorted(bpe.index.key_at.tolist()) == list(range(len(tokens)))
    assert (bpe.index.find([t + b"\0q" for t in tokens[:4000]]) == -1).all()
    for keys in ([b"one"], [b"a", b"b"], [bytes([i, j]) for i in range(9) for j in range(9)], [b"x" * 9000, b"x" * 9001]):
        index = PerfectHash(keys)
        assert index.find(keys).tolist() == list(range(len(keys))) and index.find([b"none"]).tolist() == [-1]


def test_heap_merges_as_the_library(bpe, library):
    draw = random.Random(4)
    for _ in range(400):
        piece = "".join(draw.choice("abcdeé ü日12") for _ in range(draw.randrange(1, 300))).encode()
        if piece not in bpe.ranks:
            assert merge_bytes(piece, bpe.ranks) == library._core_bpe.encode_single_piece(piece)


def test_characters_of_every_class(bpe, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = ["a" + chr(c) + "a 1" + chr(c) + "1!" + chr(c) + "! " + chr(c) + " x" for c in points]
    assert [x.tolist() for x in bpe.encode(texts)] == library.encode_ordinary_batch(texts)


def test_blocks_and_forgotten_misses_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE", 1000)
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    monkeypatch.setattr(byte_bpe, "MEMORY", 1000)
    own = load(PATH, public_tokenizers.PATTERN)
    texts = [t or "" for t in ODD]
    assert [x.tolist() for x in own.encode(texts)] == library.encode_ordinary_batch(texts)


def test_round_trip_in_spark(spark, documents, bpe, library):
    frame = documents(ODD)
    rows = decode_documents(encode_documents(frame, bpe, keep=["doc_id", "lang", "spans"]), bpe).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = ODD[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(text) and bytes(r.decoded) == text.encode() and r.lang == "en"
    assert decode_documents(encode_documents(documents([]), bpe), bpe).count() == 0


def test_ids_without_a_token(spark, bpe):
    frame = spark.createDataFrame([(1, [64, None, 99999, -3, 64]), (2, None), (3, [])], "k long, ids array<int>")
    assert {r.k: bytes(r.decoded) for r in decode_documents(frame, bpe).collect()} == {1: b"aa", 2: b"", 3: b""}


def test_incomplete_vocabulary():
    with pytest.raises(ValueError):
        ByteBPE({b"a": 0}, public_tokenizers.PATTERN)
