"""Encoding and decoding against the library."""

import hashlib
import random

import pytest
import sentencepiece

from icufeat.llm import pieces
from icufeat.llm.queries import tokenizer_file
from tests.llm.cases import TEXTS, no_documents, odd_documents


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())


@pytest.fixture(scope="module")
def own():
    return pieces.codec(tokenizer_file())


def test_random_texts(own, library):
    draw = random.Random(5)
    signs = [*"abehtins  \n\t▁\x00é😀中", "the", " the", "  ", "     ", "ing", "http", "́", "{}", "();", ".,", "²."]
    every = list(own.rank)
    for _ in range(4000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 25)))
        assert own.encode(text) == library.encode(text), repr(text)
        text = "".join(draw.choice(every) for _ in range(draw.randint(1, 4))).replace("▁", " ")
        assert own.encode(text) == library.encode(text), repr(text)


def test_backtracking_equals_merging(own):
    draw = random.Random(6)
    for _ in range(3000):
        word = "".join(draw.choice("thesandionrw") for _ in range(draw.randint(1, 14)))
        assert own.walk("▁" + word) == own.merge("▁" + word)[0]


def test_decoding_any_ids(own, library):
    draw = random.Random(7)
    for _ in range(3000):
        ids = [draw.choice([3, 13, 14, 200, 230, 250, 100, 259, 260, 28705, 264, 287, 1, 2, 0, 30575]) for _ in range(draw.randint(0, 6))]
        assert own.decode(ids) == library.decode(ids), ids


def test_odd_rows(spark, library):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.token_digests(odd_documents(spark), tokenizer_file()).collect())
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((i or -1, len(ids), *sha))
    assert got == sorted(want)
    plain = {r.doc_id: (r.token_ids, r.decoded) for r in pieces.encode_texts(odd_documents(spark), tokenizer_file()).collect()}
    assert plain[7] == (library.encode("one two"), "one two") and plain[4] == ([], "")
    assert pieces.token_digests(no_documents(spark), tokenizer_file()).count() == 0


def test_other_models_are_refused():
    with pytest.raises(Exception):  # noqa: B017
        pieces.PieceCodec(tokenizer_file("byte_bpe_50k.json"))
