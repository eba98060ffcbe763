"""Alignment against plain loops over tokens, with the vocabularies' own libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from icufeat.llm import alignment
from tests.llm.cases import TEXTS, no_documents, odd_documents, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts):
    """One tuple per text, in their order."""
    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    signs = alignment.byte_signs()

    def piece(i):
        p = right.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()

    parts, linked, total = [], [], Counter()
    for _, t in texts:
        a = left.encode(" " + (t or ""), add_special_tokens=False)
        b = right.encode(t or "")
        sides = [(i, bytes(signs[c] for c in p)) for i, p in zip(a.ids, a.tokens, strict=True)], [(i, piece(i)) for i in b]
        if not t or any(b"".join(x for _, x in s) != (" " + t).encode() for s in sides):
            sides = [], []
        ends = []
        for s in sides:
            at, own = 0, {}
            for i, x in s:
                at += len(x)
                own[at] = i
            ends.append(own)
        both = sorted(ends[0].keys() & ends[1].keys())
        joint, cut = set(both), ([[]], [[]])
        for own, named in zip(ends, cut, strict=True):
            for e, i in own.items():
                named[-1].append(str(i))
                if e in joint:
                    named.append([])
        groups = ["|".join(map(",".join, pair)) for pair in zip(*cut, strict=True) if any(pair)]
        parts.append((len(sides[0]), len(sides[1]), len(groups), ";".join(groups)))
        linked.append([(ends[0][e], ends[1][e]) for e in both])
        total.update(linked[-1])
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (k, _), (n_a, n_b, n, named), pairs in zip(texts, parts, linked, strict=True):
        digest = hashlib.sha256(named.encode()).hexdigest() if n else ""
        out.append((k, n_a, n_b, n, n, sum(total[p] == best[p[1]] for p in pairs), sum(total[p] for p in pairs), digest))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, *map(str, r)))


SHORT = [(k, t) for k, t in TEXTS if len(t or "") < 50_000]
EXTRA = [(50, "<|endoftext|> <s> </s> <0x41> <unk>"), (51, " two  spaces   "), (52, "can't we'll 12345 ١٢٣ 𝒳 ﷽"), (53, "▁"), (54, "\n"), (55, "a" * 3_000)]


@pytest.mark.parametrize("sizes", [{}, {"cuts": 3, "records": 40, "fan": 2, "chunk": 5}])
def test_odd_texts(spark, sizes):
    texts = [*SHORT, *EXTRA, *[(100 + i, words(i % 9, 5 + i)) for i in range(20)]]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(3)
    got = alignment.align_tokens(docs, A, B, **sizes)
    assert got.columns == COLUMNS
    want = brute(texts)
    assert {r[0] for r in want if r[1] == 0} >= {4, 5, 53} and ordered(got.collect()) == ordered(want)


def test_very_long_texts_and_other_columns(spark):
    want = ordered(brute(TEXTS))
    assert ordered(alignment.align_tokens(odd_documents(spark), A, B).collect()) == want


def test_no_documents(spark):
    assert alignment.align_tokens(no_documents(spark), A, B).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_merges(seed):
    draw = random.Random(seed)
    runs, total = [], Counter()
    for _ in range(9):
        one = Counter(draw.choices(range(400), k=draw.randint(0, 300)))
        total.update(one)
        chunks, keys = [], sorted(one)
        while keys:
            n = draw.randint(1, 20)
            chunks.append((np.array(keys[:n]), np.array([one[k] for k in keys[:n]])))
            keys = keys[n:]
        runs.append(iter(chunks))
    found = list(alignment.with_best(alignment.merged(runs), 3))
    most = Counter()
    for p, n in total.items():
        most[p >> 3] = max(most[p >> 3], n)
    flat = [(int(p), int(n), bool(x)) for c in found for p, n, x in zip(*c, strict=True)]
    assert flat == [(p, total[p], total[p] == most[p >> 3]) for p in sorted(total)]
