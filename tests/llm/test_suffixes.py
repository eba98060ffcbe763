"""Removed bytes against looking every string up in a table of first places."""

import random

import pytest

from icufeat.llm import suffixes
from tests.llm.cases import TEXTS, no_documents, odd_documents, words

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]


def brute(texts, length=100):
    """One tuple per text, in their order."""
    raws = [(k, (t or "").encode()) for k, t in texts]
    first = {}
    for k, raw in raws:
        for p in range(len(raw) - length + 1 if k is not None else 0):
            s = hash(raw[p : p + length])
            first[s] = min(first.get(s, (k, p)), (k, p))
    out = []
    for k, raw in raws:
        stay, gone_to = bytearray(b"\1" * len(raw)), 0
        for p in range(len(raw) - length + 1 if k is not None else 0):
            if first[hash(raw[p : p + length])] < (k, p):
                low = max(p, gone_to)
                gone_to = p + length
                stay[low:gone_to] = bytes(gone_to - low)
        runs = sum(1 for p in range(len(raw)) if not stay[p] and (p == 0 or stay[p - 1]))
        out.append((k, len(raw), stay.count(0), runs, bytes(b for b, s in zip(raw, stay, strict=True) if s)))
    return out


def ordered(rows):
    return sorted(((r[0], *r[1:4], bytes(r[4])) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1:]))


def removed(spark, texts, parts=3, **options):
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(parts)
    out = suffixes.remove_repeats(docs, **options)
    assert out.columns == COLUMNS
    return ordered(out.collect())


def tangle(seed, n=150):
    """Texts that share passages of lengths around the line, cut and changed in many ways, overlapping, periodic."""
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcde é\n") for _ in range(draw.randint(60, 400))) for _ in range(12)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(1, 5)):
            p = draw.choice(pool)
            kind = draw.randrange(5)
            if kind == 0:
                a = draw.randrange(len(p))
                p = p[a : a + draw.randint(90, 130)]
            elif kind == 1:
                a = draw.randrange(len(p))
                p = p[:a] + draw.choice("xyz") + p[a + 1 :]
            elif kind == 2:
                p = "".join(draw.choice("abcde ") for _ in range(draw.randint(0, 80)))
            elif kind == 3:
                p = draw.choice(["ab", "x", "abc "]) * draw.randint(1, 90)
            parts.append(p)
        out.append((draw.randint(0, 4 * n), "".join(parts)))
    return out


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"gram": 40, "shallow": 0}), (3, {"contexts": 3}), (4, {"gram": 30, "contexts": 0})])
def test_tangled_passages(spark, monkeypatch, seed, options):
    monkeypatch.setattr(suffixes, "PART", 2 if "contexts" in options else 1)
    texts = tangle(seed)
    texts += texts[:4] + [(None, texts[0][1]), (texts[7][0], texts[8][1])]  # repeated rows, no key, a key with two texts
    want = ordered(brute(texts))
    assert sum(r[2] for r in want) > 10_000 and removed(spark, texts, **options) == want


def test_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BYTES", 700)
    monkeypatch.setattr(suffixes, "ANCHORS", 40)
    import numpy as np

    texts = tangle(9, 60)
    raw = b"".join(t.encode() for _, t in texts)
    edges = np.cumsum([0, *[len(t.encode()) for _, t in texts]])
    few = [np.concatenate(c) for c in zip(*suffixes.anchors(np.frombuffer(raw, np.uint8), edges, 100, 24), strict=True)]
    monkeypatch.setattr(suffixes, "BYTES", 1 << 30)
    one = [np.concatenate(c) for c in zip(*suffixes.anchors(np.frombuffer(raw, np.uint8), edges, 100, 24), strict=True)]
    assert all((a == b).all() for a, b in zip(few, one, strict=True))


def test_odd_rows_and_other_columns(spark):
    assert ordered(suffixes.remove_repeats(odd_documents(spark)).collect()) == ordered(brute(TEXTS))


def test_no_documents(spark):
    assert suffixes.remove_repeats(no_documents(spark)).collect() == []


def test_first_of_copies_stays(spark):
    a, b = words(1, 80), words(2, 80)
    got = removed(spark, [(3, a), (1, b + a), (2, a + b)])
    assert [r[2] for r in got] == [0, len(a + b), len(a)]


@pytest.mark.parametrize("seed", range(6))
def test_order(seed):
    draw = random.Random(seed)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 60))) for _ in range(80)]
    texts += [t[: draw.randint(0, 60)] for t in texts[:30]] + [b"a" * n for n in range(0, 60, 7)]
    for shallow in (0, 16, 64):
        assert [texts[i] for i in suffixes.deep_shallow(texts, shallow)] == sorted(texts)
