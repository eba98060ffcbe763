"""Links and groups against comparing every pair."""

import random
import re
from collections import defaultdict

import pytest

from icufeat.llm import jaccard
from tests.llm.cases import TEXTS, no_documents, odd_documents, words

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute_groups(texts, percent=85):
    """(size, smallest reachable id) by id, with every pair that shares a shingle compared."""
    sets = {i: brute_set(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    for i, s in sets.items():
        shared = defaultdict(int)
        for g in s:
            for j in lists[g]:
                shared[j] += j < i
        for j, k in shared.items():
            if k and 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(text, draw, times):
    w = text.split(" ")
    for _ in range(times):
        w[draw.randrange(len(w))] = f"edit{draw.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def planted():
    """Chains and stars of near copies at all distances, a passage that many texts share, exact copies, short texts."""
    draw = random.Random(11)
    texts, passage = [], words(99, 60)
    for g in range(25):
        base = words(1000 + g, draw.randint(12, 150))
        texts += [base] * draw.randint(1, 3)
        for _ in range(draw.randint(0, 6)):
            texts.append(edited(base, draw, draw.randint(1, max(1, len(base.split()) // 40))))
        chain = base
        for _ in range(4):
            chain = edited(chain, draw, 1)
            texts.append(chain)
    hot = words(5, 300)
    texts += [edited(hot, draw, draw.randint(1, 4)) for _ in range(120)] + [edited(hot, draw, 9) for _ in range(20)] + [hot.upper()] * 30
    texts += [words(2000 + i, 50) + " " + passage for i in range(60)]
    texts += ["one two three", "One two THREE", "one two", "", None, "a b c d"]
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_planted_groups(spark, planted):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(planted, "doc_id BIGINT, text STRING").repartition(5)).collect()}
    assert got == brute_groups(planted)


def test_order_does_not_matter(spark, planted, monkeypatch):
    """Without any knowledge of frequent tokens the groups are the same."""
    import numpy as np

    nothing = np.empty(0, np.int64)
    monkeypatch.setattr(jaccard, "frequent_tokens", lambda *a, **b: (nothing, nothing))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(planted, "doc_id BIGINT, text STRING")).collect()}
    assert got == brute_groups(planted)


def test_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert got == brute_groups(texts)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()]
    named = dict(t for t in TEXTS if t[0] is not None)
    want = brute_groups(list(named.items()))
    assert sorted(g for g in got if g[0] is not None) == sorted((i, *want[i]) for i, _ in TEXTS if i is not None)
    assert sorted(n for i, n, c in got if i is None and c is None) == [0, 57]
    stay = jaccard.one_of_each(docs)
    assert stay.columns == docs.columns
    ids = [r.doc_id for r in stay.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()}) and ids.count(None) == 2
    assert jaccard.jaccard_groups(no_documents(spark)).count() == 0
    assert jaccard.one_of_each(no_documents(spark)).count() == 0


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (103, 102), (101, 103)] + [(200, k) for k in range(201, 230)]
    got = {r.v: r.c for r in jaccard.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)} | {i: 200 for i in range(200, 230)}
