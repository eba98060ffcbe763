"""The pipeline's near-duplicates, at five words and 80 %, against comparing every pair."""

import random

import pytest

import corpus_pipeline
from icufeat.llm import jaccard
from tests.llm.cases import words
from tests.llm.test_jaccard import edited, planted  # noqa: F401


def brute(texts, size=5, percent=80):
    """The smallest reachable id by id, every pair compared."""
    sets = {}
    for i, t in texts:
        w = [x.lower() for x in (t or "").split()]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def near(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    return {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}


def test_pairs_between_the_two_measures(spark):
    """A copy with 20 of 120 words appended: 96 of 116 five-word shingles (0.828), 97 of 117 four-word ones (0.829)."""
    named = [f"w{i}" for i in range(500)]
    texts = [(1, " ".join(named[:100])), (2, " ".join(named[:120]))]
    texts += [(3, " ".join(named[200:300])), (4, " ".join(named[200:323])), (5, " ".join(named[200:325]))]  # 96 of 119 and of 121
    assert near(spark, texts) == {1, 3}
    groups = jaccard.jaccard_groups(spark.createDataFrame(texts, "doc_id BIGINT, text STRING"))
    assert {r.component_id for r in groups.collect()} == {1, 2, 3, 4}  # op10's own contract stays


def test_planted_near_duplicates(spark, planted):  # noqa: F811
    assert near(spark, planted) == set(brute(planted).values())


@pytest.mark.parametrize("seed", [1])
def test_copies_around_the_line(spark, seed):
    """Bases with copies of 0.7 to 0.9, by isolated changes, cut ends and appended words."""
    draw, texts = random.Random(seed), []
    for g in range(60):
        base = " ".join(f"b{seed}x{g}x{k}" for k in range(draw.randint(8, 140)))
        n = len(base.split())
        texts.append(base)
        for _ in range(draw.randint(1, 5)):
            kind = draw.randrange(3)
            if kind == 0:
                texts.append(edited(base, draw, max(1, n // draw.randint(35, 60))))
            elif kind == 1:
                texts.append(base + " " + " ".join(f"more{draw.random()}" for _ in range(n // draw.randint(3, 7))))
            else:
                texts.append(" ".join(base.split()[n // draw.randint(4, 9) :]))
    draw.shuffle(texts)
    texts = list(enumerate(texts))
    assert near(spark, texts) == set(brute(texts).values())


def test_short_texts_have_their_own_shingle():
    four, five = "a b c d", "a b c d e"
    assert len(jaccard.shingles(four, 5)) == len(jaccard.shingles(five, 5)) == 1 and len(jaccard.shingles(five)) == 2
    assert jaccard.shingles(four, 5)[0] not in jaccard.shingles(five, 5)
