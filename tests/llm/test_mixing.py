"""Raking against a plain loop over the cells."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from icufeat.llm import mixing
from tests.llm.cases import TEXTS, no_documents, odd_documents


def brute_mix(rows, power=mixing.POWER, budget=mixing.BUDGET):
    """Weight and probability of each cell (source, lang, topic), from rows of cell and tokens."""
    base = defaultdict(float)
    for cell, tokens in rows:
        base[cell] += tokens
    base = {k: v for k, v in base.items() if v}
    total = sum(base.values())
    w = dict.fromkeys(base, 1.0)
    goals = []
    for at in range(3):
        own = defaultdict(float)
        for k, v in base.items():
            own[k[at]] += v
        powers = sum(v**power for v in own.values())
        goals.append({k: total * v**power / powers for k, v in own.items()})
    for _ in range(300):
        for at, goal in enumerate(goals):
            got = defaultdict(float)
            for k, v in base.items():
                got[k[at]] += v * w[k]
            for k in w:
                w[k] *= goal[k[at]] / got[k[at]]
    lo, hi = 0.0, 1 / min(w.values())
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(v * min(1, mid * w[k]) for k, v in base.items()) < budget * total else (lo, mid)
    return w, {k: min(1.0, hi * v) for k, v in w.items()}, goals, base


@pytest.mark.parametrize("budget", [0.1, 0.5, 0.95])
def test_against_loop(spark, budget):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix_table(docs, budget=budget).collect()
    w, p, goals, base = brute_mix([((r.source, r.lang, r.topic), r.tokens) for r in got], budget=budget)
    for r in got:
        k = (r.source, r.lang, r.topic)
        assert r.weight == pytest.approx(w[k], rel=1e-8) and r.probability == pytest.approx(p[k], rel=1e-8)
    for at, goal in enumerate(goals):
        for name, want in goal.items():
            assert sum(base[k] * w[k] for k in base if k[at] == name) == pytest.approx(want, rel=1e-8)
    expected = sum(r.tokens * r.probability for r in got)
    assert expected == pytest.approx(budget * sum(r.tokens for r in got), rel=1e-6)
    assert {r.doc_id for r in got if r.selected} == {r.doc_id for r in mixing.draw(docs, budget=budget).collect()}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = mixing.mix_table(docs).collect()
    assert len(got) == len(TEXTS)
    assert all(0 <= r.probability <= 1 and r.source is not None and r.lang is not None for r in got)
    assert not any(r.selected for r in got if r.tokens == 0)
    chosen = mixing.draw(docs)
    assert chosen.columns == docs.columns
    twice = [r.selected for r in got if r.doc_id == 1]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert mixing.mix_table(no_documents(spark)).count() == 0 and mixing.draw(no_documents(spark)).count() == 0
    assert not any(r.selected for r in mixing.mix_table(docs.filter("doc_id IN (4, 5)")).collect())


def tokens_by(rows, name):
    sums = defaultdict(float)
    for r in rows:
        sums[r[name]] += r.tokens * r.weight
    return sums


def test_given_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sources = [r[0] for r in docs.filter("source IS NOT NULL AND length(text) > 0").groupBy("source").count().orderBy(F.desc("count")).limit(3).collect()]
    langs = [r[0] for r in docs.filter(F.col("source").isin(sources)).filter("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count")).limit(2).collect()]
    topic = F.when(F.length("text") % 2 == 0, "even").otherwise("odd")
    wanted = mixing.Targets(dict(zip(sources, (5, 3, 2), strict=True)), dict(zip(langs, (1, 3), strict=True)), {"even": 0.4, "odd": 0.6, "absent": 7})
    got = mixing.mix_table(docs, targets=wanted, topic=topic, budget=0.2).collect()
    total = sum(r.tokens for r in got if r.source in sources and r.lang in langs)
    for name, shares in (("source", wanted.sources), ("lang", wanted.languages), ("topic", {"even": 0.4, "odd": 0.6})):
        sums = tokens_by(got, name)
        for k, v in shares.items():
            assert sums[k] == pytest.approx(total * v / sum(shares.values()), rel=1e-6)
    outside = [r for r in got if r.source not in sources or r.lang not in langs]
    assert outside and not any(r.weight or r.probability or r.selected for r in outside)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(0.2 * total, rel=1e-6)


def test_targets_out_of_reach(spark, monkeypatch):
    rows = [(i, "a b c d", lang, source) for i, (lang, source) in enumerate([("en", "x")] * 5 + [("de", "y")] * 5 + [("de", "x")])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    cells = mixing.with_cells(docs)
    near = mixing.fit_mix(cells, targets=mixing.Targets({"x": 1, "y": 1}, {"en": 1, "de": 2}))
    assert near.error < 1e-6
    monkeypatch.setattr(mixing, "ROUNDS", 12)
    far = mixing.Targets({"x": 1, "y": 9}, {"en": 9, "de": 1})
    assert mixing.fit_mix(cells, targets=far).missed["language en"] < -0.5
    with pytest.warns(UserWarning, match="is missed by"):
        out = mixing.mix_table(docs, targets=far).collect()
    assert len(out) == len(rows) and all(0 <= r.probability <= 1 for r in out)
    assert not any(r.selected for r in mixing.mix_table(docs, targets=mixing.Targets({"nowhere": 1})).collect())
    for bad in ({"x": -1}, {"x": 0}, {"x": float("nan")}):
        with pytest.raises(ValueError):
            mixing.Targets(bad)
