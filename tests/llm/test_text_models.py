"""Language, quality score and quality rules: counts by brute force, accuracy on rows held out."""

import re
from zlib import crc32

import numpy as np
import pytest

from icufeat.llm import languages, quality, rules
from icufeat.llm.queries import op1_quality, op3_rules, op6_language
from icufeat.llm.textstats import STATISTICS, numbered, repeated_words, statistics
from tests.llm.cases import TEXTS, labels_of, no_documents, odd_documents

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op6_language(spark, DATA).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(held) > 0.97


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    profiles = languages.learn_profiles(docs)
    got = [(r.doc_id, r.lang_pred, r.score) for r in languages.identify(docs, profiles).collect()]
    assert len(got) == len(TEXTS)
    named = {i: (name, s) for i, name, s in got if i}
    assert profiles.languages == ("en",)
    assert all(named[i] == ("und", 0.0) for i in (4, 5, 6, 12))
    assert named[1] == named[2] and named[1][0] == "en"
    assert languages.in_language(docs, profiles, 0.0).count() == sum(bool(re.search(r"[^\W\d_]", t or "")) for _, t in TEXTS)
    nothing = languages.learn_profiles(no_documents(spark))
    assert nothing.languages == () and languages.closest("some text", nothing) == ("und", 0.0)
    assert languages.identify(no_documents(spark), profiles).count() == 0


def test_out_of_place_distance():
    """One letter, bigrams with blanks and the whole word: ranks are compared one by one."""
    grams = np.unique(languages.grams_of("ab"))
    p = languages.Profiles(("x", "y"), grams, np.array([[i, 10] for i in range(len(grams))]), 10)
    name, score = languages.closest("ab ab", p)
    assert name == "x" and score == 1.0
    assert languages.closest("zz", p)[1] == 0.0


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = op1_quality(spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.93


def test_quality_odd_rows(spark):
    stats = quality.with_statistics(odd_documents(spark))
    assert all(len(r.stats) == len(STATISTICS) and np.isfinite(r.stats).all() for r in stats.collect())
    some = labels_of(spark, [(1, 1, 0, "a"), (1, 1, 0, "b"), (5, 0, 0, None), (12, 0, None, None), (None, 1, 0, None), (3, None, 0, None), (99, 1, 0, None)])
    scored = quality.score(stats, quality.fit_quality(stats, some)).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r.score <= 1 for r in scored)
    for few in ([], [(1, 1, 0, None)]):
        model = quality.fit_quality(stats, labels_of(spark, few))
        assert model is None and {r.score for r in quality.score(stats, model).collect()} == {0.5}
    empty = quality.with_statistics(no_documents(spark))
    assert quality.score(empty, quality.fit_quality(empty, some)).count() == 0


def test_isotonic_is_the_pooled_mean():
    knots, levels = quality.isotonic([(0.0, 1, 0), (1.0, 1, 1), (2.0, 1, 0), (3.0, 2, 2)])
    assert knots.tolist() == [0.0, 1.5, 3.0] and levels.tolist() == [0.0, 0.5, 1.0]


def test_fourier_features_approximate_the_kernel():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(40, 4))
    m = quality.QualityModel(np.zeros(4), np.ones(4), draw.normal(0, 0.5, (4, 8000)), draw.uniform(0, 2 * np.pi, 8000), None, None, None)
    z = m.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) * 0.25 / 2)
    assert np.abs(z @ z.T - want).max() < 0.08


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered)


def test_rule_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    both = docs.unionByName(odd_documents(spark).select("doc_id", "text"))
    texts = [(r.doc_id, r.text) for r in both.collect()]
    got = sorted(
        (r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in rules.judge(both, None).collect()
    )
    want = []
    for i, t in texts:
        n, *rest, again = brute_counts(t)
        failed = n < 10 or 100 * again > 20 * n
        want.append((i or -1, n, *rest, again, failed, not failed))
    assert got == sorted(want)


def test_windows_over_many_words():
    """Enough different words that five numbers do not fit one key."""
    ids, different = numbered([f"w{i % 4999}" for i in range(9_000)])
    assert repeated_words(ids, len(different)) == 2 * (9_000 - 4_999)


def test_rules_verdict(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = op3_rules(spark, DATA).collect()
    passed = [(r.kept, truth[r.doc_id]) for r in rows if not r.base_failed and r.doc_id in truth]
    assert np.mean([a == bool(b) for a, b in passed]) > 0.95
    assert all(not r.kept for r in rows if r.base_failed)


def test_rules_odd_rows(spark):
    docs = odd_documents(spark)
    model = rules.fit_classifier(docs, labels_of(spark, [(i, i % 2, 0, None) for i in range(1, 16)] + [(1, 1, 0, None), (None, 0, 0, None)]))
    got = rules.judge(docs, model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.probability <= 1 for r in got)
    kept = rules.kept_rows(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert rules.fit_classifier(docs, labels_of(spark, [(1, 1, 0, None)])) is None
    assert rules.fit_classifier(no_documents(spark), labels_of(spark, [(1, 1, 0, None), (2, 0, 0, None)])) is None
    assert rules.judge(no_documents(spark), model).count() == 0


@pytest.mark.parametrize("text", ["", None, "a", "\n\n", "x" * 50_000])
def test_statistics_are_finite(text):
    assert np.isfinite(statistics(text)).all()
