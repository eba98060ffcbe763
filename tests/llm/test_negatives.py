"""Hard negatives against scoring every pair in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from icufeat.llm import negatives

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label STRING, score DOUBLE, id BIGINT, a STRING, x INT"


def brute(rows, positives=5, count=10, low=30, high=90):
    good = [
        (i, [math.floor(256 * v) for v in e], y)
        for i, e, y in rows
        if i is not None and y is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)
    ]
    out, done = [], set()
    for i, e, y in good:
        if i % 10 or (i, tuple(e), y) in done:
            continue
        done.add((i, tuple(e), y))
        scored = sorted((-sum(p * q for p, q in zip(e, f, strict=False)), j, z) for j, f, z in good if j != i)
        for s, j, _ in [r for r in scored if r[2] == y][:positives]:
            fits = [r for r in scored if r[2] != y and low * -s <= 100 * -r[0] <= high * -s]
            out += [(i, j, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fits[:count])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, e, y, 0.5, 7, "q", 1) for i, e, y in rows], SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("block,anchors", [(4_096, 16_384), (17, 3)])
def test_odd_rows(spark, block, anchors):
    draw = random.Random(block)
    rows = [(i, [draw.uniform(-0.3, 1) for _ in range(6)], f"l{i % 3}") for i in range(150)]
    rows += [(i, [round(draw.uniform(0, 1), 1) for _ in range(2)], "l0" if i % 2 else "l1") for i in range(150, 260)]  # ties, shorter
    rows += rows[5:30:5] + rows[40:42]  # repeated rows, among them anchors
    rows += [(None, [0.5] * 6, "l1"), (400, None, "l1"), (410, [0.5, None], "l1"), (420, [0.5, math.nan], "l1"), (430, [math.inf], "l2")]
    rows += [(440, [0.5] * 6, None), (450, [], "l0"), (460, [0.0] * 6, "alone"), (470, [-0.7] * 6, "l2"), (471, [0.7] * 6, "l2")]
    want = brute(rows)
    assert len(want) > 500 and mined(spark, rows, block=block, anchors=anchors) == want


def test_large_components(spark):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) * 10.0 ** draw.randint(0, 7) for _ in range(5)], f"l{i % 2}") for i in range(40)]
    assert mined(spark, rows) == brute(rows)
    huge = [(i, [1e16 * (i + 1), 2.0], f"l{i % 2}") for i in range(12)]
    most = (1 << 63) - 1  # such scores count as the nearest long
    assert mined(spark, huge) == [] and {r[4:] for r in mined(spark, huge, high=100)} == {(most, most)}


def test_no_rows(spark):
    assert mined(spark, []) == mined(spark, [(10, None, "a")]) == mined(spark, [(1, [0.5], "a")]) == []


@pytest.mark.parametrize("size", [1, 300, 1 << 20, 1 << 40])
def test_products_are_exact(size):
    draw = random.Random(size)
    x, y = (np.array([[draw.randint(-size, size) for _ in range(64)] for _ in range(20)]) for _ in range(2))
    primes = negatives.primes_for(64, 64 * size * size)
    assert all(64 * ((p - 1) // 2) ** 2 <= negatives.EXACT for p in primes)
    got = negatives.scores(negatives.remainders(x, primes), negatives.remainders(y, primes), primes)
    assert got.tolist() == (x.astype(object) @ y.astype(object).T).tolist()
