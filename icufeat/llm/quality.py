"""Quality score: kernel ridge regression over document statistics, in random Fourier features.

Each text becomes a short vector of statistics. Cosines of random projections stand in
for a Gaussian kernel over these vectors, so the ridge fit needs sums of fixed size
only: every partition adds up its part of the normal equations, Spark adds the parts.
Isotonic regression on rows the ridge has not seen turns its output into a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, unit_hash
from icufeat.llm.textstats import STATISTICS, statistics

#: Random features, the kernel's width in standard deviations, and the ridge per row.
FEATURES, WIDTH, RIDGE = 160, 4.0, 1e-4
#: Standardised statistics beyond this are drawn in.
LIMIT = 6.0
#: Share of the labelled rows that calibrates, and bins of the ridge output there.
HELD, BINS = 0.25, 2_048


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -LIMIT, LIMIT)
        f = np.cos(z @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([f, np.ones((len(f), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.weights, self.knots, self.levels)


def with_statistics(docs: DataFrame, *, key: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(key, extra…, stats) of every row; a null text has the statistics of an empty one."""
    given = docs.select(F.col(key), F.col(text), *[c.alias(n) for n, c in (extra or {}).items()])
    schema = T.StructType([f for f in given.schema if f.name != text] + [T.StructField("stats", T.ArrayType(T.DoubleType(), False))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            stats = pa.array([statistics(t) for t in part.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(part.num_columns) if i != 1], stats], schema.names)

    return given.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(sums: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the best rising function through (place, rows, ones), by pooling neighbours that fall.

    Between the middles of two pools the function is a straight line, so it keeps the order of the scores.
    """
    pools: list[list[float]] = []
    for place, n, ones in sorted(sums):
        pools.append([place * n, n, ones])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def fit_quality(stats: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", seed: int = 1) -> QualityModel | None:
    """The model from all labelled rows of `stats`; None where they lack one of the two labels.

    A document with several labels takes their rounded mean. The join moves ids, labels and
    statistics, never texts. The driver gets one sum per entry of the normal equations and
    per calibration bin, however many rows there are.
    """
    votes = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    known = stats.filter(F.col(key).isNotNull()).join(votes, key).select(key, "stats", "y")
    sizes = [f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(len(STATISTICS)) for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))]
    found = known.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *sizes).first()
    if not found.n or found.ones in (0, found.n):
        return None
    mean = np.array([found[f"m{i}"] for i in range(len(STATISTICS))])
    scale = np.array([found[f"s{i}"] or 1.0 for i in range(len(STATISTICS))])
    draw = np.random.default_rng(seed)
    projection = draw.normal(0, 1 / WIDTH, (len(STATISTICS), FEATURES))
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    blank = QualityModel(mean, scale, projection, phase, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    held = unit_hash(key, seed=seed) < HELD
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def normal_equations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, moment = np.zeros((size, size)), np.zeros(size)
        for b in batches:
            if b.num_rows:
                z = blank.features(_matrix(b.column(0)))
                gram += z.T @ z
                moment += z.T @ b.column(1).to_numpy().astype(float)
        values = np.concatenate([gram[upper], moment])
        if gram[-1, -1]:
            yield pa.RecordBatch.from_pydict({"entry": np.arange(len(values)), "value": values})

    def fitted(rows: DataFrame) -> np.ndarray | None:
        sums = rows.select("stats", "y").mapInArrow(normal_equations, "entry bigint, value double").groupBy("entry").agg(F.sum("value")).collect()
        if not sums:
            return None
        values = np.zeros(len(upper[0]) + size)
        for entry, value in sums:
            values[entry] = value
        gram = np.zeros((size, size))
        gram[upper] = values[: len(upper[0])]
        gram = gram + np.triu(gram, 1).T
        return np.linalg.solve(gram + RIDGE * gram[-1, -1] * np.eye(size), values[len(upper[0]) :])

    weights = fitted(known.filter(~held))
    if weights is None:  # a handful of rows: fit and calibrate on the same
        weights, held = fitted(known), F.lit(True)
    raw = QualityModel(mean, scale, projection, phase, weights, blank.knots, blank.levels)

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = raw.features(_matrix(b.column(0))) @ weights
                yield pa.RecordBatch.from_pydict({"bin": np.clip(np.round((s + 0.5) / 2 * BINS), 0, BINS).astype(np.int64), "y": b.column(1)})

    def counted(rows: DataFrame) -> list[tuple[float, float, float]]:
        bins = rows.select("stats", "y").mapInArrow(binned, "bin bigint, y int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones"))
        return [(r.bin / BINS * 2 - 0.5, float(r.n), float(r.ones)) for r in bins.collect()]

    sums = counted(known.filter(held)) or counted(known)
    knots, levels = isotonic(sums)
    return QualityModel(mean, scale, projection, phase, weights, knots, levels)


def score(stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """`stats` with score (0 to 1) and predicted (1 from 0.5 on) instead of the statistics; without a model the score is 0.5."""
    schema = T.StructType([f for f in stats.schema if f.name != "stats"] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = stats.columns.index("stats")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.score(_matrix(b.column(at))) if model and b.num_rows else np.full(b.num_rows, 0.5)
            rest = [b.column(i) for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], schema.names)

    return stats.mapInArrow(run, schema)
