"""Quality rules: fixed counts first, then a trained classifier against a fixed threshold.

The classifier is a logistic regression on hashed word and character n-grams. It is
fitted in one task on a sample whose size is a parameter, never grows with the data,
and is drawn by a hash; a held-back part of the sample calibrates its probabilities.
Every text is scored whole, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, pick, share_per_class, unit_hash
from icufeat.llm.textstats import hashed_ngrams, numbered, repeated_lines, repeated_words, symbols, words_of

#: The base rules: fewer words than this, or a larger share (in %) of repeated words, fails.
MIN_WORDS, MAX_REPEATED = 10, 20
#: A text that passes the base rules is kept at this probability of good quality.
KEEP_AT = 0.5
#: Slots are 2 to this power.
BITS = 18
#: Labelled documents per class that the classifier is fitted on, about.
ROWS_PER_CLASS = 1_500
#: Passes over the sample; one row in CALIBRATE calibrates instead.
EPOCHS, CALIBRATE = 6, 5
STEP = 0.5


@dataclass(frozen=True)
class NgramClassifier:
    """Weights by slot, and the line that turns a margin into a calibrated log-odds."""

    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, text: str, ids: np.ndarray, different: list[str]) -> float:
        margin = sum(float(self.weights[s].mean()) for s in hashed_ngrams(text, BITS, ids, different) if len(s))
        return _logistic(self.slope * margin + self.offset)


def _logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-x))) if x >= 0 else float(np.exp(x) / (1 + np.exp(x)))


def _row(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text; the values of each family of n-grams add up to 1."""
    text = text or ""
    families = [s for s in hashed_ngrams(text, BITS, *numbered(words_of(text))) if len(s)]
    if not families:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    slots, at = np.unique(np.concatenate(families), return_inverse=True)
    values = np.bincount(at, weights=np.concatenate([np.full(len(s), 1 / len(s)) for s in families]), minlength=len(slots))
    return slots, values.astype(np.float32)


def fit_rows(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float) -> NgramClassifier:
    """Stochastic gradient steps scaled by past gradients, then Platt's line on the held-back rows, weighted to `prior`."""
    weights, seen = np.zeros(1 << BITS, np.float32), np.full(1 << BITS, 1e-8, np.float32)
    train = [r for i, r in enumerate(rows) if i % CALIBRATE] or rows
    held = [r for i, r in enumerate(rows) if i % CALIBRATE == 0]
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(train)):
            y, slots, values = train[i]
            if len(slots):
                g = (_logistic(float(weights[slots] @ values)) - y) * values
                seen[slots] += g * g
                weights[slots] -= STEP * g / np.sqrt(seen[slots])
    y = np.array([r[0] for r in held], float)
    x = np.array([float(weights[s] @ v) for _, s, v in held])
    # Each class counts as much as it does among all labelled rows; smoothed targets keep the line finite.
    ones, zeros = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    w = np.where(y > 0, prior / ones, (1 - prior) / zeros) * len(held)
    t = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    spread = float(x.std()) or 1.0
    u = x / spread
    a, c = 1.0, 0.0
    for _ in range(50):
        p = np.array([_logistic(v) for v in a * u + c])
        d, h = w * (p - t), w * p * (1 - p) + 1e-9
        hess = np.array([[(h * u * u).sum() + 1e-6, (h * u).sum()], [(h * u).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, [(d * u).sum(), d.sum()])
        move = np.clip(move, -2, 2)
        a, c = a - move[0], c - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return NgramClassifier(weights, a / spread, c)


def fit_classifier(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", rows_per_class: int = ROWS_PER_CLASS
) -> NgramClassifier | None:
    """The classifier of label 1 against 0; None where the labelled documents lack one of the two.

    A document with several labels takes their rounded mean. About `rows_per_class`
    documents of each class are drawn; only their ids are broadcast, and only their texts
    meet in the one task that fits.
    """
    votes = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in votes.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    prior = counts[1] / (counts[0] + counts[1])
    drawn = votes.filter(unit_hash(key, seed=3) < pick(F.col("y"), share_per_class(counts, rows_per_class)))
    sample = docs.select(key, text).join(F.broadcast(drawn), key)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in in_slices(batches):
            rows += [(y, *_row(t)) for t, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
        if len({r[0] for r in rows}) == 2:
            m = fit_rows(rows, prior)
            yield pa.RecordBatch.from_pydict({"w": pa.array([m.weights.tobytes()], pa.binary()), "a": [m.slope], "c": [m.offset]})

    one = sample.repartition(1).sortWithinPartitions(unit_hash(key, text, seed=4), key).select(text, "y")
    got = one.mapInArrow(fit, "w binary, a double, c double").collect()
    return NgramClassifier(np.frombuffer(bytes(got[0].w), np.float32), got[0].a, got[0].c) if got else None


def judge(docs: DataFrame, model: NgramClassifier | None, *, key: str = "doc_id", text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept) of every row.

    Texts are read whole; a null text counts as one without words, and so fails the base
    rules. Without a model the base rules alone decide (probability null). Repeated rows
    are judged each; an empty table gives no rows.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    )

    def one(t: str | None) -> tuple:
        t = t or ""
        words = words_of(t)
        ids, different = numbered(words)
        n, again = len(words), repeated_words(ids, len(different))
        failed = n < MIN_WORDS or 100 * again > MAX_REPEATED * n
        p = model.probability(t, ids, different) if model else None
        kept = not failed and (p is None or p >= keep_at)
        return n, sum(map(len, words)), symbols(t), repeated_lines(t), again, failed, p, kept

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            found = list(zip(*map(one, part.column(1).to_pylist()), strict=True)) or [()] * 8
            columns = [pa.array(c, pa.int64()) for c in found[:5]]
            columns += [pa.array(found[5], pa.bool_()), pa.array(found[6], pa.float64()), pa.array(found[7], pa.bool_())]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def kept_rows(docs: DataFrame, model: NgramClassifier | None, *, text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of `docs`, all columns, that `judge` keeps."""
    schema = docs.schema
    at = docs.columns.index(text)

    def one(t: str | None) -> bool:
        words = words_of(t or "")
        ids, different = numbered(words)
        failed = len(words) < MIN_WORDS or 100 * repeated_words(ids, len(different)) > MAX_REPEATED * len(words)
        return not failed and (model is None or model.probability(t or "", ids, different) >= keep_at)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            yield part.filter(pa.array([one(t) for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)
