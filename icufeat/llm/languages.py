"""Language of a text by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams (1 to 3 letters, words padded with
a blank) by rank. A document's own list is compared to each: an n-gram costs the
difference of its two ranks, or the length of the profile where the language lacks it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, pick, share_per_class, unit_hash

UNKNOWN = "und"
BLANK = 32

#: n-grams in a profile.
PROFILE = 400
#: Labelled documents per language that a profile is learned from, about.
ROWS_PER_LANGUAGE = 2_000
#: n-grams counted in a task before it hands on what it has.
PENDING = 2_000_000


@dataclass(frozen=True)
class Profiles:
    """Ranks of n-grams (rows) in languages (columns); `size` stands for a missing one."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)


def grams_of(text: str | None) -> np.ndarray:
    """Keys of all n-grams of a text, with repeats; none if it has no letter."""
    a = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[a]
    if not letter.any():
        return np.empty(0, np.int64)
    # One blank for each run of other characters, and one at both ends.
    a = np.concatenate([[BLANK], np.where(letter, a, BLANK), [BLANK]])
    letter = np.concatenate([[False], letter, [False]])
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    keep &= letter | np.concatenate([[True], letter[:-1]])
    a, letter = a[keep], letter[keep]
    one = a[letter]
    two = (a[:-1] << 21) | a[1:]
    three = ((a[:-2] << 42) | (a[1:-1] << 21) | a[2:])[letter[1:-1]]
    return np.concatenate([one, two[letter[:-1] | letter[1:]], three])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def learn_profiles(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, size: int = PROFILE
) -> Profiles:
    """Profiles from the rows that have a language and a text.

    About `rows_per_language` rows of each language are read, drawn by a hash of the
    text; a language with fewer gives all. What reaches the driver are `size` n-grams
    for each language.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    shares = share_per_class({r[0]: r[1] for r in known.groupBy(lang).count().collect()}, rows_per_language)
    drawn = known.filter(unit_hash(text, seed=6) < pick(F.col(lang), shares))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        pending = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, keys in held.items():
                k, n = _counted(np.concatenate(keys))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
            held.clear()

        for part in in_slices(batches):
            for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                keys = grams_of(t)
                held.setdefault(name, []).append(keys)
                pending += len(keys)
                if pending >= PENDING:
                    yield from flush()
                    pending = 0
        yield from flush()

    counts = drawn.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < size).select("lang", "gram", "rank").collect()
    languages = tuple(sorted({r.lang for r in top}))
    grams = np.array(sorted({r.gram for r in top}), np.int64)
    ranks = np.full((len(grams), len(languages)), size, np.int64)
    for r in top:
        ranks[np.searchsorted(grams, r.gram), languages.index(r.lang)] = r["rank"]
    return Profiles(languages, grams, ranks, size)


def closest(text: str | None, p: Profiles) -> tuple[str, float]:
    """The language at the least out-of-place distance, and 1 - distance / largest possible distance."""
    keys = grams_of(text)
    if not len(keys) or not p.languages:
        return UNKNOWN, 0.0
    grams, n = _counted(keys)
    own = grams[np.argsort(-n, kind="stable")[: p.size]]  # ties: the smaller key first
    at = np.searchsorted(p.grams, own)
    at[at == len(p.grams)] = 0
    there = p.ranks[at]
    there[p.grams[at] != own] = p.size
    away = np.abs(there - np.arange(len(own))[:, None])
    away[there == p.size] = p.size
    total = away.sum(axis=0)
    best = int(total.argmin())
    return p.languages[best], float(1 - total[best] / (p.size * len(own)))


def identify(docs: DataFrame, profiles: Profiles, *, key: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(key, extra…, lang_pred, score) of every row, from the whole text alone.

    A null text, one without a letter, or profiles without a language give (`und`, 0).
    Equal distances go to the first language by name. Repeated rows are judged each.
    """
    given = docs.select(F.col(key), F.col(text), *[c.alias(n) for n, c in (extra or {}).items()])
    schema = T.StructType([f for f in given.schema if f.name != text] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            found = [closest(t, profiles) for t in part.column(1).to_pylist()]
            rest = [part.column(i) for i in range(part.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], schema.names
            )

    return given.mapInArrow(run, schema)


def in_language(docs: DataFrame, profiles: Profiles, least: float, *, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text is in a learned language by a score of `least` or more."""
    at = docs.columns.index(text)

    def good(t: str | None) -> bool:
        name, score = closest(t, profiles)
        return name != UNKNOWN and score >= least

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            yield part.filter(pa.array([good(t) for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
