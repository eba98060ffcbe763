"""Exact top-k by inner product with the no-random-access algorithm.

Candidates lie in blocks, and each block keeps one list of its rows per component, sorted by
value. For a query every list is read from the end its sign prefers, a stride of entries at
a time. What has been read of a row, with the places where the other lists stand, bounds its
score from above, with their far ends from below. Reading stops when all rows but a few
have an upper bound below the k-th lower bound, unseen ones included; the final scores of
those few are then resolved. A query takes its k-th score on from block to block, so later
blocks of a task stop earlier.

On vectors whose components are alike in size the bounds part late, and most entries are
read: on the test tables about nine in ten. Lists pay where few components carry the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icufeat.llm.common import stored

#: Candidates in a block, and queries that are broadcast to the blocks at a time.
BLOCK, QUERIES = 4_096, 16_384
#: Shares of a list that have been read when bounds are taken.
STOPS = (0.05, 0.15, 0.35, 0.6, 0.75, 0.85, 0.93, 1.0)
#: Scores are resolved when at most this many candidates per wanted one are left.
LEFT = 16


def usable(vectors: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """(id, x, …): components as floor(256 * x); without rows whose id or vector is null or whose vector holds null, NaN or an infinity."""
    v = F.col(vector)
    odd = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = F.col(key).isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(False))
    return vectors.filter(good).select(F.col(key).alias("id"), F.transform(v, lambda e: F.floor(e.cast("double") * 256)).alias("x"), *more)


class Lists:
    """A block: rows in order of their ids, and for each component the rows by rising value."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.rows = np.argsort(self.x.T, axis=1, kind="stable")
        self.values = np.take_along_axis(self.x.T, self.rows, 1).astype(float)
        self.largest = max(abs(int(self.x.min(initial=0))), int(self.x.max(initial=0)))

    def exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Final scores, each as the nearest long."""
        if len(q) * self.largest * int(np.abs(q.astype(object)).max(initial=0)) < 1 << 62:
            return self.x[rows] @ q
        whole = self.x[rows].astype(object) @ q.astype(object)
        return np.array([max(-(1 << 63), min((1 << 63) - 1, int(v))) for v in whole], np.int64)

    def best(self, own: int, q: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, entries read) of the best k without rows of the id `own`; ties to smaller ids.

        Rows that score below `least` may be left out.
        """
        n = len(self.ids)
        mine = slice(np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right"))
        wanted = min(k, n - (mine.stop - mine.start))
        used = np.flatnonzero(q)
        read, entries = 0, 0
        left = np.setdiff1d(np.arange(n), np.arange(mine.start, mine.stop), assume_unique=True)
        # Bounds are sums of whole floats; beyond 2^53 these are not exact, so they get that much room.
        size = len(q) * float(self.largest) * float(np.abs(q.astype(float)).max(initial=0))
        room = 0.0 if size < 2.0**53 else size * len(q) * 2.0**-51
        if len(used) and wanted > 0:
            up, down = used[q[used] > 0], used[q[used] < 0]
            used = np.concatenate([up, down])
            share = q[used].astype(float)
            fewest = np.concatenate([self.values[up, 0], self.values[down, -1]]) * share
            known, seen = np.zeros(n), np.zeros((len(used), n), np.float32)
            place = n * np.arange(len(used))[:, None]
            for stop in STOPS:
                to = max(1, int(stop * n))
                if to <= read:
                    continue
                if len(left) <= LEFT * k:
                    break
                rows = np.concatenate([self.rows[up, n - to : n - read], self.rows[down, read:to]])
                values = np.concatenate([self.values[up, n - to : n - read], self.values[down, read:to]])
                known += np.bincount(rows.ravel(), (values * share[:, None]).ravel(), n)
                seen.ravel()[place + rows] = 1.0
                entries, read = entries + rows.size, to
                # An unread component gives what its list has come to at most, and its last entry at least.
                most = np.concatenate([self.values[up, n - to], self.values[down, to - 1]]) * share
                ends = np.stack([fewest, most])
                got = (ends.astype(np.float32) @ seen) if size < 2.0**24 else ends @ seen.astype(float)
                low, high = known + ends.sum(1, keepdims=True) - got
                lows = low[left]
                bar = np.partition(lows, len(lows) - wanted)[len(lows) - wanted] - room if len(lows) >= wanted else -np.inf
                if least is not None:
                    bar = max(bar, float(least) - room)
                # A row that has not been seen has no bound of its own but the sum of the lists' places, which `high` is for it.
                left = left[high[left] + room >= bar]
        scores = self.exact(left, q)
        top = np.lexsort((self.ids[left], -scores))[: max(0, wanted)]
        return left[top], scores[top], entries


def _lists(batches: Iterable[pa.RecordBatch], width: int, block: int) -> Iterator[Lists]:
    """Blocks of rows; vectors shorter than `width` are filled up with zeros."""
    held: list[pa.RecordBatch] = []
    size = 0

    def made() -> Lists:
        t = pa.Table.from_batches(held).combine_chunks()
        return Lists(np.asarray(t.column(0).chunk(0)), filled(t.column(1).chunk(0), width))

    for b in batches:
        for at in range(0, b.num_rows, block):
            held.append(b.slice(at, block))
            size += held[-1].num_rows
            if size >= block:
                yield made()
                held, size = [], 0
    if size:
        yield made()


def filled(vectors: pa.Array, width: int) -> np.ndarray:
    x = np.zeros((len(vectors), width), np.int64)
    x[np.arange(width) < np.diff(np.asarray(vectors.offsets))[:, None]] = np.asarray(vectors.flatten())
    return x


def top_k(vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product with each query row; ties to smaller ids.

    `is_query` marks the query rows, by columns of `vectors`. A query never meets rows of
    its own id. Rows with a null id or a vector that is null or holds null, NaN or an
    infinity take no part; of vectors of different length the shorter counts as filled up
    with zeros. A candidate row that is repeated counts each time; a query row that is
    repeated is answered once. With fewer than k candidates all are returned; an empty
    table gives no rows. Scores are exact; one beyond a long counts as the nearest long.

    Candidates are not moved: one group of about `queries` queries at a time is broadcast to them.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, vector), "vectors")
    asked = stored(usable(vectors.filter(is_query), key, vector).distinct().withColumn("h", F.xxhash64("id", "x")), "queries")
    width = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 0)
    groups = max(1, -(-asked.count() // queries))
    kind = rows.schema["id"].dataType.simpleString()
    found = None
    for g in range(groups):
        given = asked.filter(F.pmod("h", F.lit(groups)) == g).toArrow().combine_chunks()
        columns = [given.column(n).combine_chunks() for n in ("id", "x", "h")]
        group = spark.sparkContext.broadcast((np.asarray(columns[0]), filled(columns[1], width), np.asarray(columns[2])))

        def search(batches: Iterable[pa.RecordBatch], group=group) -> Iterator[pa.RecordBatch]:
            ids, q, h = group.value
            best: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)
            for own in _lists(batches, width, block):
                out = []
                for i in range(len(ids)):
                    at, scores, _ = own.best(ids[i], q[i], k, int(best[i][0]) if len(best[i]) == k else None)
                    best[i] = np.sort(np.concatenate([best[i], scores]))[-k:]
                    out.append((np.full(len(at), ids[i]), np.full(len(at), h[i]), own.ids[at], scores))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "h", "vec_id", "score"])

        part = rows.select("id", "x").mapInArrow(search, f"query_id {kind}, h bigint, vec_id {kind}, score bigint")
        order = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        part = stored(part, "top") if groups > 1 else part
        found = part if found is None else found.unionByName(part)
    return found
