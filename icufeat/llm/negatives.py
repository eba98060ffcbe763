"""Hard negatives by exact integer scores from a residue-number system.

A float32 matrix product is exact as long as its sums stay below 2^24. Components are
therefore taken modulo several small primes, one product is made per prime, and the signed
score is put together from its remainders by the Chinese remainder theorem. The primes are
chosen so that no sum passes 2^24 and their product passes twice the largest score.

Candidates stay where they lie, in blocks. Anchors come in groups of bounded size, each
group meets all blocks in two passes: the first finds every anchor's positives, the second
the different-label rows in the window that each positive's score opens. A block gives its
best few per anchor, a window over the blocks' answers the final ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icufeat.llm.common import stored
from icufeat.llm.topk import usable

#: Candidates scored together, and anchors of a group, of which TOGETHER at a time meet a block.
BLOCK, ANCHORS, TOGETHER = 4_096, 16_384, 256
#: Sums of float32 products are whole and exact up to here.
EXACT = 1 << 24


def primes_for(width: int, largest: int) -> list[int]:
    """Primes whose centred remainders keep sums over `width` products within float32, until scores of `largest` are told apart.

    `largest` bounds the size of a score. The primes are taken downwards from the
    greatest that fits.
    """
    top = 2 * int((EXACT / max(1, width)) ** 0.5) + 1
    if top < 3:
        raise ValueError(f"vectors of {width} components are too long for float32 sums")
    found: list[int] = []
    product = 1
    for p in range(top, 2, -1):
        if ((p - 1) // 2) ** 2 * width <= EXACT and all(p % d for d in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
            if product > 2 * largest:
                return found
    raise ValueError("not enough small primes for scores of this size")


def remainders(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """x modulo each prime as float32, centred around zero."""
    out = []
    for p in primes:
        r = (x % p).astype(np.int64)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The exact products of the matrices that `left` and the transposed `right` are remainders of.

    Mixed-radix digits are found prime by prime. The top digit is centred, which gives
    negative scores back; whole numbers of any size are used where a long would not do.
    """
    total = np.zeros((left[0].shape[0], right[0].shape[0]), np.int64)
    wide = int(np.prod([int(p) for p in primes], dtype=object))
    if wide > 1 << 62:
        total = total.astype(object)
    radix = 1
    for i, p in enumerate(primes):
        r = (left[i] @ right[i].T).astype(np.int64)
        digit = ((r - (total % p).astype(np.int64)) * pow(radix, -1, p)) % p
        total = total + digit.astype(total.dtype) * radix
        radix *= p
    return np.where(total > wide // 2, total - wide, total)


class Block:
    """Candidates of a block, or anchors of a group: ids, labels, components and their remainders."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, largest: int | None = None):
        self.ids, self.labels, self.x = ids, labels, x
        self.largest = max(abs(int(x.min(initial=0))), int(x.max(initial=0))) if largest is None else largest
        self._kept: tuple[tuple[int, ...], list[np.ndarray]] | None = None

    def remainders(self, primes: list[int]) -> list[np.ndarray]:
        if self._kept is None or self._kept[0] != tuple(primes):
            self._kept = (tuple(primes), remainders(self.x, primes))
        return self._kept[1]


def block_of(ids: pa.Array, labels: pa.Array, vectors: pa.Array, width: int) -> Block:
    """Vectors shorter than `width` are filled up with zeros."""
    x = np.zeros((len(ids), width), np.int64)
    sizes = np.diff(np.asarray(vectors.offsets))
    x[np.arange(width) < sizes[:, None]] = np.asarray(vectors.flatten())
    order = np.argsort(np.asarray(ids), kind="stable")
    # Labels of any type are told apart by their text.
    names = np.asarray(labels.cast(pa.string()).to_pylist(), object)
    return Block(np.asarray(ids)[order], names[order], x[order])


def all_scores(block: Block, group: Block) -> np.ndarray:
    """Score of every candidate of the block (rows) with every anchor of the group (columns), as the nearest long."""
    width = block.x.shape[1]
    primes = primes_for(width, width * block.largest * group.largest)
    found = scores(block.remainders(primes), group.remainders(primes), primes)
    if found.dtype == object:
        found = np.minimum(np.maximum(found, -(1 << 63)), (1 << 63) - 1).astype(np.int64)
    return found


def _blocks(batches: Iterable[pa.RecordBatch], width: int, rows: int) -> Iterator[Block]:
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        for at in range(0, b.num_rows, rows):
            held.append(b.slice(at, rows))
            size += held[-1].num_rows
            if size >= rows:
                t = pa.Table.from_batches(held).combine_chunks()
                yield block_of(*(t.column(i).chunk(0) for i in range(3)), width)
                held, size = [], 0
    if size:
        t = pa.Table.from_batches(held).combine_chunks()
        yield block_of(*(t.column(i).chunk(0) for i in range(3)), width)


def _parts(group: Block) -> Iterator[tuple[int, Block]]:
    for at in range(0, len(group.ids), TOGETHER):
        part = slice(at, at + TOGETHER)
        yield at, Block(group.ids[part], group.labels[part], group.x[part], group.largest)


def _answers(pieces: list[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The answers of a block as one batch."""
    if pieces:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*pieces, strict=True)], names)


def best_positives(block: Block, group: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor (number in the group): ids and scores of the block's k best other rows of its label."""
    for at, part in _parts(group):
        s = all_scores(block, part)
        for j in range(len(part.ids)):
            rows = np.flatnonzero((block.labels == part.labels[j]) & (block.ids != part.ids[j]))
            v = s[rows, j]
            if len(v) > 4 * k:
                at_least = np.partition(v, len(v) - k)[len(v) - k]
                rows = rows[v >= at_least]
                v = s[rows, j]
            best = np.lexsort((block.ids[rows], -v))[:k]
            if len(best):
                yield at + j, block.ids[rows[best]], v[best]


def best_negatives(
    block: Block, group: Block, bounds: list[list[tuple[int, int, int]]], k: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each of its windows (number, low, high): the window's number, ids and scores of the block's k best."""
    for at, part in _parts(group):
        s = all_scores(block, part)
        for j in range(len(part.ids)):
            windows = bounds[at + j]
            if not windows:
                continue
            low, high = min(w[1] for w in windows), max(w[2] for w in windows)
            v = s[:, j]
            rows = np.flatnonzero((v >= low) & (v <= high) & (block.labels != part.labels[j]))
            rows = rows[np.lexsort((block.ids[rows], -v[rows]))]
            down = -v[rows]
            for number, least, most in windows:
                first = int(np.searchsorted(down, -most, "left"))
                last = min(first + k, int(np.searchsorted(down, -least, "right")))
                if last > first:
                    yield at + j, number, block.ids[rows[first:last]], v[rows[first:last]]


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block: int = BLOCK,
    anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and each of its positives.

    `is_anchor` marks anchors, by columns of `vectors`. Components count as
    floor(256 * x); scores are inner products, higher ones first, ties by smaller id. An
    anchor's positives are its `positives` best rows of another id and the same label. The
    negatives of a positive are the `negatives` best rows of another label whose score is
    at least `low` and at most `high` per cent of the positive's; a positive with an empty
    window gives no rows.

    Rows with a null id or label, or a vector that is null or holds null, NaN or an
    infinity, take no part. A shorter vector counts as filled up with zeros. Repeated
    rows count each, as candidates and as positives; repeated anchors are answered once.
    An empty table gives no rows. Scores are exact; one beyond a long counts as the
    nearest long.

    Candidates are not moved: one group of at most about `anchors` anchors at a time is
    broadcast to them.
    """
    spark = vectors.sparkSession
    named = vectors.filter(F.col(label).isNotNull()).withColumn("__label", F.col(label))
    rows = stored(usable(named, key, vector, "__label"), "vectors")
    asked = usable(named.filter(is_anchor), key, vector, "__label").distinct()
    counted = rows.agg(F.max(F.size("x")).alias("width")).first()
    width = max(1, counted["width"] or 0)
    asked = stored(asked.withColumn("a", F.xxhash64("id", "x", "__label")), "anchors")
    groups = max(1, -(-asked.count() // anchors))
    group_of = F.pmod(F.col("a"), F.lit(groups))
    id_type = rows.schema["id"].dataType.simpleString()
    found = None
    for g in range(groups):
        given = asked.filter(group_of == g).orderBy("id", "a").toArrow().combine_chunks()
        if not given.num_rows:
            continue
        columns = [given.column(n).combine_chunks() for n in ("id", "__label", "x")]
        order = np.argsort(np.asarray(columns[0]), kind="stable")
        marks = np.asarray(given.column("a").combine_chunks())[order]
        group = spark.sparkContext.broadcast(block_of(*columns, width))

        def first_pass(batches: Iterable[pa.RecordBatch], group=group, marks=marks) -> Iterator[pa.RecordBatch]:
            for own in _blocks(batches, width, block):
                pieces = [
                    (np.full(len(ids), group.value.ids[j]), np.full(len(ids), marks[j]), ids, s)
                    for j, ids, s in best_positives(own, group.value, positives)
                ]
                yield from _answers(pieces, ["anchor_id", "a", "positive_id", "positive_score"])

        by_anchor = Window.partitionBy("anchor_id", "a").orderBy(F.desc("positive_score"), "positive_id")
        near = stored(
            rows.select("id", "__label", "x")
            .mapInArrow(first_pass, f"anchor_id {id_type}, a bigint, positive_id {id_type}, positive_score bigint")
            .withColumn("number", F.row_number().over(by_anchor))
            .filter(F.col("number") <= positives),
            "positives",
        )
        bounds: list[list[tuple[int, int, int]]] = [[] for _ in marks]
        place = {int(m): j for j, m in enumerate(marks)}
        for r in near.select("a", "number", "positive_score").toLocalIterator():
            least, most = window_of(r["positive_score"], low, high)
            if least <= most:
                bounds[place[r["a"]]].append((r["number"], least, most))
        windows = spark.sparkContext.broadcast(bounds)

        def second_pass(batches: Iterable[pa.RecordBatch], group=group, marks=marks, windows=windows) -> Iterator[pa.RecordBatch]:
            for own in _blocks(batches, width, block):
                pieces = [
                    (np.full(len(ids), marks[j]), np.full(len(ids), number, np.int32), ids, s)
                    for j, number, ids, s in best_negatives(own, group.value, windows.value, negatives)
                ]
                yield from _answers(pieces, ["a", "number", "negative_id", "negative_score"])

        by_pair = Window.partitionBy("a", "number").orderBy(F.desc("negative_score"), "negative_id")
        best = (
            rows.select("id", "__label", "x")
            .mapInArrow(second_pass, f"a bigint, number int, negative_id {id_type}, negative_score bigint")
            .withColumn("rank", F.row_number().over(by_pair))
            .filter(F.col("rank") <= negatives)
        )
        part = best.join(near, ["a", "number"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        part = stored(part, "negatives") if groups > 1 else part
        found = part if found is None else found.unionByName(part)
    if found is None:
        names = f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], names)
    return found
