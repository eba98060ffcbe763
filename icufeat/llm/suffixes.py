"""Repeated byte strings removed, by a sparse suffix array sorted deep and shallow.

Sorting every suffix of a corpus would move it many times over. Any `LENGTH` bytes hold an
anchor, though: a place whose next `GRAM` bytes have the least hash of all places nearby.
Equal strings have their anchors at equal places, so only suffixes that start at anchors
are sorted, one in about 35.

An anchor's context is the bytes around it that a string of `LENGTH` bytes with that anchor
can hold. Anchors with equal contexts are decided by which comes first. The different
contexts of one gram are ordered by suffix: multikey quicksort takes them apart to a
shallow depth, blind tries order what is still equal there. Along the order, common
prefixes give the groups that agree `r` bytes on, and the same order backwards tells how
many bytes before the anchor an earlier member has in common; if both make `LENGTH`, those
bytes go. Grams with very many contexts are taken apart by the strings themselves instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, join_facts, stored
from icufeat.llm.jaccard import BASE, BASE_INVERSE, mixed, powers

#: A string that counts as repeated, and the bytes of an anchor's gram.
LENGTH, GRAM = 100, 24
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 40
#: One task orders the contexts of a gram if they are this many at most, and this part of all contexts.
CONTEXTS, PART = 32_768, 100
#: Strings of a gram with more contexts are compared by cores of so many neighbours first.
STEP = 20
#: Anchors that a task compares before they are sent, and bytes of text it looks at together.
ANCHORS, BYTES = 500_000, 1 << 19


def slid(x: np.ndarray, width: int, best: Callable) -> np.ndarray:
    """The least or greatest of every `width` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        x = best(x[:-reach], x[reach:])
        reach *= 2
    return best(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def anchors(data: np.ndarray, edges: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, text number, hash of the gram, hash of the context, bytes of it before and from the anchor), part by part.

    `data` holds texts one after the other, `edges` where they start and end.
    """
    width, margin = length - gram + 1, 2 * length
    with np.errstate(over="ignore"):
        for core in range(0, len(data), BYTES):
            low, high = max(0, core - margin), min(len(data), core + BYTES + margin)
            part = data[low:high]
            n = len(part)
            if n < length:
                continue
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
            back = powers(BASE_INVERSE, n)
            grams = mixed((sums[gram:] - sums[:-gram]) * back[: n - gram + 1]) | np.uint64(1)
            number = np.searchsorted(edges, np.arange(low, high), "right") - 1
            least = np.where(number[: n - length + 1] == number[length - 1 :], slid(grams, width, np.minimum), np.uint64(0))
            pad = np.zeros(width - 1, np.uint64)
            chosen = np.flatnonzero(slid(np.concatenate([pad, least, pad]), width, np.maximum) == grams)
            chosen = chosen[(chosen + low >= core) & (chosen + low < core + BYTES)]
            doc = number[chosen]
            before = np.minimum(width - 1, chosen + low - edges[doc])
            after = np.minimum(length, edges[doc + 1] - chosen - low)
            first = chosen - before
            context = (sums[chosen + after] - sums[first]) * back[first]
            context += before.astype(np.uint64) * np.uint64(BASE) + after.astype(np.uint64) * np.uint64(BASE_INVERSE)
            yield chosen + low - edges[doc], doc, grams[chosen].view(np.int64), mixed(context).view(np.int64), before, after


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """How many first bytes two strings share, of which `start` are known."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[start:n], "little") ^ int.from_bytes(b[start:n], "little")
    return start + ((x & -x).bit_length() - 1) // 8 if x else n


def blind_trie(texts: list[bytes], rows: list[int], depth: int) -> list[int]:
    """`rows` in the order of their texts, which agree on `depth` bytes.

    A node knows only the place at which its texts part and the byte each child has there
    (-1: the text ends). A text goes down blindly to some leaf, is compared with that one
    text, and is put where the two part.
    """
    root: list | None = None
    for row in rows:
        text = texts[row]
        if root is None:
            root = [None, [row]]
            continue
        node = root
        while node[0] is not None:
            own = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(own) or next(iter(node[1].values()))
        other = texts[node[1][0]]
        at = common(text, other, depth)
        if at == len(text) == len(other):
            node[1].append(row)
            continue
        parent, own = None, -1
        node = root
        while node[0] is not None and node[0] < at:
            parent, own = node, text[node[0]]
            node = node[1][own]
        mine = text[at] if at < len(text) else -1
        if node[0] == at:
            node[1][mine] = [None, [row]]
            continue
        fork = [at, {mine: [None, [row]], (other[at] if at < len(other) else -1): node}]
        if parent is None:
            root = fork
        else:
            parent[1][own] = fork
    out: list[int] = []
    open_ = [root] if root else []
    while open_:
        node = open_.pop()
        if node[0] is None:
            out += node[1]
        else:
            open_ += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def deep_shallow(texts: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Numbers of the texts in their order: multikey quicksort by eight bytes at a time to `shallow`, blind tries below."""
    out: list[int] = []
    open_ = [(list(range(len(texts))), 0)]
    while open_:
        rows, depth = open_.pop()
        if len(rows) < 2:
            out += rows
        elif depth >= shallow:
            out += blind_trie(texts, rows, depth)
        else:
            keys = [texts[r][depth : depth + 8] for r in rows]
            pivot = keys[len(keys) // 2]
            less = [r for r, k in zip(rows, keys, strict=True) if k < pivot]
            same = [r for r, k in zip(rows, keys, strict=True) if k == pivot]
            more = [r for r, k in zip(rows, keys, strict=True) if k > pivot]
            open_ += [(more, depth), (same, depth + 8 if len(pivot) == 8 else shallow), (less, depth)]
    return out


def repeats(before: list[bytes], after: list[bytes], place: list[tuple[int, int]], length: int, shallow: int = SHALLOW) -> Iterator[tuple[int, int, int]]:
    """(number, bytes before the anchor, bytes from it) that a context shares with an earlier one, if they make `length`.

    `before` is written backwards, `place` orders the anchors: document and offset.
    """
    order = deep_shallow(after, shallow)
    shared = [0, *[common(after[a], after[b]) for a, b in zip(order[:-1], order[1:], strict=True)], 0]
    backwards = deep_shallow(before, shallow)
    rank = {row: i for i, row in enumerate(backwards)}
    step = [0, *[common(before[a], before[b]) for a, b in zip(backwards[:-1], backwards[1:], strict=True)]]
    most = max(map(len, before))

    def inside(rows: list[int], r: int) -> Iterator[tuple[int, int, int]]:
        """In the backward order the nearest earlier members on either side share most."""
        rows = sorted(rows, key=rank.__getitem__)
        gaps = [min(step[rank[a] + 1 : rank[b] + 1]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
        best = dict.fromkeys(rows, -1)
        for line, between in ((rows, gaps), (rows[::-1], gaps[::-1])):
            held: list[list] = []  # rising places; with each, what it shares with the one after it in the line
            for i, row in enumerate(line):
                if held:
                    held[-1][1] = min(held[-1][1], between[i - 1])
                while held and place[held[-1][0]] >= place[row]:
                    _, run = held.pop()
                    if held:
                        held[-1][1] = min(held[-1][1], run)
                if held:
                    best[row] = max(best[row], held[-1][1])
                held.append([row, most])
        for row, l in best.items():
            if l >= 0 and l + r >= length:
                yield row, l, r

    # Groups of neighbours that share r bytes, from the stretches of the common prefixes.
    starts: list[tuple[int, int]] = []
    for i in range(1, len(shared)):
        start = i - 1
        while starts and starts[-1][1] > shared[i]:
            start, r = starts.pop()
            if r + most >= length:
                yield from inside(order[start:i], r)
        if shared[i] and (not starts or starts[-1][1] < shared[i]):
            starts.append((start, shared[i]))


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("h"), whole.alias("text"))


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of anchors (gram, context, doc, h, place) and of spans that a task has settled itself (context is null, place to `to`).

    A place is the offset, the bytes before the anchor and the bytes from it, seven bits each.
    """
    names = ["gram", "context", "doc", "h", "place", "to"]

    def settle(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        gram_, context, doc, h, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((h, place, doc, context, gram_))
        gram_, context, doc, h, place = (c[order] for c in (gram_, context, doc, h, place))
        new = np.concatenate([[True], (gram_[1:] != gram_[:-1]) | (context[1:] != context[:-1])])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (doc != doc[first]) | (place != place[first])
        again = ~new & (doc == np.roll(doc, 1)) & (place == np.roll(place, 1)) & (h == np.roll(h, 1))
        stay = ~later & ~again
        n = int(stay.sum())
        yield pa.RecordBatch.from_arrays([pa.array(c[stay]) for c in (gram_, context, doc, h, place)] + [pa.nulls(n, pa.int64())], names)
        # Spans of one text that touch go as one.
        doc, h, place = doc[later], h[later], place[later]
        low, high = (place >> 14) - (place >> 7 & 127), (place >> 14) + (place & 127)
        order = np.lexsort((low, h, doc))
        doc, h, low, high = (c[order] for c in (doc, h, low, high))
        if len(doc):
            # All contexts of a text reach about as far, so the highest end so far is that of the last span but for text ends.
            cut = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (low[1:] > high[:-1])])
            start = np.flatnonzero(cut)
            arrays = [h[start], doc[start], h[start], low[start], np.maximum.reduceat(high, start)]
            g, d, k, f, t = map(pa.array, arrays)
            yield pa.RecordBatch.from_arrays([g, pa.nulls(len(start), pa.int64()), d, k, f, t], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for part in in_slices(batches):
            doc, h = (np.asarray(part.column(i)) for i in range(2))
            texts = part.column(2)
            edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
            for place, i, gram_, context, before, after in anchors(data, edges - edges[0], length, gram):
                held.append((gram_, context, doc[i], h[i], place << 14 | before << 7 | after))
                size += len(i)
                if size >= ANCHORS:
                    yield from settle(held)
                    held, size = [], 0
        if size:
            yield from settle(held)

    # A text too short for a string has no part in this.
    long_enough = docs.filter(F.col("doc").isNotNull() & (F.octet_length("text") >= length))
    return long_enough.mapInArrow(run, "gram bigint, context bigint, doc bigint, h bigint, place bigint, to bigint")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, for a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3).compress
        for part in in_slices(batches):
            blobs = pa.array([small(t.as_buffer()) for t in part.column(2).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), blobs], ["doc", "h", "blob"])

    return docs.mapInArrow(run, "doc bigint, h bigint, blob binary")


def _contexts(open_: DataFrame, packed: DataFrame) -> DataFrame:
    """(gram, many, doc, h, place, before, after): the bytes around the open anchors, those before written backwards."""
    wanted = open_.groupBy("doc", "h").agg(F.collect_list(F.struct("gram", "place", "many")).alias("at"))
    names = ["gram", "many", "doc", "h", "place", "before", "after"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            lists = part.column(3)
            each = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(lists.offsets)))
            grams, places, many = (lists.flatten().field(i) for i in range(3))
            place = np.asarray(places)
            offset, left, right = place >> 14, place >> 7 & 127, place & 127
            before, after, last, raw = [], [], -1, b""
            for i, o, l, r in zip(each.tolist(), offset.tolist(), left.tolist(), right.tolist(), strict=True):
                if i != last:
                    last, raw = i, zstandard.ZstdDecompressor().decompress(part.column(2)[i].as_py())
                before.append(raw[o - l : o][::-1])
                after.append(raw[o : o + r])
            doc, h = (pa.array(np.asarray(part.column(i))[each]) for i in range(2))
            yield pa.RecordBatch.from_arrays([grams, many, doc, h, places, pa.array(before, pa.binary()), pa.array(after, pa.binary())], names)

    return packed.join(wanted, ["doc", "h"]).select("doc", "h", "blob", "at").mapInArrow(run, "gram bigint, many boolean, doc bigint, h bigint, place bigint, before binary, after binary")


def _sorted_spans(contexts: DataFrame, length: int, shallow: int) -> DataFrame:
    """(doc, h, from, to) by ordering the contexts of each gram."""

    def group(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        classes: dict[tuple[bytes, bytes], tuple[int, int]] = {}
        for doc, _, place, before, after in rows:
            own = (doc, place >> 14)
            classes[before, after] = min(classes.get((before, after), own), own)
        before, after = (list(c) for c in zip(*classes, strict=True))
        reach: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
        for i, l, r in repeats(before, after, list(classes.values()), length, shallow):
            reach.setdefault((before[i], after[i]), []).append((l, r))
        for doc, h, place, b, a in rows:
            at = place >> 14
            later = (doc, at) > classes[b, a]
            for l, r in [(len(b), len(a))] if later else reach.get((b, a), ()):
                yield doc, h, at - l, at + r

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(spans: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*spans, strict=True)], ["doc", "h", "from", "to"])

        rows: list[tuple] = []
        spans: list[tuple] = []
        last = None
        for part in in_slices(batches, 4_096):
            grams, *columns = (part.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6))
            for gram, *row in zip(grams, *columns, strict=True):
                if gram != last:
                    if len(rows) > 1:
                        spans += group(rows)
                    rows, last = [], gram
                rows.append(tuple(row))
            if len(spans) >= 10_000:
                yield batch(spans)
                spans = []
        if len(rows) > 1:
            spans += group(rows)
        if spans:
            yield batch(spans)

    ordered = contexts.repartition("gram").sortWithinPartitions("gram")
    return ordered.mapInArrow(run, "doc bigint, h bigint, from bigint, to bigint")


def _told(rows: DataFrame, key: str, first: Column) -> DataFrame:
    """`rows` whose key comes more than once, with the least `first` of the key."""
    rows = stored(rows, key)
    facts = stored(rows.groupBy(key).agg(F.min(first).alias("first"), F.count("*").alias("rows")).filter("rows > 1"), f"{key}-facts")
    return join_facts(rows, facts, key, "rows", rows.count(), F.xxhash64("doc", "h", "block")).filter(F.col("first").isNotNull())


def _single_strings(contexts: DataFrame, length: int) -> DataFrame:
    """(doc, h, from, to) by every string of the contexts: for grams with more contexts than one task should order.

    Strings that start within STEP bytes of each other have a core in common. Where the core
    does not come twice, none of them does, so only the others are taken one by one.
    """

    def cores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            out: list[tuple] = []
            for doc, h, place, before, after in zip(*(part.column(i).to_pylist() for i in (2, 3, 4, 5, 6)), strict=True):
                whole, n, at = before[::-1] + after, len(before), place >> 14
                low = max(0, length - len(after))
                for block in range(low // STEP, n // STEP + 1):
                    first, last = block * STEP, block * STEP + STEP - 1
                    core = hashlib.blake2b(whole[n - first : n - last + length], digest_size=15, person=b"%d" % block).hexdigest()
                    head = min(n, last)
                    out.append((core, doc, h, block, at - head, whole[n - head : n - max(low, first) + length]))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["core", "doc", "h", "block", "from", "bytes"])

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            out: list[tuple] = []
            for doc, h, block, at, whole in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                for i in range(len(whole) - length + 1):
                    out.append((hashlib.blake2b(whole[i : i + length], digest_size=16).hexdigest(), doc, h, block, at + i))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["string", "doc", "h", "block", "from"])

    start = F.struct("doc", "from")
    parts = contexts.mapInArrow(cores, "core string, doc bigint, h bigint, block int, from bigint, bytes binary")
    again = _told(parts, "core", start).select("doc", "h", "block", "from", "bytes")
    singles = _told(again.mapInArrow(strings, "string string, doc bigint, h bigint, block int, from bigint"), "string", start)
    return singles.filter(start > F.col("first")).select("doc", "h", "from", (F.col("from") + length).alias("to"))


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW, contexts: int = CONTEXTS
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row: the text without bytes that repeat earlier ones.

    A byte goes if it lies in `length` bytes (128 - gram at most) that also start at a
    smaller key, or at a smaller offset under the same key. Texts count as UTF-8, a null
    one as empty; matches stay within a text. Rows that share a key are one document, whose
    strings start where they start in any of them; so repeated rows get the same result.
    A row without a key stays whole and takes nothing from others. An empty table gives
    no rows. Keys are whole numbers.

    `gram`, `shallow` and `contexts` set how the work is done, not the result. Grams and
    contexts are known by two 64-bit hashes, a text under its key by one.
    """
    given = _identified(docs, key, text)
    by_context = Window.partitionBy("gram", "context").orderBy("doc", "place")
    by_gram = Window.partitionBy("gram")
    marked = (
        _anchored(given, length, gram)
        .repartition("gram")
        .withColumn("rank", F.rank().over(by_context))
        .withColumn("different", F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).over(by_gram))
        .select("gram", "context", "doc", "h", "place", "to", (F.col("rank") > 1).alias("later"), "different")
    )
    settled = F.col("context").isNull()
    low = F.shiftright("place", 14) - F.shiftright("place", 7).bitwiseAND(F.lit(127))
    high = F.shiftright("place", 14) + F.col("place").bitwiseAND(F.lit(127))
    known = stored(
        marked.filter(settled | F.col("later") | (F.col("different") > 1)).select(
            F.when(~settled & ~F.col("later"), F.col("gram")).alias("gram"),
            "doc",
            "h",
            F.when(~settled & ~F.col("later"), F.col("place")).alias("place"),
            F.when(settled, F.col("place")).when(F.col("later"), low).alias("from"),
            F.when(settled, F.col("to")).when(F.col("later"), high).alias("to"),
            "different",
        ),
        "anchors",
    )
    open_ = known.filter(F.col("gram").isNotNull())
    limit = min(contexts, open_.count() // PART + 1)
    open_ = open_.withColumn("many", F.col("different") > limit)
    packed = _packed(given)
    around = stored(_contexts(open_, packed), "contexts")
    spans = (
        known.filter(F.col("gram").isNull())
        .select("doc", "h", "from", "to")
        .unionByName(_sorted_spans(around.filter("NOT many"), length, shallow))
        .unionByName(_single_strings(around.filter("many"), length))
    )
    gone = spans.groupBy("doc", "h").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    schema = T.StructType([
        T.StructField("doc", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
        T.StructField("kept", T.BinaryType()),
    ])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            rows = []
            for blob, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                raw = zstandard.ZstdDecompressor().decompress(blob)
                kept, at, removed, runs = [], 0, 0, 0
                end = -1
                for low, high in sorted((s["from"], s["to"]) for s in spans or ()):
                    if low > end:
                        runs += 1
                        kept.append(raw[at:low])
                        end = low
                    if high > end:
                        removed += high - end
                        end = at = high
                kept.append(raw[at:])
                rows.append((len(raw), removed, runs, b"".join(kept)))
            n, m, r, kept = zip(*rows, strict=True)
            arrays = [part.column(0), *[pa.array(c, pa.int64()) for c in (n, m, r)], pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    whole = packed.join(gone, ["doc", "h"], "left").select("doc", "blob", "spans")
    return whole.mapInArrow(cut, schema).withColumnRenamed("doc", key)
