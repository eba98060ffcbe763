"""Tokens of two tokenizers aligned by the bytes they end at, with corpus-wide counts of the pairs.

Each text is encoded twice. Where tokens of both sides end at the same byte, they are linked,
and the text is cut into groups. How often two ids are linked over all texts needs the whole
corpus, by external counting:

1. A task gathers (pair, document) records, sorts them, cuts them by the remainder of the
   second side's id and writes each cut as a run compressed with zstd to the shared folder.
2. Runs are merged k at a time by a heap over the heads of their chunks until one list per
   cut is left, which counts each pair. It is ordered by the second side's id, so the
   greatest count of an id is known as soon as its pairs have passed.
3. The records of the runs pass the counts of their cut in the same order, and what each
   document gets from them goes back as one sum per run and cut.

Runs of one cut go to many tasks, so a pair that most texts hold burdens none of them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, stored

#: Links of a run, and documents of a run at most.
RECORDS, DOCUMENTS = 1_000_000, 1 << 18
#: Cuts by the second side's id, runs merged at a time, and pairs of a chunk.
CUTS, FAN, CHUNK = 32, 16, 1 << 17

#: Fixed value: how the byte-level vocabulary's tokenizer splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_signs() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte: its own Latin-1 sign, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and what names tokens in a digest."""

    def __init__(self, byte_file: str, piece_file: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        with open(byte_file, encoding="utf-8") as f:
            given = json.load(f)
        signs = byte_signs()
        specials = {t["content"] for t in given["added_tokens"] if t["special"]}
        ids = {t: i for t, i in given["model"]["vocab"].items() if t not in specials}
        joined = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in given["model"]["merges"]]
        # Merging by id is merging by rank if the ids of the merges rise.
        if given["normalizer"] or given["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or joined != sorted(joined):
            raise ValueError("only byte-level vocabularies in the order of their merges are supported")
        left = {i: bytes(signs[c] for c in t) for t, i in ids.items()}
        self.bytes_a = [left.get(i, b"") for i in range(max(left) + 1)]
        self.encode_a = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks={b: i for i, b in left.items()}, special_tokens={}).encode_ordinary

        pieces = SentencePieceProcessor(model_file=piece_file)
        self.bytes_b = [
            bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i)
            else b"" if pieces.is_control(i)
            else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in range(pieces.get_piece_size())
        ]
        self.encode_b = pieces.encode
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # The names of a digest: within a group tokens end with a comma, the last one of a side with its mark.
        self.names = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.names += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]
        self.bits_a, self.bits_b = len(self.bytes_a).bit_length(), len(self.bytes_b).bit_length()

    def align(self, text: str | None) -> tuple[int, int, np.ndarray, np.ndarray, str]:
        """(tokens of A, of B, linked ids of A, linked ids of B, digest of the groups)."""
        none = np.empty(0, np.int64)
        if not text:
            return 0, 0, none, none, ""
        whole = " " + text
        raw = whole.encode()
        ids_a, ids_b = self.encode_a(whole), self.encode_b(text)
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw or b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw:
            return 0, 0, none, none, ""
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.zeros(len(raw) + 1, np.int8)
        at[ends_a] = 1
        at[ends_b] += 2
        last_a, last_b = at[ends_a] == 3, at[ends_b] == 3
        place_a, place_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        # Where a token stands in the digest: after the tokens before it on its own side and those of the other side's groups.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], place_b + 1])[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + place_a[group_b] + 1] = 2 * len(self.bytes_a) + 2 * b + last_b
        named = "".join(map(self.names.__getitem__, order.tolist()))
        return len(a), len(b), a[place_a], b[place_b], hashlib.sha256(named[:-1].encode()).hexdigest()


@lru_cache(maxsize=2)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    """One per pair of files and Python worker."""
    return Aligner(byte_file, piece_file)


def pack(*columns: np.ndarray) -> bytes:
    """Arrays, each with its type and length, compressed."""
    head = json.dumps([(c.dtype.str, len(c)) for c in columns]).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(c.tobytes() for c in columns))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, n in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


@dataclass(frozen=True)
class Layout:
    """How a record is one whole number: cut, id of B, id of A, document of the run; so sorting is by the cut, then B first."""

    bits_a: int
    bits_b: int
    cuts: int

    DOC = DOCUMENTS.bit_length()

    def keys(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return ((((b % self.cuts) << self.bits_b | b) << self.bits_a | a) << self.DOC) | doc

    def pair(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.DOC) & ((1 << (self.bits_a + self.bits_b)) - 1)

    def cut(self, keys: np.ndarray) -> np.ndarray:
        return keys >> (self.DOC + self.bits_a + self.bits_b)


def runs_of(keys: np.ndarray, layout: Layout) -> Iterator[tuple[int, bytes, bytes]]:
    """(cut, pairs with their numbers, records) of a run, from the keys of its links in any order.

    A record is a document of a pair, as the step from the record before, and how often
    the document has the pair.
    """
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    times = np.diff(first, append=len(keys))
    keys = keys[first]
    cuts = layout.cut(keys)
    edges = np.searchsorted(cuts, np.arange(layout.cuts + 1))
    for c in np.unique(cuts).tolist():
        part = slice(edges[c], edges[c + 1])
        pairs, n = layout.pair(keys[part]), times[part]
        head = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        doc = (keys[part] & ((1 << layout.DOC) - 1)).astype(np.int32)
        yield (
            c,
            pack(np.diff(pairs[head], prepend=0), np.add.reduceat(n, head)),
            pack(np.diff(head, append=len(pairs)).astype(np.int32), np.diff(doc, prepend=np.int32(0)), n.astype(np.int32)),
        )


def merged(runs: Sequence[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sum of sorted lists of (pairs, numbers), chunk by chunk, in order and without repeats.

    A heap holds the last pair of each list's chunk. Up to the least of them all lists are
    known, so that much is summed up and handed on.
    """
    heads: list[tuple[np.ndarray, np.ndarray] | None] = []
    heap: list[tuple[int, int]] = []

    def load(i: int) -> None:
        heads[i] = next((c for c in runs[i] if len(c[0])), None)
        if heads[i] is not None:
            heapq.heappush(heap, (int(heads[i][0][-1]), i))

    for i in range(len(runs)):
        heads.append(None)
        load(i)
    while heap:
        limit = heap[0][0]
        pairs, numbers = [], []
        for i, head in enumerate(heads):
            if head is not None:
                to = int(np.searchsorted(head[0], limit, "right"))
                pairs.append(head[0][:to])
                numbers.append(head[1][:to])
                heads[i] = (head[0][to:], head[1][to:])
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])
        every, number = np.concatenate(pairs), np.concatenate(numbers)
        order = np.argsort(every, kind="stable")
        every, number = every[order], number[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        yield every[first], np.add.reduceat(number, first)


def with_best(counts: Iterable[tuple[np.ndarray, np.ndarray]], bits_a: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, numbers, whether none of the same B id has a greater number), from counts in order of the B id.

    The pairs of the last B id of a chunk wait for the next chunk.
    """
    held_pairs, held_numbers = np.empty(0, np.int64), np.empty(0, np.int64)

    def done(pairs: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = pairs >> bits_a
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        most = np.repeat(np.maximum.reduceat(numbers, first), np.diff(first, append=len(ids)))
        return pairs, numbers, numbers == most

    for pairs, numbers in counts:
        pairs, numbers = np.concatenate([held_pairs, pairs]), np.concatenate([held_numbers, numbers])
        to = int(np.searchsorted(pairs >> bits_a, pairs[-1] >> bits_a))
        held_pairs, held_numbers = pairs[to:], numbers[to:]
        if to:
            yield done(pairs[:to], numbers[:to])
    if len(held_pairs):
        yield done(held_pairs, held_numbers)


def _chunked(counts: Iterable[tuple[np.ndarray, ...]], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The same columns in chunks of about `size` pairs."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for c in counts:
        held.append(c)
        n += len(c[0])
        if n >= size:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            for at in range(0, n, size):
                yield tuple(x[at : at + size] for x in columns)
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _lists(table: pa.Table) -> list[Iterator[tuple[np.ndarray, np.ndarray]]]:
    """One iterator per run of the table over its chunks, which stay compressed until they are reached."""
    by_run: dict[int, list[tuple[int, int]]] = {}
    for row, (run, chunk) in enumerate(zip(table["run"].to_pylist(), table["chunk"].to_pylist(), strict=True)):
        by_run.setdefault(run, []).append((chunk, row))

    def chunks(rows: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, row in sorted(rows):
            steps, numbers = unpack(table["pairs"][row].as_py())
            yield np.cumsum(steps), numbers

    return [chunks(rows) for _, rows in sorted(by_run.items())]


def _encoded(docs: DataFrame, byte_file: str, piece_file: str, key: str, text: str, cuts: int, records: int) -> DataFrame:
    """Rows of documents (cut is null) and rows of runs, by run."""
    given = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("run", T.LongType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("key", given),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_links")],
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("cut", T.IntegerType()),
        T.StructField("pairs", T.BinaryType()),
        T.StructField("records", T.BinaryType()),
    ])
    kinds = [pa.int64(), pa.int32(), None, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_file, piece_file)
        layout = Layout(own.bits_a, own.bits_b, cuts)
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        names: list[pa.Array] = []
        keys: list[np.ndarray] = []
        size = 0

        def finished() -> Iterator[pa.RecordBatch]:
            n = len(rows)
            columns = list(zip(*rows, strict=True))
            nothing = [None] * n
            arrays = [pa.array([number] * n, kinds[0]), pa.array(range(n), kinds[1]), pa.concat_arrays(names)]
            arrays += [pa.array(c, k) for c, k in zip([*columns, nothing, nothing, nothing], kinds[3:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)
            cut = list(runs_of(np.concatenate(keys) if keys else np.empty(0, np.int64), layout))
            if cut:
                c, pairs, records_ = zip(*cut, strict=True)
                m = len(cut)
                arrays = [pa.array([number] * m, kinds[0]), pa.nulls(m, kinds[1]), pa.nulls(m, names[0].type), *[pa.nulls(m, k) for k in kinds[3:7]]]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(c, kinds[7]), pa.array(pairs, kinds[8]), pa.array(records_, kinds[9])], schema.names)

        for part in in_slices(batches, 64):
            for i, t in enumerate(part.column(1).to_pylist()):
                n_a, n_b, a, b, digest = own.align(t)
                keys.append(layout.keys(a, b, np.full(len(a), len(rows), np.int64)))
                rows.append((n_a, n_b, len(a), digest))
                names.append(part.column(0).slice(i, 1))
                size += len(a)
                if size >= records or len(rows) >= DOCUMENTS:
                    yield from finished()
                    number, rows, names, keys, size = number + 1, [], [], [], 0
        if rows:
            yield from finished()

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def align_tokens(
    docs: DataFrame, byte_file: str, piece_file: str, *, key: str = "doc_id", text: str = "text", cuts: int = CUTS, records: int = RECORDS, fan: int = FAN, chunk: int = CHUNK
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A is the byte-level vocabulary and reads the text after a space, B the piece
    vocabulary, which puts that space in front itself; special tokens are plain text. A
    text that is null or empty, or whose bytes either side does not give back, has no
    tokens: zeros and an empty digest. Repeated rows each count, as do rows without a key;
    an empty table gives no rows. The files have to lie at these places on every machine.

    `cuts`, `records`, `fan` and `chunk` set the sizes of runs and merges, not the result.
    """
    out = stored(_encoded(docs, byte_file, piece_file, key, text, cuts, records), "runs")
    own = aligner(byte_file, piece_file)
    bits_a = own.bits_a
    given = out.filter("cut IS NOT NULL")
    runs = given.select("run").distinct().count()

    def slot(column: str, slots: int):
        return F.pmod(F.xxhash64(column), F.lit(slots)).cast("int")

    lists = given.select("cut", "run", F.lit(0).alias("chunk"), "pairs")
    left = runs
    while left > fan:
        slots = -(-left // fan)

        def merge(key: tuple, table: pa.Table) -> pa.Table:
            rows = [
                (key[0].as_py(), key[1].as_py(), i, pack(np.diff(p, prepend=0), n))
                for i, (p, n) in enumerate(_chunked(merged(_lists(table)), chunk))
            ]
            return pa.table(dict(zip(("cut", "run", "chunk", "pairs"), map(list, zip(*rows, strict=True)), strict=True)), pa.schema(MERGED))

        lists = stored(lists.withColumn("slot", slot("run", slots)).groupBy("cut", "slot").applyInArrow(merge, "cut int, run bigint, chunk int, pairs binary"), "merged")
        left = slots

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        found = _chunked(with_best(merged(_lists(table)), bits_a), chunk)
        rows = [(key[0].as_py(), i, pack(p, n, best)) for i, (p, n, best) in enumerate(found)]
        return pa.table(dict(zip(("cut", "chunk", "counts"), map(list, zip(*rows, strict=True)), strict=True)), pa.schema(COUNTS))

    counts = stored(lists.groupBy("cut").applyInArrow(settle, "cut int, chunk int, counts binary"), "counts")

    # Records meet the counts of their cut; the counts are copied once for every `fan` runs.
    slots = max(1, -(-runs // fan))
    asking = given.select("cut", "run", "pairs", "records", slot("run", slots).alias("slot"))
    telling = counts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def contribute(records: pa.Table, counts: pa.Table) -> pa.Table:
        open_ = []
        for row in range(records.num_rows):
            steps, _ = unpack(records["pairs"][row].as_py())
            sizes, docs_, times = unpack(records["records"][row].as_py())
            doc = np.cumsum(docs_)
            n = int(doc.max(initial=-1)) + 1
            edges = np.concatenate([[0], np.cumsum(sizes)])
            open_.append((records["run"][row].as_py(), np.cumsum(steps), edges, doc, times, np.zeros(n, np.int64), np.zeros(n, np.int64)))
        order = np.argsort(np.asarray(counts["chunk"].to_pylist(), np.int64))
        for i in order.tolist():
            pairs, numbers, best = unpack(counts["counts"][i].as_py())
            for _, own_pairs, edges, doc, times, most, total in open_:
                low, high = np.searchsorted(own_pairs, [pairs[0], pairs[-1] + 1])
                at = np.searchsorted(pairs, own_pairs[low:high])
                part = slice(edges[low], edges[high])
                sizes = np.diff(edges[low : high + 1])
                d, t = doc[part], times[part].astype(np.int64)
                np.add.at(most, d, t * np.repeat(best[at], sizes))
                np.add.at(total, d, t * np.repeat(numbers[at], sizes))
        rows = [(r[0], pack(r[5], r[6])) for r in open_]
        return pa.table({"run": [r[0] for r in rows], "sums": [r[1] for r in rows]}, pa.schema(SUMS))

    sums = asking.groupBy("cut", "slot").cogroup(telling.groupBy("cut", "slot")).applyInArrow(contribute, "run bigint, sums binary")
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType()),
    ])

    def add_up(rows: pa.Table, sums: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        most, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for blob in sums["sums"]:
            m, t = unpack(blob.as_py())
            most[: len(m)] += m
            total[: len(t)] += t
        columns = [rows["key"], rows["n_a"], rows["n_b"], rows["n_links"], rows["n_links"], pa.array(most), pa.array(total), rows["groups_sha256"]]
        return pa.Table.from_arrays(columns, schema.names)

    texts = out.filter("cut IS NULL").select("run", "place", "key", "n_a", "n_b", "n_links", "groups_sha256")
    return texts.groupBy("run").cogroup(sums.groupBy("run")).applyInArrow(add_up, schema)


MERGED = [("cut", pa.int32()), ("run", pa.int64()), ("chunk", pa.int32()), ("pairs", pa.binary())]
COUNTS = [("cut", pa.int32()), ("chunk", pa.int32()), ("counts", pa.binary())]
SUMS = [("run", pa.int64()), ("sums", pa.binary())]
