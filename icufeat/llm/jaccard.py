"""Documents whose word n-gram sets overlap, joined exactly and grouped by links.

A set holds the different shingles of `words` words of a text, each by a 64-bit hash; equal
sets are one node of the graph. Two sets of Jaccard similarity t share a token among the first
|x| - ceil(t |x|) + 1 of any common token order, so inverted lists over these prefixes
find every pair. The order puts tokens that many texts share last, which keeps lists
short; it does not change the result.

Set relations keep the lists from being paired off:

* Answers. Each set is compared with one pivot of its lists first. A set linked to its
  pivot shares the pivot's group, and its answers are derived from those of the pivot:
  for another set x, the distances to the pivot decide for all members at once (Jaccard
  distance is a metric), except members whose own distance leaves it open.
* Lists. Entries are kept in blocks of equal size class and position class; a block whose
  remaining tokens cannot reach the overlap a link needs is skipped as a whole, and lists
  within one group are skipped altogether.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, join_facts, stored

#: Words of a shingle.
WORDS = 4
#: A link is 100 * common >= PERCENT * union.
PERCENT = 85
#: Tokens that the order knows to be frequent, at most: what is broadcast is bounded by it.
FREQUENT = 1 << 17
#: Tokens that a task counts at a time, and from which count on it reports one.
COUNTED, REPORTED = 2_000_000, 3
#: Sets that a task remembers, and bytes of text that it hashes at a time (one text at least).
REMEMBERED, HASHED = 100_000, 1 << 20

#: An odd base and its inverse modulo 2^64, and an odd mixing factor.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the bytes `data`, A-Z lower-cased, and the byte it starts at; no word spans one of `starts`."""
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts] |= inside[starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[starts[1:] - 1] |= inside[starts[1:] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    # A word's polynomial is a difference of prefix sums, moved to place 0 by the inverse of the base.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * powers(BASE, len(data)), out=sums[1:])
    return mixed((sums[end] - sums[begin]) * powers(BASE_INVERSE, len(data))[begin]), begin


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its different shingles, A-Z lower-cased; the whole sequence if it is shorter than one.

    Words are hashed as bytes, several texts at a time.
    """
    texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + HASHED, "right")) - 1)
        to = min(to, len(texts))
        data, edges = raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        with np.errstate(over="ignore"):
            filled = edges[:-1][edges[1:] > edges[:-1]]
            a, begin = _word_hashes(data, filled) if len(data) else (np.empty(0, np.uint64), np.empty(0, np.int64))
            full = np.full(max(0, len(a) - words + 1), words, np.uint64)
            for k in range(words):
                full = full * _MIX + a[k : len(full) + k]
            full = mixed(full).view(np.int64)
            cuts = np.searchsorted(begin, edges)
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if high - low >= words:
                    yield np.unique(full[low : high - words + 1])
                elif high > low:
                    h = np.array([high - low], np.uint64)  # a short text's shingle never equals one of full length
                    for w in a[low:high]:
                        h = h * _MIX + w
                    yield mixed(h).view(np.int64)
                else:
                    yield np.empty(0, np.int64)
        at = to


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of one text."""
    return next(shingle_sets(pa.array([text], pa.string()), words))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def frequent_tokens(docs: DataFrame, *, text: str = "text", words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that seem most frequent, sorted, and their counts: FREQUENT of them at most.

    Each task reports tokens that repeat among its own texts. What it misses only makes
    lists longer.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(COUNTED, np.int64)
        size = 0

        def report() -> pa.RecordBatch:
            tokens = held[:size]
            tokens.sort()
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            n = np.diff(first, append=size)
            often = n >= REPORTED
            return pa.RecordBatch.from_arrays([pa.array(tokens[first[often]]), pa.array(n[often].astype(np.int64))], ["token", "n"])

        for part in in_slices(batches):
            for tokens in shingle_sets(part.column(0), words):
                while len(tokens):
                    taken = tokens[: COUNTED - size]
                    held[size : size + len(taken)] = taken
                    size += len(taken)
                    tokens = tokens[len(taken) :]
                    if size == COUNTED:
                        yield report()
                        size = 0
        if size:
            yield report()

    top = docs.select(text).mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = top.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    tokens, counts = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def prefix_of(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first tokens of a set: rare ones by hash, then frequent ones, the least frequent first."""
    if len(frequent) and len(tokens):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        often = frequent[at] == tokens
        late = tokens[often][np.lexsort((tokens[often], counts[at[often]]))]
        tokens = np.concatenate([tokens[~often], late])
    return tokens[: prefix_size(len(tokens), percent)]


def with_sets(
    docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], *, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS
) -> DataFrame:
    """(key, n, h, prefix): size and hash of every row's set, and its prefix.

    The prefix is null where the same task has given it for an equal set already, so a set
    that very many rows share reaches the lists once per task at most.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n", T.LongType(), False),
        T.StructField("h", T.LongType(), False),
        T.StructField("prefix", T.ArrayType(T.LongType(), False)),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in in_slices(batches):
            sizes, hashes, prefixes = [], [], []
            for k, s in zip(part.column(0).to_pylist(), shingle_sets(part.column(1), words), strict=True):
                h = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                sizes.append(len(s))
                hashes.append(h)
                fresh = k is not None and len(s) > 0 and h not in seen
                if fresh:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(h)
                prefixes.append(prefix_of(s, *frequent, percent) if fresh else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.int64()), _lists(prefixes)], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if r is None else len(r) for r in rows], np.int64)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.array([r is None for r in rows] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r for r in rows if r is not None] or [np.empty(0, np.int64)])))


def components(edges: DataFrame) -> DataFrame:
    """(v, c) for every node of the undirected `edges` (a, b): the smallest node reachable.

    Each round takes the smallest label around a node, then that node's own label; the
    number of rounds grows with the logarithm of the longest chain.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("b"), F.col("c").alias("near")), "b").groupBy(F.col("a").alias("v")).agg(F.min("near").alias("near"))
        step = labels.join(around, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("further"))
        now = stored(step.join(jump, "c", "left").select("v", "old", F.least("c", F.coalesce("further", "c")).alias("c")), "labels")
        labels = now.select("v", "c")
        if now.filter("c <> old").isEmpty():
            return labels


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs` (a, b, …) with na, nb and common, the exact sizes of the two sets and of what they share."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("__ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("__tb"))
    common = F.size(F.array_intersect("__ta", "__tb")).cast("long")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select(*pairs.columns, F.size("__ta").cast("long").alias("na"), F.size("__tb").cast("long").alias("nb"), common.alias("common"))
    )


def _up(x: Column, by: int) -> Column:
    """x / by, rounded up, in whole numbers."""
    return F.floor((x + by - 1) / by)


def least_shared(n: Column, m: Column, percent: int) -> Column:
    """Tokens that the prefixes of two linked sets of these sizes have in common at least.

    What the set whose prefix ends first has behind it adds to the overlap at most that much.
    """
    return _up(percent * (n + m), 100 + percent) - _up(percent * F.greatest(n, m), 100) + 1


def least_shared_within(n: Column, low: Column, high: Column, percent: int) -> Column:
    """The least of least_shared for partners of all sizes from low to high.

    Up to n it rises with the partner's size. Beyond, it falls by percent^2 / (100 (100 + percent))
    a step, but for roundings of less than 1 either way; so only the last few sizes can be
    below the value at high.
    """
    few = -(-100 * (100 + percent) // percent**2)
    return F.least(*[least_shared(n, m, percent) for m in (low, *[F.greatest(low, high - k) for k in range(few)])])


def _distance() -> Column:
    return 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))


def jaccard_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(key, n_shingles, component_id) of every row: its set's size and the smallest key reachable by links.

    A text without words has an empty set, is linked with nothing and stands alone, as does
    everything that no other text is like. Rows with equal sets are linked by that. A row
    without a key takes no part in links and has no component. Repeated rows are all
    returned; rows that share a key count as one document. An empty table gives no rows.

    Tokens are 64-bit hashes of shingles; every link is checked on the whole sets.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stored(with_sets(docs, frequent_tokens(docs, words=words), key="id", percent=percent, words=words), "sets")
    named = rows.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    nodes = stored(named.groupBy("h", "n").agg(F.min("id").alias("node"), F.count("*").alias("rows")), "nodes")

    # Lists of the prefixes' tokens; only those with two different sets are of use.
    entries = rows.filter(F.col("prefix").isNotNull()).select("h", "n", F.posexplode("prefix").alias("pos", "token"))
    entries = entries.select("token", "h", F.shiftleft("n", 32).bitwiseOR(F.col("pos")).alias("np")).repartition("token")
    shared = entries.groupBy("token").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo <> hi").select("token")
    lists = entries.join(shared.hint("shuffle_hash"), "token", "left_semi").distinct()
    lists = lists.select("token", "h", F.shiftright("np", 32).alias("n"), F.col("np").bitwiseAND(F.lit((1 << 32) - 1)).alias("pos"))
    lists = stored(lists.join(nodes.select("h", "n", "node"), ["h", "n"]).select("token", "node", "n", "pos"), "lists")

    # Answers, first part: each set against the pivot that most of its lists have.
    first = lists.groupBy("token").agg(F.min(F.struct("node", "n")).alias("first"))
    votes = (
        lists.join(first, "token")
        .select(F.col("node").alias("a"), "n", F.col("first.node").alias("b"), F.col("first.n").alias("m"))
        .filter((F.col("a") != F.col("b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
        .groupBy("a", "b", "n", "m")
        .count()
        .filter(F.col("count") >= least_shared(F.col("n"), F.col("m"), percent))
    )
    pairs = votes.groupBy("a").agg(F.max(F.struct("count", -F.col("b"))).alias("best")).select("a", (-F.col("best.col2")).alias("b"))
    pairs = stored(pairs, "pairs")
    sets = _whole_sets(docs, _nodes_of(pairs), words)
    near = stored(compared(pairs, sets).filter(_linked(percent)), "pivots")
    pivots = near.select(F.col("a").alias("node"), F.col("b").alias("pivot"), _distance().alias("away"), F.col("na").alias("size"))
    groups = components(near.select("a", "b"))

    # Lists, second part: entries that meet another group there, in blocks.
    placed = (
        lists.join(pivots.select("node", "pivot"), "node", "left")
        .join(groups.select(F.col("v").alias("node"), "c"), "node", "left")
        .select("token", "node", "n", "pos", F.coalesce("pivot", "node").alias("pivot"), F.coalesce("c", "node").alias("c"), F.col("c").isNotNull().alias("joint"))
    )
    mixed = placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("token")
    ratio = float(np.log(100 / percent))
    open_ = stored(placed.join(mixed, "token", "left_semi").withColumn("size", F.floor(F.log(F.col("n")) / ratio).cast("int")), "open")
    held = stored(open_.groupBy("node").agg(F.collect_set("token").alias("tokens")), "held")
    lone = open_.filter("NOT joint").select("token", "size", "node", "n", "pos")
    alone = _first_shared(lone, lone, ["token", "size"], held, percent).filter("a > b")
    met = stored(alone.unionByName(_joint_pairs(open_, percent)).distinct(), "met")
    sets = sets.unionByName(_whole_sets(docs, _nodes_of(met).join(sets.select("node"), "node", "left_anti"), words))
    answers = stored(compared(met, sets), "answers")
    # Members of a pivot that the distances leave open: |away(x) - away(z)| <= distance of x and z.
    unlike = answers.filter(~_linked(percent)).select("a", "na", F.col("b").alias("pivot"), _distance().alias("far"))
    slack = 1 - percent / 100 + 1e-9
    asking = open_.join(unlike.select(F.col("a").alias("node"), F.col("pivot").alias("group"), "far"), "node").select("token", "size", "group", "node", "n", "pos", "far")
    members = open_.filter("node <> pivot").join(pivots.select("node", "away"), "node").select("token", "size", F.col("pivot").alias("group"), "node", "n", "pos", "away")
    left = _first_shared(asking, members, ["token", "size", "group"], held, percent, F.col("far") - F.col("away") <= slack)
    derived = compared(left, sets).filter(_linked(percent)).select("a", "b")
    links = near.select("a", "b").unionByName(answers.filter(_linked(percent)).select("a", "b")).unionByName(derived)
    found = components(links)

    placed_nodes = nodes.join(found.withColumnRenamed("v", "node"), "node", "left").select(
        F.concat_ws(":", "h", "n").alias("k"), F.col("rows").alias("count"), F.coalesce("c", "node").alias("component")
    )
    facts = stored(placed_nodes, "placed")
    mine = rows.select("id", "n", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.concat_ws(":", "h", "n")).alias("k"))
    out = join_facts(mine, facts, "k", "count", facts.agg(F.sum("count")).first()[0] or 0, F.xxhash64("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def _prefix_size(n: Column, percent: int) -> Column:
    return n - _up(n * percent, 100) + 1


def _near_sizes(df: DataFrame) -> DataFrame:
    """Each row under its own size class and its neighbours'; sizes of linked sets differ by one class at most."""
    return df.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))


def _first_shared(left: DataFrame, right: DataFrame, keys: list[str], held: DataFrame, percent: int, more: Column | None = None) -> DataFrame:
    """(a, b) of sets whose prefixes share as much as those of linked sets do, one from each frame of list entries.

    The first of k shared tokens has k - 1 behind it in either prefix, so entries further
    back are skipped: in the list of a passage that many texts hold, nearly all.
    """
    other = _near_sizes(right.withColumnsRenamed({"node": "b", "n": "m", "pos": "at"}))
    k = least_shared(F.col("n"), F.col("m"), percent)
    pairs = (
        left.join(other, keys)
        .filter((F.col("node") != F.col("b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
        .filter((F.col("pos") <= _prefix_size(F.col("n"), percent) - k) & (F.col("at") <= _prefix_size(F.col("m"), percent) - k))
        .filter(F.lit(True) if more is None else more)
        .select(F.col("node").alias("a"), "b", k.alias("k"))
        .distinct()
    )
    both = pairs.join(held.select(F.col("node").alias("a"), F.col("tokens").alias("__ta")), "a").join(held.select(F.col("node").alias("b"), F.col("tokens").alias("__tb")), "b")
    return both.filter(F.size(F.array_intersect("__ta", "__tb")) >= F.col("k")).select("a", "b")


def _joint_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b) of sets and the pivots of groups that they meet often enough for a link to a member.

    Lone sets meet the groups, never the other way round; of two groups the one of greater
    label meets the other. A group's entries in a list are blocks by size and place.
    """
    blocks = _near_sizes(
        entries.filter("joint")
        .withColumn("place", F.floor(F.col("pos") * 32 / F.col("n")).cast("int"))
        .groupBy("token", F.col("pivot").alias("b"), F.col("c").alias("d"), "size", "place")
        .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("from"), F.max("pos").alias("to"))
        .drop("place")
    )
    # The sizes a partner in the block can have, and the least a link has in common.
    low = F.greatest(F.col("least"), _up(F.col("n") * percent, 100))
    high = F.least(F.col("most"), F.floor(F.col("n") * 100 / percent))
    common = _up(percent * (F.col("n") + low), 100 + percent)
    # Before a shared token at places i and j there are min(i, j) tokens in common at most, after it no more than either set has left.
    return (
        entries.join(blocks, ["token", "size"])
        .filter((~F.col("joint") | (F.col("c") > F.col("d"))) & (F.col("node") != F.col("b")) & (low <= high))
        .filter((F.col("pos") - F.col("to") <= F.col("n") - common) & (F.col("from") - F.col("pos") <= F.col("most") - common))
        .groupBy(F.col("node").alias("a"), "b")
        .agg(F.count("*").alias("shared"), F.min(least_shared_within(F.col("n"), low, high, percent)).alias("needed"))
        .filter(F.col("shared") >= F.col("needed"))
        .select("a", "b")
    )


def _whole_sets(docs: DataFrame, used: DataFrame, words: int) -> DataFrame:
    """(node, tokens) of the documents that stand for the nodes in `used`, stored; if these are few, Spark sees so from their size and moves no text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(list(shingle_sets(part.column(1), words)))], ["node", "tokens"])

    wanted = docs.join(stored(used, "used").withColumnRenamed("node", "id"), "id", "left_semi")
    return stored(wanted.mapInArrow(run, "node bigint, tokens array<bigint>").filter(F.size("tokens") > 0), "tokens")


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of `docs`, all columns, without those that are linked to a smaller key; of rows that share a key one stays.

    Rows without a key stay.
    """
    groups = stored(jaccard_groups(docs, key=key, text=text, percent=percent, words=words), "groups")
    gone = stored(groups.filter(F.col("component_id") != F.col(key)).select(key).distinct(), "gone")
    twice = stored(groups.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key), "twice")
    rest = docs.join(gone, key, "left_anti")
    single = rest.join(twice, key, "left_anti")
    return single.unionByName(rest.join(twice, key, "left_semi").dropDuplicates([key]))
