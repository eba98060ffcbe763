"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as three records: a request, a response (or a revisit, if an
earlier capture has the same payload) and metadata, where request and metadata name
the response in WARC-Concurrent-To. Reading gives one row per record; assembly brings
the records of a transaction together by the links of that header and gives one nested
row per capture.

Archives are plain WARC 1.1 files, compressed as a whole or record by record. Spark's text
writer stores them and its text reader streams them, cut at blank lines, so they may lie in
any store Spark can reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import in_slices, join_facts, stored
from icufeat.llm.jaccard import components

CRLF, BLANK = "\r\n", b"\r\n\r\n"
#: Payloads from this size on are stored once.
SHARED_FROM = 100
#: Payload bytes in an archive file, about; a file is read by one task.
FILE_BYTES = 8 << 20
#: Payload bytes that a reading task gathers before it passes records on.
BATCH_BYTES = 8 << 20

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("concurrent_to", T.StringType()),
    T.StructField("also_concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("intact", T.BooleanType()),
    T.StructField("truncated", T.BooleanType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
])


def _line(text: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]+", " ")


def _uri(key: Column, url: Column, kind: str) -> Column:
    """An identifier of a record: the page, a digest of its URL and payload, and the kind."""
    what = F.md5(F.concat(F.coalesce(url, F.lit("")), F.lit(" "), F.col("payload_digest")))
    return F.concat(F.lit("<urn:capture:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(":"), what, F.lit(f":{kind}>"))


def with_roles(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html") -> tuple[DataFrame, float]:
    """(key, url, payload, payload_bytes, payload_digest, first_id, first_url): which capture holds each payload; and their mean size.

    Of equal payloads of at least SHARED_FROM bytes the one with the smallest key (then
    URL) is the first; `first_id` is null where a payload is not shared. Rows without a
    key can refer to others but are never the first. Digests are grouped with partial
    aggregates; only shared ones are joined back, and heavy ones broadcast.
    """
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), data.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    named = F.when(F.col("key").isNotNull(), F.struct("key", "url"))
    groups = stored(
        rows.groupBy("payload_digest", "payload_bytes").agg(F.count("*").alias("n"), F.min(named).alias("first")), "warc-groups"
    )
    total = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("payload_bytes")).alias("bytes")).first()
    shared = groups.filter((F.col("n") > 1) & (F.col("payload_bytes") >= SHARED_FROM) & F.col("first").isNotNull()).select(
        "payload_digest", "n", F.col("first.key").alias("first_id"), F.col("first.url").alias("first_url")
    )
    joined = join_facts(rows, shared, "payload_digest", "n", total.n or 0, F.xxhash64("key", "url"))
    return joined, (total.bytes or 0) / max(1, total.n or 0)


def write_archives(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes three records per row to WARC files under `path`.

    A null payload is empty. Rows repeated as a whole are written each, under the same
    identifiers. An empty table writes archives without a record.
    """
    rows, average = with_roles(pages, key=key, url=url, payload=payload)
    per_file = max(1, int(FILE_BYTES / (1_500 + average)))
    is_first = F.col("key").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    revisit = F.col("first_id").isNotNull() & ~is_first
    own = _uri(F.col("key"), F.col("url"), "response")
    uri = _line(F.col("url"))

    def record(kind: Column, ident: Column, mime: str, lines: list[Column], block: Column) -> Column:
        head = F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), ident, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
            *lines, F.lit(f"\r\nContent-Type: {mime}\r\nContent-Length: "), F.length(block).cast("string"), F.lit("\r\n\r\n"),
        )
        return F.concat(F.encode(head, "UTF-8"), block)

    together = F.concat(F.lit("\r\nWARC-Concurrent-To: "), own)
    asked = F.encode(F.concat(F.lit("GET / HTTP/1.1\r\nX-Target: "), uri, F.lit("\r\n\r\n")), "UTF-8")
    http = F.encode(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")), "UTF-8")
    answer = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    again = F.when(
        revisit,
        F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _uri(F.col("first_id"), F.col("first_url"), "response"),
        ),
    ).otherwise("")
    digest = F.concat(F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"))
    known = F.encode(F.concat(F.lit("pageId: "), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit("\r\n")), "UTF-8")
    records = (
        record(F.lit("request"), _uri(F.col("key"), F.col("url"), "request"), "application/http;msgtype=request", [together], asked),
        record(F.when(revisit, F.lit("revisit")).otherwise("response"), own, "application/http;msgtype=response", [digest, again], answer),
        record(F.lit("metadata"), _uri(F.col("key"), F.col("url"), "metadata"), "application/warc-fields", [together], known),
    )
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    # The writer puts the line separator, which ends a record, after each value; bytes pass through it unchanged.
    value = F.concat(records[0], end, records[1], end, records[2]).cast("string")
    rows.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _heads(text: bytes) -> tuple[dict[str, list[str]], int | None]:
    """Values by lower-case header name, and the block's length; None where `text` is no head or names no length."""
    lines = text.decode("utf-8", "replace").split(CRLF)
    heads: dict[str, list[str]] = {}
    if not lines[0].startswith("WARC/"):
        return heads, None
    last: list[str] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            last[-1] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = heads.setdefault(name.strip().lower(), [])
            last.append(value.strip())
    size = heads.get("content-length", [""])[0]
    return heads, int(size) if size.isascii() and size.isdigit() else None


def parse_pieces(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, list[str]], bytes, bool]]:
    """(headers, block, whole) of each record of an archive, given what lies between its blank lines.

    Holds one record at a time. A record that the archive ends in, or whose head names no
    length, is not whole; the latter has no block. Bytes where a record should begin and
    none does are skipped up to the next head, and give one record without headers.
    """
    heads: dict[str, list[str]] | None = None
    size, have, parts, lost = 0, 0, [], False
    for piece in pieces:
        if heads is not None:
            # A blank line inside the block, or the end of it.
            rest = BLANK + piece if parts else piece
            parts.append(rest[: size - have])
            have += len(parts[-1])
            if have < size:
                continue
            yield heads, b"".join(parts), True
            heads, piece = None, rest[len(parts[-1]) :]
        piece = piece.lstrip(b"\r\n")
        if not piece:
            continue
        heads, length = _heads(piece)
        if length:
            size, have, parts, lost = length, 0, [], False
            continue
        if heads or not lost:
            yield heads, b"", length == 0
        heads, lost = None, length is None
    if heads is not None:
        yield heads, b"".join(parts), False


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """First value of each header, and the block, of each record of an archive in memory."""
    for heads, block, _ in parse_pieces(data.split(BLANK)):
        yield {k: v[0] for k, v in heads.items()}, block


def _split_http(block: bytes) -> tuple[dict[str, str], memoryview | None]:
    """Headers and payload of an HTTP message; no payload where the blank line that ends the head is missing."""
    end = block.find(BLANK)
    lines = block[: max(0, end)].decode("utf-8", "replace").split(CRLF)[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, memoryview(block)[end + 4 :] if end >= 0 else None


def _row(heads: dict[str, list[str]], block: bytes, whole: bool, payload: bool) -> tuple:
    """A record as a row of RECORD."""

    def named(header: str) -> str | None:
        return heads.get(header, [None])[0]

    type_, size, digest, intact, fields, body = named("warc-type"), None, None, None, None, None
    if type_ in ("response", "revisit"):
        http, held = _split_http(block)
        digest = (named("warc-payload-digest") or "").partition(":")[2] or None
        if type_ == "revisit":
            length = http.get("content-length", "")
            size = int(length) if length.isascii() and length.isdigit() else None
        elif held is not None:
            size = len(held)
            real = hashlib.sha256(held).hexdigest()
            digest, intact = digest or real, whole and digest in (None, real)
            body = bytes(held) if payload else None
    elif type_ == "metadata":
        lines = block.decode("utf-8", "replace").split(CRLF)
        fields = list({k.strip(): v.strip() for k, sep, v in (x.partition(":") for x in lines) if sep}.items())
    first, *others = heads.get("warc-concurrent-to", [None])
    return (
        named("warc-record-id"), type_, first, others, named("warc-refers-to"), named("warc-target-uri"), named("warc-date"),
        digest, size, intact, not whole, fields, body,
    )


def read_archives(spark: SparkSession, path: str, *, payload: bool = True, salvage: bool = False) -> DataFrame:
    """One row per record of the archives (`*.gz`) under `path`; `payload=False` leaves the payloads out.

    Archives are read from one blank line to the next, so a task holds a batch of such
    pieces and one record, whatever the size of a file. payload_bytes and payload_digest
    are those of the full payload, also for a revisit; `intact` tells whether a stored
    payload has the digest its header names. A record that is cut short, or whose head is
    damaged, is `truncated` and keeps what there is of it (see `parse_pieces`). A file that
    cannot be decompressed ends the job; with `salvage` what comes before the damage is kept.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("also_concurrent_to", pa.list_(pa.string())),
            ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("intact", pa.bool_()), ("truncated", pa.bool_()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ])

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)

        pieces = (row for b in in_slices(batches) for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        rows: list[tuple] = []
        held = 0
        for _, of_file in groupby(pieces, itemgetter(0)):
            for heads, block, whole in parse_pieces(map(itemgetter(1), of_file)):
                rows.append(_row(heads, block, whole, payload))
                held += len(rows[-1][-1] or b"")
                if len(rows) == 1_000 or held >= BATCH_BYTES:
                    yield as_batch(rows)
                    rows, held = [], 0
        if rows:
            yield as_batch(rows)

    files = (
        spark.read.format("text").option("lineSep", "\r\n\r\n").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", str(salvage).lower()).load(path)
    )
    # A compressed file is never split: its pieces come in order and one after the other.
    return files.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(run, RECORD)


def _roots(own: Column, names: Column, records: DataFrame) -> DataFrame | None:
    """(v, c): one identifier `c` for all identifiers `v` that are linked over more than one hop; None if there are none.

    A record that names one other and is not named itself belongs to the one it names,
    which takes no search. Only the links of all other records go through `components`.
    """
    edges = stored(records.select(own.alias("a"), F.explode(names).alias("b")).filter("a <> b").distinct(), "warc-links")
    named = edges.select(F.col("b").alias("a")).distinct()
    several = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    inner = several.unionByName(edges.select("a").distinct().join(named, "a", "left_semi")).distinct()
    core = stored(edges.join(inner, "a", "left_semi"), "warc-core")
    return None if core.isEmpty() else components(core)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, response, others, requests, metadata, copies).

    Records belong together when WARC-Concurrent-To links them, whichever of them names the
    other and over any number of records. `response` is the response or revisit (null if the
    archives lack it), `others` are further different ones of the same capture, `requests`
    and `metadata` arrays of the different records. capture_id is the response's record_id,
    else one of the identifiers named. A record without any identifier is its own capture,
    together with records that equal it as a whole. Records repeated under one identifier are
    the same capture; `copies` counts the rows of the response (1 at least). Damaged records
    without a type are captures without any record.
    """
    kind = F.col("record_type")
    main = kind.isin("response", "revisit")
    # Maps cannot be grouped or compared; their entries can.
    flat = F.struct(*[F.map_entries(c).alias(c) if c == "fields" else F.col(c) for c in records.columns])
    own = F.coalesce("record_id", F.concat(F.lit("?"), F.md5(F.to_json(flat))))
    names = F.array_compact(F.concat(F.array("concurrent_to"), F.coalesce("also_concurrent_to", F.array().cast("array<string>"))))
    linked = records.withColumn("__hub", F.coalesce(F.try_element_at(names, F.lit(1)), own))
    roots = _roots(own, names, records)
    if roots is not None:
        linked = linked.join(roots, F.col("__hub") == F.col("v"), "left").withColumn("__hub", F.coalesce("c", "__hub"))
    grouped = linked.groupBy("__hub").agg(
        F.collect_set(F.when(main, flat)).alias("mains"),
        F.array_sort(F.collect_set(F.when(kind == "request", flat))).alias("requests"),
        F.array_sort(F.collect_set(F.when(kind == "metadata", flat))).alias("metadata"),
        F.count(F.when(main, F.lit(1))).alias("n"),
    )
    response = F.array_max("mains")
    return grouped.select(
        F.coalesce(response["record_id"], "__hub").alias("capture_id"),
        response.alias("response"),
        F.array_except("mains", F.array(response)).alias("others"),
        "requests",
        "metadata",
        F.greatest(F.col("n") - F.size("mains") + 1, F.lit(1).cast("long")).alias("copies"),
    )
