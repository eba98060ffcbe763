"""WARC records linked over several hops, large and damaged archives."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from icufeat.llm import warc


def record(kind, ident, names=(), block=b"", length=None):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", *[f"WARC-Concurrent-To: {n}" for n in names], f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http(body):
    return b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body


def archive(folder, name, *records, members=False):
    data = b"".join(gzip.compress(r) for r in records) if members else gzip.compress(b"".join(records))
    (folder / f"{name}.warc.gz").write_bytes(data)
    return data


def made(spark, rows):
    frame = spark.createDataFrame(rows, "record_id STRING, record_type STRING, concurrent_to STRING, also_concurrent_to ARRAY<STRING>, target_uri STRING")
    return frame.select(*[F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in warc.RECORD])


def brute_groups(rows):
    """Sets of row numbers that belong together, by merging until nothing changes."""
    groups = []
    for at, (own, _, first, more, _) in enumerate(rows):
        ids = {x for x in [own, first, *(more or [])] if x is not None} or {("alone", str(rows[at]))}
        members = {at}
        for g in [g for g in groups if g[0] & ids]:
            groups.remove(g)
            ids |= g[0]
            members |= g[1]
        groups.append((ids, members))
    return sorted(sorted(m) for _, m in groups)


def test_links_over_several_hops(spark):
    rows = [
        ("r1", "response", "q1", None, "0"), ("q1", "request", None, None, "1"), ("m1", "metadata", "q1", None, "2"),
        ("r2", "response", None, None, "3"), ("q2", "request", "r2", ["m2"], "4"), ("m2", "metadata", "r2", None, "5"), ("n2", "metadata", "m2", [], "6"),
        ("r3", "response", "q3", None, "7"), ("q3", "request", "r3", None, "8"), ("r4", "response", "r3", None, "9"),
        (None, "metadata", "r5", ["r6"], "10"), ("r5", "response", None, None, "11"), ("r6", "revisit", None, None, "12"),
        (None, "response", None, None, "13"), (None, "response", None, None, "14"), (None, "response", None, None, None), (None, "request", None, None, None),
        ("r7", "response", "r7", None, "17"), ("m8", "metadata", "gone", None, "18"), (None, None, None, None, "19"),
    ]
    draw = random.Random(5)
    for i in range(300):
        kind = draw.choice(["response", "request", "metadata", "metadata"])
        named = [f"x{draw.randrange(400)}" for _ in range(draw.choice([0, 0, 1, 1, 2]))]
        rows.append((f"x{i}", kind, named[0] if named else None, named[1:], str(20 + i)))
    got = warc.assemble(made(spark, rows)).collect()
    held = [[r for r in (c.response, *c.others, *c.requests, *c.metadata) if r is not None] for c in got]
    number = {(r[0], r[1], r[4]): at for at, r in enumerate(rows)}
    found = sorted(sorted(number[r.record_id, r.record_type, r.target_uri] for r in g) for g in held if g)
    assert found == [g for g in brute_groups(rows) if g != [19]]
    assert sum(not g for g in held) == 1
    assert len({c.capture_id for c in got}) == len(got) == len(found) + 1
    by_id = {c.capture_id: c for c in got}
    assert [r.record_id for r in by_id["r1"].requests + by_id["r1"].metadata] == ["q1", "m1"]
    assert all(c.copies == 1 for c in got)


def test_a_hot_response(spark):
    rows = [("r", "response", None, None, None)] * 3 + [(f"m{i}", "metadata", "r", ["q"] if i % 2 else None, None) for i in range(2_000)]
    (only,) = warc.assemble(made(spark, rows)).collect()
    assert only.copies == 3 and len(only.metadata) == 2_000 and not only.others


def test_pieces_of_any_block():
    draw = random.Random(7)
    blocks = [bytes(draw.choice(b"\r\n\r\nW") for _ in range(draw.randrange(30))) for _ in range(500)] + [b"", b"\r\n\r\n", b"\r\n"]
    data = b"".join(record("x", i, (), b) for i, b in enumerate(blocks))
    assert [(b, whole) for _, b, whole in warc.parse_pieces(data.split(warc.BLANK))] == [(b, True) for b in blocks]
    for cut in range(len(data) - 200, len(data)):
        got = list(warc.parse_pieces(data[:cut].split(warc.BLANK)))
        assert [b for _, b, whole in got if whole] == blocks[: sum(whole for *_, whole in got)] and sum(not whole for *_, whole in got) <= 1


@pytest.mark.parametrize("members", [False, True])
def test_damaged_archives(spark, tmp_path, members):
    big = b"z" * 3_000_000 + b"\r\n\r\n" + bytes(range(256)) * 4_000
    odd = record("response", "early", (), http(b"abc"))
    no_length = odd.replace(b"Content-Length: ", b"Content-Size: ")
    archive(tmp_path, "a", record("response", "big", (), http(big)), record("metadata", "m", ["big", "other"], b"a: 1\r\nb: 2"), members=members)
    archive(tmp_path, "b", record("response", "cut", (), http(b"x" * 50), length=500), members=members)
    archive(tmp_path, "c", no_length, b"noise\r\n\r\nmore noise\r\n\r\n", record("response", "after", (), http(b"ok")), members=members)
    archive(tmp_path, "d", b"", members=members)
    archive(tmp_path, "e", b"noise", record("response", "eaten"), record("response", "next", (), http(b"")), members=members)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    got = {r.record_id: r for r in rows}
    assert bytes(got["big"].payload) == big and got["big"].payload_digest == hashlib.sha256(big).hexdigest() and not got["big"].truncated
    assert (got["m"].concurrent_to, got["m"].also_concurrent_to, got["m"].fields) == ("big", ["other"], {"a": "1", "b": "2"})
    assert got["cut"].truncated and got["cut"].intact is False and bytes(got["cut"].payload).startswith(b"x" * 50)
    assert got["early"].truncated and got["early"].payload is None
    assert bytes(got["after"].payload) == b"ok" and got["after"].intact and bytes(got["next"].payload) == b""
    assert [r.record_type for r in rows if r.record_id is None] == [None] and len(rows) == 7


def test_cut_compression(spark, tmp_path):
    draw = random.Random(1)
    noise = [draw.randbytes(20_000).replace(b"\r", b"") for _ in range(20)]
    data = archive(tmp_path, "a", *[record("response", f"r{i}", (), http(b)) for i, b in enumerate(noise)])
    (tmp_path / "a.warc.gz").write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        warc.read_archives(spark, str(tmp_path)).collect()
    got = warc.read_archives(spark, str(tmp_path), salvage=True).collect()
    good = [r for r in got if not r.truncated]
    assert len(good) >= 7 and len(got) - len(good) <= 1
    assert all(bytes(r.payload) == noise[int(r.record_id[1:])] for r in good)
