"""Responses whose HTTP head is very long or has no end."""

import gzip
import hashlib

from icufeat.llm import warc


def test_long_and_endless_heads(spark, tmp_path):
    body = b"<p>text</p>"
    digest = hashlib.sha256(body).hexdigest()
    blocks = {"long": b"HTTP/1.1 200 OK\r\nX-Long: " + b"y" * 70_000 + b"\r\n\r\n" + body, "endless": b"HTTP/1.1 200 OK\r\nX: y"}
    data = b""
    for name, block in blocks.items():
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{name}>\r\nWARC-Payload-Digest: sha256:{digest}\r\nContent-Length: {len(block)}\r\n\r\n"
        data += head.encode() + block + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    got = {r.record_id: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    a, b = got["<long>"], got["<endless>"]
    assert (a.payload_bytes, a.intact, bytes(a.payload), a.payload_digest) == (len(body), True, body, digest)
    assert (b.payload_bytes, b.intact, b.payload, b.payload_digest) == (None, None, None, digest)
