"""WARC transactions, chat examples, URL verdicts and top-k, each by an independent count."""

import gzip
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from icufeat.llm import chat, topk, urls, warc
from icufeat.llm.queries import ODD, op2_warc, op5_topk, op8_chat, op9_urls

PAGE = "page_id BIGINT, url STRING, html STRING, payload STRING, key STRING, n BIGINT"


def pages_frame(spark):
    long = "<p>é" + "y" * 200 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [
        (1, "http://a.example/1", long), (2, "http://a.example/2", long), (3, None, long), (None, "http://a.example/n", long), (4, "u\r\nX: y", None),
        (5, "", ""), (6, "http://b.example", "short"), (7, "http://b.example", "short"), (8, "http://c.example", "z" * 300_000), (8, "http://c.example", "z" * 300_000),
        (9, "http://c.example", "z" * 300_000), (10, "http://d.example/a", "q" * 99), (11, "http://d.example/b", "q" * 99), (12, "http://d.example/c", "r" * 100), (13, "x", "r" * 100),
    ]
    return spark.createDataFrame([(*r, "p", "k", 3) for r in rows], PAGE), rows


def test_captures(spark, tmp_path):
    frame, rows = pages_frame(spark)
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in op2_warc(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, url, html in rows:
        body = (html or "").encode()
        first = min(j for j, _, h in rows if j is not None and (h or "") == (html or ""))
        again = len(body) >= 100 and i != first
        want.append((i or -1, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None, None if again else True))
    assert got == sorted(want, key=str)


def test_archives_hold_the_payloads(spark, tmp_path):
    frame, rows = pages_frame(spark)
    warc.write_archives(frame, str(tmp_path / "w"))
    kinds = []
    for f in (tmp_path / "w").glob("*.gz"):
        for heads, block in warc.parse_records(gzip.decompress(f.read_bytes())):
            kinds.append(heads["warc-type"])
            assert int(heads["content-length"]) == len(block)
    assert sorted(set(kinds)) == ["metadata", "request", "response", "revisit"] and len(kinds) == 3 * len(rows)
    captures = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert sum(c.copies for c in captures) == len(rows)
    for c in captures:
        assert len(c.requests) == len(c.metadata) == 1 and c.requests[0].concurrent_to == c.response.record_id
        if c.response.record_type == "response":
            assert hashlib.sha256(bytes(c.response.payload)).hexdigest() == c.response.payload_digest


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], PAGE).write.parquet(str(tmp_path / "pages.parquet"))
    assert op2_warc(spark, str(tmp_path)).count() == 0
    assert op9_urls(spark, str(tmp_path)).count() == 0


def test_foreign_records(spark):
    rows = [("r1", "response", None), ("q1", "request", "r1"), ("q2", "request", "r1"), ("m9", "metadata", "gone"), (None, "response", None)]
    made = spark.createDataFrame(rows, "record_id STRING, record_type STRING, concurrent_to STRING")
    full = made.select(*[F.col(f.name) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in warc.RECORD])
    got = {r.capture_id: (r.response is not None, len(r.requests), len(r.metadata)) for r in warc.assemble(full).collect()}
    assert got["r1"] == (True, 2, 0) and got["gone"] == (False, 0, 1) and len(got) == 3


TURN = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, example BIGINT, loss_start STRING"
NASTY = ["", None, ODD, "\\</turn>\n</turn>\n<turn user>\nhi\n</turn>\n", "<turn assistant>\nx", "a\\", "\\\\<turn", "</turn", "é😀\n", "</turn>" * 50]


def test_chat_round_trip(spark, tmp_path):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (4, None, None, None), (None, 1, "user", "x"), (None, 2, "assistant", "y")]
    rows += [(5, 0, "a>b\n<c\\g", "odd role"), (5, 1, "assistant", "ok")] + [(6, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(120)]
    spark.createDataFrame([(*r, 1, "c") for r in rows], TURN).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op8_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows += [(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)]
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv] == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)), conv
    assert len(got) == len({r[0] for r in rows})


def test_every_assistant_turn_is_an_example(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}") for i in range(7)]
    got = sorted(chat.expand(spark.createDataFrame([(*r, 1, "c") for r in rows], TURN)).collect(), key=lambda r: r.example)
    assert [chat.parse(e.text) for e in got] == [[(r[2], r[3]) for r in rows[:n]] for n in (2, 4, 6, 7)]
    assert [e.text[e.loss_start : e.loss_end] for e in got[:3]] == ["text 1", "text 3", "text 5"] and got[3].loss_start is None
    assert chat.expand(spark.createDataFrame([], TURN)).count() == 0


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = []
    for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(rule), rule, verdict))
    return host, path, max(fit)[1:] if fit else None


def test_url_rules(spark, tmp_path):
    odd = [
        None, "", "no scheme", "://", "http://", "http://A.Example.NET/en/x?y#z", "http://net", "http://net/", "http://a.net?x=/", "http://xnet/", "https://EXAMPLE.com/de/",
        "https://example.com/de", "http://u@h:80/org/fr/", "http://x.org/fr/", "http://é.ÄNET/en/", "a://b://c.net/d", "http://" + "w." * 20_000 + "net/en/", "http://x.net/" + "p" * 100_000,
        "http://a\nb.net/\nc?d",
    ]
    rows = [(i, u, None, "p", "host", 1) for i, u in enumerate(odd)] + [(None, "http://x.net/", None, "p", "h", 1)] * 2
    spark.createDataFrame(rows, PAGE).write.parquet(str(tmp_path / "pages.parquet"))
    got = op9_urls(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = brute_url(odd[r.page_id] if r.page_id is not None else "http://x.net/")
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None), odd[r.page_id or 0]
        assert r.verdict == (rule[1] if rule else ("block" if r.block_probability >= urls.BLOCK_AT else "allow"))


def test_url_classifier(spark):
    table = urls.labelled()
    held = [(i, u, y) for i, (u, y) in enumerate(table) if i % 4 == 0]
    rest = spark.createDataFrame([(u, float(y)) for i, (u, y) in enumerate(table) if i % 4], "url STRING, label DOUBLE")
    got = urls.judge_urls(spark.createDataFrame(held, "page_id BIGINT, url STRING, y INT"), urls.fit_urls(rest), rules=(("none.none/", "block"),), block_at=0.5)
    truth = {i: y for i, _, y in held}
    assert np.mean([(r.verdict == "block") == bool(truth[r.page_id]) for r in got.collect()]) > 0.85


def brute_top(rows, k=5):
    good = [(i, [int(np.floor(256 * float(e))) for e in v]) for i, v in rows if i is not None and v is not None and all(e is not None and np.isfinite(e) for e in v)]
    out = set()
    for q, x in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    return out


def test_top_k(spark, tmp_path):
    draw = np.random.default_rng(2)
    rows = [(i, [float(v) for v in np.round(draw.normal(size=8), 1)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(12)] + [(50_000, None), (50_050, [1.0, None] + [0.0] * 6), (50_100, [float("nan")] * 8), (50_150, [float("inf")] * 8)]
    rows += [(None, rows[3][1]), (50_200, []), (50_201, []), (50_250, [0.5, -0.5]), (50_300, [0.0] * 8)]
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, score DOUBLE")
    want = brute_top([(i, None if v is None else [None if e is None else float(np.float32(e)) for e in v]) for i, v in rows])
    for block in (topk.BLOCK, 37):
        got = {tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, block=block).collect()}
        assert got == want
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in op5_topk(spark, str(tmp_path)).collect()} == want
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(table.filter("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_repeated_rows(spark):
    v = [[0.5, 0.5], [0.5, 0.25], [0.5, 0.25], [1.0, 0.0]]
    rows = [(0, v[0]), (0, v[0]), (1, v[1]), (1, v[1]), (2, v[3])]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>"), F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 2, 32768), (0, 2, 1, 24576), (0, 3, 1, 24576)]


def test_reading_stops_early():
    """With one outstanding candidate per query, half of each list settles the block."""
    draw = np.random.default_rng(4)
    x = draw.integers(-20, 20, (600, 6))
    x[::200] = [200, -200, 150, -150, 120, -120]
    q = np.array([[100, -100, 90, -80, 70, -60]])
    rows, scores, read = topk.Lists(np.arange(600), x).best(-1, q[0], 3)
    assert read <= 600 * 6 / 2
    assert rows.tolist() == [0, 200, 400] and (scores == x[0] @ q[0]).all()


def test_scores_too_large():
    rows, scores, _ = topk.Lists(np.arange(3), np.full((3, 2), 2**40)).best(0, np.full(2, 2**40), 1)
    assert rows.tolist() == [1] and scores.tolist() == [2**63 - 1]
