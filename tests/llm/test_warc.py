from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sensorspark.llm import warc as W
from sensorspark.session import fresh_path

PAGES = "page_id long, url string, html string, digest string, payload string, copy int, keeper long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 7, 8) for r in rows], PAGES)


def archive(spark, rows):
    path = fresh_path(spark, "test-warc")
    W.write(pages(spark, rows), path)
    return path


def brute(rows):
    """``(page_id, payload_bytes, digest, type, refers_to)`` of each row."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            again = len(raw) >= 1000 and k < len(ids) - 1
            out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", ids[-1] if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str
    )


def odd_pages():
    r = random.Random(13)
    long = "x" * 999
    texts = [
        None, "", "short", long, long + "y", "é" * 499 + "z", "é" * 500, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" + "p" * 990,
        "\r\n\r\n" * 300, "漢字 <html>\n" * 100, "end\r\n", "\x00\x0b\x85 " * 400, "q" * 200_000,
    ]
    urls = ["http://www.b.example.com/x?q=1", "https://a.example.com", None, "", "no url", "http://[bad", "http://c.org/a b\r\nX: y", "HTTP://C.org:8080/É", "http://a.example.com/" + "p" * 500]
    rows = [(n, r.choice(urls), r.choice(texts)) for n in range(300)]
    rows += [(None, None, texts[4]), (None, "u", texts[4]), (None, None, "only without id" * 100), (None, None, "only without id" * 100), (-5, "u", "neg" * 500)]
    # The largest id several times, with one URL and with several.
    rows += [(999, u, "tied" * 300) for u in ("http://t/2", "http://t/1", "http://t/1", None)] + [(5, "http://t/1", "tied" * 300)] * 2
    return rows


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_round_trip(spark, monkeypatch, broadcast):
    monkeypatch.setattr(W, "BROADCAST_DIGESTS", broadcast)
    rows = odd_pages()
    found = W.capture_index(spark, archive(spark, rows))
    assert result(found) == brute(rows)
    got = found.collect()
    assert all(r.intact for r in got)
    # One record holds a payload of each shared digest, and the revisits name its id.
    held = {r.record_id: r.payload_digest for r in got if r.record_type == "response"}
    assert len({r.payload_digest for r in got if r.payload_bytes >= 1000}) == sum(r.record_type == "response" and r.payload_bytes >= 1000 for r in got)
    for r in got:
        if r.refers_to is not None:
            assert held[f"<urn:page:{r.refers_to}:{r.payload_digest}>"] == r.payload_digest
    urls = sorted((r.url or "") for r in got)
    assert urls == sorted((u or "").replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in rows)


def test_records_lie_where_the_index_says(spark):
    rows = odd_pages()
    want = {(i, html or "") for i, _, html in rows}
    for r in W.capture_index(spark, archive(spark, rows)).collect():
        with open(r.file.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            piece = f.read(r.length)
        [(_, length, header, block)] = W.records(piece)
        assert length == r.length and header["WARC-Record-ID"] == r.record_id
        if r.record_type == "response":
            assert (r.page_id, bytes(block).split(b"\r\n\r\n", 1)[1].decode()) in want


def test_index_is_in_order(spark):
    """Small runs and ranges; one URL holds a third of the captures."""
    r = random.Random(2)
    rows = [(n, "http://hot.example.com/" if n % 3 == 0 else f"http://h{r.randint(0, 40)}.org/{r.randint(0, 5)}", "x" * n) for n in range(900)]
    path = archive(spark, rows)
    # Times do not follow the page numbers.
    found = W.captures(spark, path).withColumn("timestamp", F.date_format(F.timestamp_seconds(F.col("page_id") * 7919 % 1009 * 1000), "yyyyMMddHHmmss"))
    table = fresh_path(spark, "test-captures")
    found.write.parquet(table)
    index = W.merge_index(spark.read.parquet(table), range_captures=50, run_captures=64)
    got = index.orderBy("position").collect()
    assert [x.position for x in got] == list(range(900))
    keys = [(x.url_key, x.timestamp, x.record_id) for x in got]
    assert keys == sorted(keys) and len(set(x.record_id for x in got)) == 900
    # The hot URL is dealt to several ranges.
    cuts = W.splitters(spark.read.parquet(table), 18)
    assert sum(c[0] == "com,example,hot)/" for c in cuts) >= 3
    # Rows come out in order without a sort.
    assert all(a.position < b.position for a, b in zip(got, got[1:]))


def test_few_rows(spark):
    path = fresh_path(spark, "test-warc")
    W.write(spark.createDataFrame([], PAGES), path)
    assert W.capture_index(spark, path).count() == 0
    one = W.capture_index(spark, archive(spark, [(None, None, None)])).first()
    assert (one.page_id, one.url, one.url_key, one.payload_bytes, one.record_type, one.position) == (None, None, "", 0, "response", 0)


def test_damage_is_found(spark):
    path = archive(spark, [(1, "u", "text of the page")])
    content = spark.read.format("binaryFile").load(path).first().content
    [(at, n, header, block)] = W.records(bytes(content))
    assert W.capture("f", at, n, header, block)[9]
    [(at, n, header, block)] = W.records(bytes(content).replace(b"text of", b"test of"))
    assert not W.capture("f", at, n, header, block)[9]
    with pytest.raises(ValueError):
        list(W.records(bytes(content).replace(b"text of", b"text")))


def test_loser_tree():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 50):
        runs, keys = [], []
        for _ in range(k):
            run = sorted(r.randint(0, 20) for _ in range(r.choice([0, 1, 5, 30])))
            runs.append((len(keys), len(keys) + len(run)))
            keys += run
        order = list(W.LoserTree(keys, runs))
        assert sorted(order) == list(range(len(keys)))
        # Stable: equal keys in the order of the runs.
        assert order == sorted(range(len(keys)), key=lambda i: (keys[i], i))


def test_url_key():
    assert W.url_key("http://www.Example.com/A?b=C") == "com,example)/a?b=c"
    assert W.url_key("https://example.com:443") == W.url_key("http://example.com/")
    assert W.url_key("http://example.com:8080/") == "com,example:8080)/"
    assert W.url_key(None) == "" and W.url_key("Plain") == "plain"
