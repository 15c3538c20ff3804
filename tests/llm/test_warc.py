import gzip
import hashlib
import io
import json
import os
import tempfile

import pytest
from cases import SF_TINY

from reclaim.llm import warc

PAGES = "page_id long, url string, html string, record_type string, path string"
BIG = "é" * 600  # 1200 bytes


def rows():
    return [
        (1, "http://a/ä b%20\r\nX", "small", "x", "p"), (2, "http://a", "small", "x", "p"), (3, None, None, "x", "p"), (4, "", "", "x", "p"),
        (5, "u", BIG, "x", "p"), (7, "u", BIG, "x", "p"), (6, "u", BIG, "x", "p"), (None, "u", BIG, "x", "p"), (8, "u", "y" * 999, "x", "p"),
        (9, "u", "y" * 999, "x", "p"), (10, "u", "z" * 1000, "x", "p"), (11, "u", "z" * 1000, "x", "p"), (12, "u", "q" * 3_000_000, "x", "p"),
        (20, "u", "w" * 1500, "x", "p"), (20, "u", "w" * 1500, "x", "p"), (None, "u", "only" * 400, "x", "p"),
        (21, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n" * 40, "x", "p"),
    ]


def expected(data):
    best = {}
    for i, _, html, *_ in data:
        raw = (html or "").encode()
        if len(raw) >= 1000 and i is not None:
            best[raw] = max(i, best.get(raw, i))
    out = []
    for i, _, html, *_ in data:
        raw = (html or "").encode()
        again = raw in best and best[raw] != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best[raw] if again else None))
    return sorted(out, key=repr)


def test_round_trip_with_revisits(spark):
    got = warc.archive_pages(spark, spark.createDataFrame(rows(), PAGES))
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == expected(rows())


def test_archives_members_and_index(spark):
    folder = tempfile.mkdtemp(prefix="warc-")
    whole = warc.write(warc.records(spark.createDataFrame(rows(), PAGES).coalesce(1)), folder, archive_mb=1).collect()
    assert sum(r.n_records for r in whole) == len(rows()) and len(whole) > 1  # a new archive after 1 MB
    members = warc.normalise(spark.createDataFrame(whole), folder).collect()
    for old, new in zip(sorted(whole, key=lambda r: r.n_records), sorted(members, key=lambda r: r.n_records)):
        assert gzip.open(old.path).read() == gzip.open(new.path).read()  # the same records
        index = [json.loads(x) for x in open(new.path + ".idx")]
        raw = open(new.path, "rb").read()
        assert sum(x["length"] for x in index) == len(raw) == os.path.getsize(new.path)
        for x in index:
            one = gzip.decompress(raw[x["offset"] : x["offset"] + x["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and x["id"].encode() in one
    back = warc.read(spark.createDataFrame(members), folder).collect()
    urls = {r.page_id: r.url for r in back}
    assert urls[1] == rows()[0][1] and urls[3] == ""
    assert {r.page_id: r.payload.decode() for r in back if r.page_id == 12} == {12: "q" * 3_000_000}


def test_normalising_twice_changes_nothing():
    recs = [{"page_id": i, "url": "u", "payload": b"x" * i, "payload_bytes": i, "payload_digest": hashlib.sha1(b"x" * i).hexdigest(), "record_type": "response", "refers_to": None} for i in range(5)]
    data = b"".join(a + r["payload"] + b for r in recs for a, b in [warc.record_bytes(r)])
    first, second = io.BytesIO(), io.BytesIO()
    one = warc.rewrite(io.BytesIO(gzip.compress(data)), first)
    two = warc.rewrite(io.BytesIO(first.getvalue()), second)
    assert one == two and first.getvalue() == second.getvalue() and gzip.decompress(second.getvalue()) == data


def test_damage_is_noticed():
    r = {"page_id": 1, "url": "u", "payload": b"abc", "payload_bytes": 3, "payload_digest": hashlib.sha1(b"abd").hexdigest(), "record_type": "response", "refers_to": None}
    head, tail = warc.record_bytes(r)
    with pytest.raises(ValueError, match="differ"):
        warc.member(gzip.compress(head + b"abc" + tail))
    with pytest.raises(ValueError, match="ends inside"):
        warc.rewrite(io.BytesIO(gzip.compress(head + b"a")), io.BytesIO())


def test_real_and_empty_tables(spark):
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet")
    got = warc.archive_pages(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    assert warc.archive_pages(spark, spark.createDataFrame([], PAGES)).collect() == []
