import hashlib
import io
import struct
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import warc as W
from tallyspark.session import scratch_root

BIG = "<p>é " + "x" * 1200
SCHEMA = "page_id long, url string, html string, digest string, best int, record string"


def page_rows():
    rows = [(1, "http://a/", BIG), (2, "http://b/: x", BIG), (3, None, BIG), (4, "u", None), (5, "u", ""),
            (6, "u", "small"), (7, "u", "small"), (8, "u", "y" * 1000), (9, "u", "y" * 1000),
            (10, "u", "z" * 999), (11, "u", "z" * 999), (None, "u", "y" * 1000), (None, "u", "q" * 2000),
            (12, "u\r\nX-Page-ID: 9", "a\r\n\r\nWARC/1.1\r\n"), (13, "u", "L" * 900_000), (14, "u", "L" * 900_000)]
    return [(*r, "clash", 1, "clash") for r in rows]


def brute(rows):
    best = defaultdict(list)
    for i, _, h, *_ in rows:
        best[h or ""].append(i)
    out = []
    for i, _, h, *_ in rows:
        p = (h or "").encode()
        ids = [x for x in best[h or ""] if x is not None]
        top = max(ids) if ids and len(p) >= 1000 and len(best[h or ""]) > 1 else i
        refers = None if top == i else top
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def read(index):
    rows = W.read_bundles(index.select("bundle").distinct())
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in rows.collect()), key=str)


def test_round_trip_of_odd_rows(spark):
    pages = spark.createDataFrame(page_rows(), SCHEMA)
    index = W.write_bundles(W.planned(pages), scratch_root(spark), frame_bytes=3000, bundle_bytes=5000)
    assert read(index) == brute(page_rows())
    assert index.select("bundle").distinct().count() > 1
    assert index.agg(F.countDistinct("record")).first()[0] == len(page_rows())


def test_random_access_gives_the_payloads(spark):
    pages = spark.createDataFrame([r for r in page_rows() if r[0] is not None], SCHEMA)
    index = W.write_bundles(W.planned(pages), scratch_root(spark), frame_bytes=3000)
    want = {r[0]: (r[2] or "").encode() for r in page_rows() if r[0] in (1, 4, 8, 12, 13, 14)}
    ids = spark.createDataFrame([(i,) for i in want], "page_id long")
    assert {r["page_id"]: bytes(r["payload"]) for r in W.lookup(index, ids).collect()} == want


def test_pages_match_brute_force(spark):
    d = "/root/testdata/sf0.001"
    got = W.op6_warc(spark, d)
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    index = W.write_bundles(W.planned(spark.createDataFrame([], SCHEMA)), scratch_root(spark))
    assert index.count() == 0 and read(index) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=200), max_size=30), st.integers(1, 500))
def test_bundles_give_back_every_record_by_its_place(payloads, frame_bytes):
    out = io.BytesIO()
    writer = W.BundleWriter(out, frame_bytes)
    places = []
    for i, p in enumerate(payloads):
        data = W.record_bytes(str(i), i, "http://x/", p, hashlib.sha1(p).hexdigest(), None, None)
        places.append((*writer.add(data), len(data)))
    writer.close()
    reader = W.BundleReader(out)
    for (frame, offset, length), (i, p) in zip(places, enumerate(payloads)):
        head, block = reader.record(frame, offset, length)
        assert block == p and head["X-Page-ID"] == str(i)
    everything = [b for i in range(len(reader.frames)) for _, b in W.parse_records(reader.frame(i))]
    assert everything == payloads


def test_damage_is_found():
    out = io.BytesIO()
    writer = W.BundleWriter(out)
    writer.add(W.record_bytes("1", 1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), None, None))
    writer.close()
    head, block = next(W.parse_records(W.BundleReader(out).frame(0)))
    with pytest.raises(ValueError):
        W.read_record(head, block)
    data = bytearray(out.getvalue())
    data[-13:-9] = struct.pack("<I", 1)   # the checksum in the seek table
    with pytest.raises(ValueError):
        W.BundleReader(io.BytesIO(bytes(data))).frame(0)
    with pytest.raises(ValueError):
        W.BundleReader(io.BytesIO(b"not a bundle at all"))
