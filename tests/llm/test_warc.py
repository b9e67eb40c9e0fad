import hashlib
import io

import pytest
from hypothesis import given, settings, strategies as st

from flowlab.llm.queries import ORACLES, QUERIES
from flowlab.llm.warc import WarcError, member, read_warc, record, records, warc_round_trip, write_warc
from flowlab.storage import scratch_path
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def archive(payloads):
    return b"".join(member(record(i, f"http://x/{i}", p, sha(p), None, "")) for i, p in enumerate(payloads))


def test_query(spark):
    assert differences(QUERIES["op9_warc"](spark, SF_DIR), ORACLES["op9_warc"], connect(SF_DIR)) is None


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=6))
def test_round_trip(payloads):
    found = list(records(io.BytesIO(archive(payloads))))
    assert [r["payload"] for r in found] == payloads
    assert [r["offset"] for r in found] == [len(archive(payloads[:i])) for i in range(len(payloads))]


@pytest.mark.parametrize("size", [0, 1, 65_535, 65_536, 3_000_000])
def test_large_payloads(size):
    payload = bytes(i * 7 % 251 for i in range(size))
    assert [r["payload"] for r in records(io.BytesIO(archive([payload, b"x"])))] == [payload, b"x"]


@pytest.mark.parametrize("cut", [1, 5, 30])
def test_cut_archive_raises(cut):
    with pytest.raises(WarcError):
        list(records(io.BytesIO(archive([b"abc" * 50])[:-cut])))


def test_damage_raises():
    whole = record(1, "u", b"payload", sha(b"payload"), None, "")
    for bad in (
        whole.replace(b"payload\r\n\r\n", b"payloaD\r\n\r\n"), whole.replace(b"WARC/1.1", b"HTTP/1.1"),
        whole + b"x", whole[:-3], whole.replace(b"\r\nContent-Length", b"\r\nX-Length", 1), whole.replace(b"WARC-Type:", b"WARC-Type"),
    ):
        with pytest.raises(WarcError):
            list(records(io.BytesIO(member(bad))))
    with pytest.raises(WarcError):
        list(records(io.BytesIO(member(whole + whole))))
    with pytest.raises(WarcError):
        list(records(io.BytesIO(member(whole) + b"junk after the last member")))


def test_header_values_stay_on_one_line():
    data = member(record(1, "http://x/\r\nWARC-Type: revisit", b"p", sha(b"p"), None, ""))
    (found,) = records(io.BytesIO(data))
    assert found["record_type"] == "response" and "%0D%0A" in found["url"]


def test_edges(spark):
    big = "é" * 60
    rows = [(5, "u5", big), (3, None, big), (None, "n", big), (3, None, big), (7, "", "x"), (8, "u", "x"), (9, "u", None), (10, "u", "z" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "'a' as payload")
    for file_bytes in (1, 1 << 30):
        found = warc_round_trip(pages, payloads=True, file_bytes=file_bytes).collect()
        got = sorted(((r.page_id, r.url, r.record_type, r.original, r.payload_bytes, r.payload_digest) for r in found), key=str)
        want = sorted((
            (p, u, "revisit" if h == big and p != 3 else "response", 3 if h == big and p != 3 else None, len((h or "").encode()), sha((h or "").encode()))
            for p, u, h in rows
        ), key=str)
        assert got == want
        assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert warc_round_trip(pages.limit(0)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    manifest = write_warc(pages, scratch_path(spark, "warc-test"), min_shared=1 << 40)
    back = sorted((r.url, bytes(r.payload).decode()) for r in read_warc(manifest).collect())
    assert back == sorted((r.url, r.html) for r in pages.collect())
