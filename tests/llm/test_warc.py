import gzip
import hashlib

import pytest

from threadsift.llm import warc

DATE = "2020-01-01T00:00:00Z"


def archive(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write_archives(warc.page_records(pages), path)
    return path


def read(spark, path, **options):
    return [r.asDict() for r in warc.read_archives(spark, path, **options).collect()]


def test_pages_and_revisits(spark, tmp_path):
    long, short = "é" * 50, "x" * 99
    rows = [(3, "http://a/\n", long), (1, "http://b/", long), (2, None, long), (4, "u", short), (5, "u", short), (6, "u", None), (7, "u", "")]
    got = {warc.page_of(r["record_id"]): r for r in read(spark, archive(spark, tmp_path, rows), keep_payload=True)}
    assert {k: r["record_type"] for k, r in got.items()} == {1: "response", 2: "revisit", 3: "revisit", **dict.fromkeys((4, 5, 6, 7), "response")}
    assert {k: warc.page_of(r["refers_to"]) for k, r in got.items() if r["refers_to"]} == {2: 1, 3: 1}
    for k, _, html in rows:
        data = (html or "").encode()
        assert (got[k]["payload_bytes"], got[k]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert got[1]["payload"] == long.encode() and got[3]["target_uri"] == "http://a/%0A" and got[2]["target_uri"] is None
    assert all(r["error"] is None for r in got.values())


def test_null_and_repeated_ids(spark, tmp_path):
    long = "y" * 200
    rows = [(None, "u", long), (None, "v", long), (8, "u", long), (8, "u", long), (None, "u", "z" * 200)]
    got = read(spark, archive(spark, tmp_path, rows))
    kinds = sorted((warc.page_of(r["record_id"]) or 0, r["record_type"], warc.page_of(r["refers_to"]) or 0) for r in got)
    assert kinds == [(0, "response", 0), (0, "revisit", 8), (0, "revisit", 8), (8, "response", 0), (8, "response", 0)]


def test_no_pages(spark, tmp_path):
    assert read(spark, archive(spark, tmp_path, [])) == []


def test_files_are_gzip_members(spark, tmp_path):
    path = archive(spark, tmp_path, [(i, "u", f"page {i}" * 40) for i in range(20)])
    data = b"".join(p.read_bytes() for p in (tmp_path / "archive").glob("part*"))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 20 and path


@pytest.mark.parametrize("size", [0, 1, 70_000, 17 << 20])
def test_round_trip_of_one_record(size):
    payload = (b"0123456789abcdef" * (size // 16 + 1))[:size]
    data = warc.member(5, "http://a", payload, hashlib.sha256(payload).hexdigest(), None, DATE)
    whole = data + b"\0" * (data[-1] != 0) + data
    records = list(warc.records_of(whole, keep_payload=True))
    assert [r.payload == payload and r.error is None and r.payload_bytes == size for r in records] == [True, True]


def test_damage_is_reported_and_skipped():
    good = [warc.member(i, "u", b"p%d" % i * 99, hashlib.sha256(b"p%d" % i * 99).hexdigest(), None, DATE) for i in range(3)]
    broken = bytearray(good[1])
    broken[40] ^= 0xFF
    records = list(warc.records_of(good[0] + bytes(broken) + good[2]))
    assert records[0].error is None and records[-1].error is None and len(records) >= 3
    assert any(r.error for r in records)
    wrong = warc.member(1, "u", b"text", "0" * 64, None, DATE)
    assert next(warc.records_of(wrong)).error == "payload digest differs"
    cut = gzip.compress(gzip.decompress(good[0])[:-30])
    assert "lacks" in next(warc.records_of(cut)).error
