import hashlib

import pytest
import zstandard

from tidemark.llm import warc


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, archive string")


def read(spark, frame):
    return warc.read_archives(spark, warc.write_archives(frame)).collect()


def test_round_trip_with_revisits(spark, pages):
    big, small = "é" * 700, "x" * 999
    rows = [(1, "http://a/é b", big, "q"), (5, None, big, "q"), (3, "u", big, "q"), (2, "u", small, "q"), (4, "u", small, "q"), (6, "u", None, "q"), (7, "", "", "q")]
    found = {r["page_id"]: r for r in read(spark, pages(rows))}
    assert all(r["error"] is None for r in found.values()) and len(found) == len(rows)
    for page_id, url, html, _ in rows:
        data, r = (html or "").encode(), found[page_id]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        again = page_id in (1, 3)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 5) if again else ("response", None))
        assert again or bytes(r["payload"]) == data
    assert found[1]["url"] == "http://a/%C3%A9%20b" and found[5]["url"] is None and found[7]["url"] is None


def test_repeated_rows_null_ids_and_empty_tables(spark, pages):
    big = "z" * 2000
    found = read(spark, pages([(1, "u", big, ""), (2, "u", big, ""), (2, "u", big, ""), (None, "u", big, "")]))
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found) == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None)]
    found = read(spark, pages([(None, "u", big, ""), (None, "u", big, "")]))
    assert [(r["page_id"], r["record_type"]) for r in found] == [(None, "response")] * 2
    assert read(spark, pages([])) == []


def archive(records, dictionary=warc._TEMPLATE):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
    return warc.dictionary_frame(dictionary) + b"".join(packer.compress(r) + warc.SEPARATOR.encode("latin1") for r in records)


def test_records_and_frames_are_validated():
    good = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").digest(), None)
    wrong = [
        (good.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (good.replace(b"WARC-Date", b"WARC-Data"), "warc-date"),
        (good.replace(b"payload\r\n\r\n", b"pay\r\n\r\n"), "length in its header"),
        (good.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"), "digest"),
        (good.replace(b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"), "HTTP"),
    ]
    found = list(warc.read_archive(archive([good, *(w for w, _ in wrong), good])))
    assert [r.error is None for r in found] == [True, *[False] * len(wrong), True]
    assert all(text in r.error for r, (_, text) in zip(found[1:], wrong))
    whole = archive([good, good])
    assert [r.error is None for r in warc.read_archive(whole[:-20])] == [True, False]
    bent = bytearray(whole)
    bent[-15] ^= 0xFF
    assert list(warc.read_archive(bytes(bent)))[-1].error
    packed = zstandard.ZstdCompressor().compress(warc._TEMPLATE)
    other = warc.dictionary_frame(packed) + archive([good])[len(warc.dictionary_frame(warc._TEMPLATE)) :]
    assert [r.error for r in warc.read_archive(other)] == [None]
    assert list(warc.read_archive(b"")) == []


def foreign(kind, block, *headers):
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:0b9d6c1e-0000-4000-8000-000000000001>", "WARC-Date: 2020-01-01T00:00:00Z", *headers]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    records = [
        foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"),
        foreign("response", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\nbody", http, "WARC-Payload-Digest: sha256:abcdef"),
        foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: x\r\n\r\nbody", http, "WARC-Payload-Digest: sha1:!!"),
        foreign("response", b"HTTP/1.1 200 OK\r\ncontent-length : 4\r\n\r\nbody", http),
        foreign("response", b"no header at all", http),
        foreign("revisit", b"HTTP/1.1 304\r\n\r\n", http, "WARC-Refers-To: <urn:uuid:1>"),
        foreign("resource", b"", "Content-Type: text/plain", f"WARC-Payload-Digest: SHA1:{'A' * 32}"),
        foreign("response", b"\xff\xfe", "Content-Type: image/png"),
        b"WARC/1.1\r\n: \r\n\r\n",
        b"",
    ]
    path = tmp_path / "foreign"
    path.mkdir()
    (path / "a.warc.zst").write_bytes(archive(records))
    (path / "b.warc.zst").write_bytes(b"not an archive")
    (path / "c.warc.zst").write_bytes(b"")
    found = sorted(warc.read_archives(spark, str(path)).collect(), key=lambda r: (r["archive"], r["offset"]))
    a = [(r["record_type"], r["page_id"], None if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"], r["payload_digest"], r["error"] is None) for r in found[:-1]]
    assert a == [
        ("warcinfo", None, b"software: x\r\n", 13, None, True),
        ("response", None, b"body", 4, None, True),
        ("response", None, b"body", 4, None, False),
        ("response", None, b"body", 4, None, True),
        ("response", None, b"", 0, None, True),
        ("revisit", None, None, None, None, True),
        ("resource", None, b"", 0, "00" * 20, False),
        ("response", None, b"\xff\xfe", 2, None, True),
        (None, None, None, None, None, False),
        (None, None, None, None, None, False),
    ]
    assert found[-1]["archive"].endswith("b.warc.zst") and found[-1]["error"]


def test_very_long_payloads(spark, pages):
    long = "é0123456789" * 1_500_000
    found = read(spark, pages([(1, "u", long, ""), (2, "u", long, ""), (3, "u", "", "")]))
    assert sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["error"]) for r in found) == [
        (1, len(long.encode()), "revisit", None), (2, len(long.encode()), "response", None), (3, 0, "response", None)
    ]
