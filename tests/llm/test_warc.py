"""Archives: exact round trips, revisits, pushed-down predicates, archives from elsewhere."""

import gzip
import hashlib
from collections import Counter

import pytest

from contractframe.llm import warc


@pytest.fixture(scope="module")
def rows():
    big, huge = "<p>é" * 400, "x" * 3_000_000
    rows = [(i, f"http://a/{i}", f"<html>{i}</html>" * (i % 200)) for i in range(150)]
    rows += [(200 + i, "http://copy\r\nX: 1", big) for i in range(30)]
    rows += [(300, None, None), (301, "", ""), (302, "u", huge), (303, "u", huge), (304, "u", "y" * 1000), (305, "u", "y" * 1000), (306, "u", "z" * 999), (307, "u", "z" * 999)]
    rows += [(400, "same", big + "1"), (400, "same", big + "1"), (None, "none", big + "1"), (None, "lone", big + "2"), (500, "crlf", "a\r\n\r\nb\x00" * 300)]
    return [(*r, "extra", 1) for r in rows]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string, record_type int").repartition(3)


def wanted(rows):
    groups = {}
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        groups.setdefault(payload, []).append(page)
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        first = max((p for p in groups[payload] if p is not None), default=None)
        revisit = len(payload) >= 1000 and len(groups[payload]) > 1 and page != first
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


def test_pages(spark, pages, rows, tmp_path):
    got = warc.archive_pages(pages, f"file://{tmp_path}/a")
    assert Counter(tuple(r) for r in got.collect()) == Counter(wanted(rows))


def test_payloads_and_predicates(spark, pages, rows, tmp_path):
    folder = f"file://{tmp_path}/b"
    warc.write_warc(warc.page_records(pages), folder)
    whole = warc.read_warc(spark, folder)
    texts = {r["record_id"]: bytes(r["payload"]) for r in whole.where("record_type = 'response'").collect()}
    assert "urn:page:302" not in texts and texts["urn:page:303"] == b"x" * 3_000_000
    assert texts["urn:page:500"] == ("a\r\n\r\nb\x00" * 300).encode()
    assert texts["urn:page:300"] == b""
    plain = [r for r in whole.where("record_type = 'revisit' AND record_id = 'urn:page:200'").collect()]
    assert len(plain) == 1 and plain[0]["refers_to"] == "urn:page:229" and plain[0]["payload_length"] == 2000
    assert plain[0]["target_uri"] == "http://copy%0D%0AX:%201"
    found = warc.read_warc(spark, folder, payload=False).where("target_uri LIKE 'http://a/%' AND record_id IN ('urn:page:7', 'urn:page:300')")
    assert [r["record_id"] for r in found.collect()] == ["urn:page:7"]
    assert "payload" not in found.columns


def test_reader_takes_header_predicates():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith
    from pyspark.sql.types import _parse_datatype_string

    reader = warc.WarcReader("x", _parse_datatype_string("record_type string"))
    rest = list(reader.pushFilters([
        EqualTo(("record_type",), "response"), In(("record_id",), ("a", "b")), StringStartsWith(("target_uri",), "h"), GreaterThan(("payload_length",), 1), EqualTo(("payload",), b""),
    ]))
    assert [type(f).__name__ for f in rest] == ["GreaterThan", "EqualTo"]
    assert reader._keeps({"record_type": "response", "record_id": "a", "target_uri": "http"})
    assert not reader._keeps({"record_type": "revisit", "record_id": "a", "target_uri": "http"})
    assert not reader._keeps({"record_type": "response", "record_id": "c", "target_uri": None})


def test_rejected_payloads_are_not_inflated(monkeypatch, tmp_path):
    import pyarrow.fs as fs

    member = warc.gzip_member(warc.record_bytes("response", "urn:page:1", bytes(5_000_000), digest_hex="00" * 20, length=5_000_000))
    (tmp_path / "one").write_bytes(member * 3)
    monkeypatch.setattr(warc._Gzip, "whole", lambda self: pytest.fail("a payload was inflated"))
    file = fs.LocalFileSystem().open_input_file(str(tmp_path / "one"))
    found = list(warc.records(file))
    assert len(found) == 3 and all(len(r.start) < 5_000_000 for r in found)


def test_archives_from_elsewhere(spark, tmp_path):
    def record(i):
        body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\npage {i}".encode()
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    (tmp_path / "plain.warc").write_bytes(b"".join(record(i) for i in range(5)))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(record(i)) for i in range(5, 9)))
    got = warc.read_warc(spark, f"file://{tmp_path}").collect()
    assert sorted((r["record_id"], bytes(r["payload"]).decode()) for r in got) == [(f"urn:page:{i}", f"page {i}") for i in range(9)]


def test_uncommitted_files_are_not_read(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/c"
    warc.write_warc(warc.page_records(pages), folder)
    (tmp_path / "c" / "part-lost.warc.gz").write_bytes(b"broken")
    assert warc.read_warc(spark, folder, payload=False).count() == pages.count()


def test_no_pages(spark, pages, tmp_path):
    assert warc.archive_pages(pages.limit(0), f"file://{tmp_path}/d").collect() == []


def test_http_heads_behind_long_headers():
    """Headers that end anywhere around the first bytes read leave the HTTP head whole."""
    import random

    class File:
        def __init__(self, raw):
            self.raw = raw

        def size(self):
            return len(self.raw)

        def read_at(self, n, at):
            return self.raw[at : at + n]

    letters = random.Random(3).choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_", k=4200)
    for pack, sizes in ((warc.gzip_member, range(2000, 2600, 2)), (lambda r: r, range(3400, 4200, 7))):
        for n in sizes:
            one = warc.record_bytes("revisit", "urn:x", b"", digest_hex="00" * 20, length=1234567, target_uri="".join(letters[:n]), date=None, refers_to="urn:y")
            found = [warc._header_row(r) for r in warc.records(File(pack(one) * 2))]
            assert [r["payload_length"] for r in found] == [1234567] * 2, n
