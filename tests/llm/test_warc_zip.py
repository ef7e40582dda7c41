import base64
import hashlib
import io
import struct
import zipfile

import pyarrow as pa
import pytest
from pyarrow import fs

from spendlake.llm import warc_zip
from spendlake.llm.queries import QUERIES

from .fixtures import SF, table


def brute(pages, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row."""
    out, first = [], {}
    for p, html in pages:
        body = (html or "").encode()
        if p is not None and len(body) >= least:
            first[body] = min(first.get(body, p), p)
    for p, html in pages:
        body = (html or "").encode()
        refers = first.get(body)
        if refers == p or len(body) < least:
            refers = None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((p, len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def as_rows(df):
    return sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    pages = [(r["page_id"], r["html"]) for r in table(spark, "pages").collect()]
    assert as_rows(QUERIES["op9_warc_zip"](spark, SF)) == brute(pages)


PAGES = [(5, "http://a/", "<p>same é</p>"), (3, "http://b/\r\nX: y", "<p>same é</p>"), (9, None, "<p>same é</p>"),
         (1, "http://c/", None), (2, "http://c/", ""), (4, "http://d/", "x"), (4, "http://d/", "x"), (6, "u", "x"),
         (None, "http://e/", "<p>same é</p>"), (None, "http://e/", "alone"), (7, "http://f/", "a\r\n\r\nb" * 9000),
         (8, "http://g/", "WARC/1.1\r\n\r\nPK\x05\x06")]


@pytest.mark.parametrize("least", [0, 2])
def test_odd_rows(spark, tmp_path, least):
    pages = spark.createDataFrame([(*p, "extra", 1) for p in PAGES],
                                  "page_id long, url string, html string, digest string, offset int").repartition(3)
    archives = warc_zip.write_archives(pages, str(tmp_path / "a"), least, archive_bytes=400)
    assert archives.count() > 1
    assert as_rows(warc_zip.read_archives(archives, range_records=1)) == brute([(p, h) for p, _, h in PAGES], least)
    payloads = [(r["page_id"], bytes(r["payload"])) for r in warc_zip.read_archives(archives, with_payload=True).collect()
                if r["record_type"] == "response"]
    want = [(p, (h or "").encode()) for p, _, h in PAGES]
    assert all(x in want for x in payloads)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.round_trip(pages, str(tmp_path / "none")).count() == 0


def written(path, n=20):
    writer = warc_zip.ArchiveWriter(fs.LocalFileSystem(), str(path))
    for k in range(n):
        body = f"<p>{k}</p>".encode() * (k + 1)
        writer.add(k, warc_zip.warc_record(k, f"http://x/{k}", body, warc_zip.sha1_base32(body), None))
    writer.close()


def reader(raw):
    return warc_zip.ArchiveReader(pa.BufferReader(raw), len(raw))


def check(archive, n=20):
    got = list(archive.records(archive.index()))
    assert [int(h["x-page-id"]) for h, _ in got] == list(range(n))
    assert [p for _, p in got] == [f"<p>{k}</p>".encode() * (k + 1) for k in range(n)]


def test_other_zip_readers_accept_the_archives(tmp_path):
    written(tmp_path / "a.wacz")
    with zipfile.ZipFile(tmp_path / "a.wacz") as z:
        assert z.testzip() is None
        assert {i.filename: i.compress_type for i in z.infolist()} == {
            warc_zip.WARC_MEMBER: 0, warc_zip.INDEX_MEMBER: 0}
    check(reader((tmp_path / "a.wacz").read_bytes()))


def test_zip64_directory_and_comment(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)  # sizes, offsets and the directory then need ZIP64
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    written(tmp_path / "a.wacz")
    raw = (tmp_path / "a.wacz").read_bytes()
    assert warc_zip.LOCATOR64 in raw and warc_zip.END64 in raw
    at = raw.rfind(warc_zip.END)
    assert struct.unpack_from("<H", raw, at + 10)[0] == 0xFFFF or struct.unpack_from("<I", raw, at + 16)[0] == 0xFFFFFFFF \
        or struct.unpack_from("<H", raw, at + 10)[0] == 2
    check(reader(raw))
    comment = b"note PK\x05\x06 with the signature" + bytes(30)
    check(reader(raw[:at + 20] + struct.pack("<H", len(comment)) + comment))


def test_wide_fields_are_read_from_the_extra_field():
    extra = struct.pack("<HHI", 7, 4, 1) + struct.pack("<HHQQ", 1, 16, 1 << 33, 1 << 34)
    assert warc_zip._wide(extra, 5, 0xFFFFFFFF, 0xFFFFFFFF) == [5, 1 << 33, 1 << 34]


def test_damage_is_noticed(tmp_path):
    written(tmp_path / "a.wacz")
    raw = (tmp_path / "a.wacz").read_bytes()
    for broken in (raw[:-30], b"", raw[:40]):
        with pytest.raises((ValueError, OSError)):
            check(reader(broken))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc_zip.INDEX_MEMBER, b"{}")
    with pytest.raises(ValueError, match="compressed"):
        reader(packed.getvalue()).index()
