"""WARC records in ZIP archives: a writer, and a reader that never extracts.

An archive is a ZIP file with two stored (uncompressed) members:
``archive/data.warc.gz``, one gzip member for each WARC record, and
``indexes/index.cdxj``, one line for each record with its offset and length.
The reader takes the end record and, where present, the ZIP64 end record from
the file's tail, parses the central directory, finds the members and the
bytes where they start, reads the index, and then reads each record by its
range; ranges that adjoin are read together up to ``RANGE_BYTES``.

Which record carries a payload is decided before anything is written.  Of
pages whose payloads are equal and have ``min_revisit_bytes`` or more bytes,
the one with the smallest page_id is a response and the others are revisits
of it, without payload; smaller payloads are all responses.

Archives go to a folder that all executors share.  Each task names its files
anew, and only the names returned by the task that counts are read, so files
of lost or repeated tasks do no harm.  An archive is closed at about
``archive_bytes``; a task holds one page and one range at a time.

Defined cases: a null html has an empty payload; a null page_id is written
without one and is never the page others refer to; repeated rows are repeated
records; an empty table gives no archives and no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import cut, scratch_path
from spendlake.sources.files import open_filesystem

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
RANGE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

# The ZIP format's signatures and field sizes.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_SIZE, LOCATOR64_SIZE, CENTRAL_SIZE, LOCAL_SIZE, MAX_COMMENT = 22, 56, 20, 46, 30, 65535


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# --- records -----------------------------------------------------------------

def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit without its payload."""
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = status if refers_to is not None else status + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-cased names) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[:int(headers["content-length"])]
    if len(block) != int(headers["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    return headers, block.partition(b"\r\n\r\n")[2]


# --- archives ----------------------------------------------------------------

class ArchiveWriter:
    """One archive under way: records go to the WARC member, index lines are kept till the end."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.stream = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(_WriteOnly(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX_MEMBER, "w", force_zip64=True) as member:
            member.write("".join(line + "\n" for line in self.index).encode("utf-8"))
        self.zip.close()
        self.stream.close()


class _WriteOnly:
    """An output stream that ``zipfile`` takes for one that cannot seek."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


class ArchiveReader:
    """Members and records of one archive, read by range from a random-access file."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = self._directory()

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        got = self.file.read(length)
        if len(got) != length:
            raise ValueError("archive is cut short")
        return got

    def _directory(self) -> dict[str, tuple[int, int, int, int]]:
        """name -> (method, offset of the local header, stored size, CRC)."""
        tail_at = max(0, self.size - END_SIZE - MAX_COMMENT)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(END, 0, at)  # the signature can also be part of a comment
        if at < 0:
            raise ValueError("no end of central directory")
        entries, length, start = struct.unpack_from("<HII", tail, at + 10)
        locator = tail_at + at - LOCATOR64_SIZE
        if locator >= 0 and (raw := self.read(locator, LOCATOR64_SIZE))[:4] == LOCATOR64:
            end64 = self.read(struct.unpack_from("<Q", raw, 8)[0], END64_SIZE)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end record where the locator points")
            entries, length, start = struct.unpack_from("<QQQ", end64, 32)
        directory, pos, out = self.read(start, length), 0, {}
        for _ in range(entries):
            if directory[pos:pos + 4] != CENTRAL:
                raise ValueError("broken central directory")
            method, = struct.unpack_from("<H", directory, pos + 10)
            crc, packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", directory, pos + 16)
            offset, = struct.unpack_from("<I", directory, pos + 42)
            name_at = pos + CENTRAL_SIZE
            name = directory[name_at:name_at + n_name].decode("utf-8")
            extra = directory[name_at + n_name:name_at + n_name + n_extra]
            _, packed, offset = _wide(extra, plain, packed, offset)
            out[name] = (method, offset, packed, crc)
            pos = name_at + n_name + n_extra + n_comment
        return out

    def locate(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes start in the archive, and how many they are."""
        method, offset, length, _ = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; ranges need a stored member")
        local = self.read(offset, LOCAL_SIZE)
        if local[:4] != LOCAL:
            raise ValueError(f"{name}: no local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return offset + LOCAL_SIZE + n_name + n_extra, length

    def index(self) -> list[dict]:
        start, length = self.locate(INDEX_MEMBER)
        raw = self.read(start, length)
        if zlib.crc32(raw) != self.members[INDEX_MEMBER][3]:
            raise ValueError("index does not match its checksum")
        return [json.loads(line) for line in raw.decode("utf-8").splitlines()]

    def records(self, entries: list[dict]) -> Iterator[tuple[dict[str, str], bytes]]:
        """The records at the index entries' ranges; adjoining ranges are read together."""
        start, length = self.locate(WARC_MEMBER)
        k = 0
        while k < len(entries):
            first = entries[k]["offset"]
            end = first + entries[k]["length"]
            last = k + 1
            while last < len(entries) and entries[last]["offset"] == end and end - first < RANGE_BYTES:
                end += entries[last]["length"]
                last += 1
            if first < 0 or end > length:
                raise ValueError("index points outside the member")
            raw = self.read(start + first, end - first)
            for e in entries[k:last]:
                at = e["offset"] - first
                yield parse_record(gzip.decompress(raw[at:at + e["length"]]))
            k = last


def _wide(extra: bytes, *fields: int) -> list[int]:
    """Fields that are all ones stand in the ZIP64 extra field (id 1), in this order."""
    pos, out = 0, list(fields)
    while pos + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, pos)
        if kind == 1:
            at = pos + 4
            for k, v in enumerate(out):
                if v == 0xFFFFFFFF:
                    out[k], = struct.unpack_from("<Q", extra, at)
                    at += 8
        pos += 4 + size
    return out


# --- Spark -------------------------------------------------------------------

def payload_digest(html: Column) -> Column:
    @F.pandas_udf("string")
    def digests(pages: pd.Series) -> pd.Series:
        return pd.Series([sha1_base32((p or "").encode("utf-8")) for p in pages], dtype=object)

    return digests(html)


def record_roles(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of each distinct page and payload; refers_to is null for responses."""
    seen = cut(pages.select("page_id", payload_digest(F.col("html")).alias("digest"),
                            F.octet_length(F.coalesce("html", F.lit(""))).alias("size")).distinct(), "payloads")
    first = cut(seen.filter(F.col("size") >= min_revisit_bytes).groupBy("digest")
                .agg(F.min("page_id").alias("first")).filter("first IS NOT NULL"), "first")
    # two plain tables: AQE splits a payload that a large share of the pages has
    return (seen.join(first, "digest", "left")
            .select("page_id", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")) &
                                                (F.col("size") >= min_revisit_bytes), F.col("first")).alias("refers_to")))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0,
                   archive_bytes: int = 32 << 20) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html); returns (archive, records)."""
    roles = cut(record_roles(pages, min_revisit_bytes), "roles")
    plain = pages.select("page_id", F.col("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
                         "html", payload_digest(F.col("html")).alias("digest"))
    joined = plain.alias("p").join(
        roles.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest")))
    rows = joined.select("p.page_id", "p.url", "p.html", "p.digest", "r.refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = open_filesystem(path)
        filesystem.create_dir(folder, recursive=True)
        writer, name, done = None, "", []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if writer is None:
                        name = f"{uuid.uuid4().hex}.wacz"
                        writer = ArchiveWriter(filesystem, f"{folder}/{name}")
                    payload = (row["html"] or "").encode("utf-8")
                    writer.add(row["page_id"], warc_record(row["page_id"], row["url"], payload, row["digest"],
                                                           row["refers_to"]))
                    if writer.size >= archive_bytes:
                        writer.close()
                        done.append((f"{path}/{name}", len(writer.index)))
                        writer = None
        if writer is not None:
            writer.close()
            done.append((f"{path}/{name}", len(writer.index)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done]), pa.array([n for _, n in done], pa.int64())],
                                             ["archive", "records"])

    return cut(rows.mapInArrow(run, "archive string, records long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = False, range_records: int = 2048) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to[, payload].  A response's payload is checked against its digest.

    Work is dealt out by ranges of ``range_records`` index entries."""
    total = archives.agg(F.sum(F.ceil(F.col("records") / range_records))).first()[0] or 1
    tasks = min(int(total), 8 * archives.sparkSession.sparkContext.defaultParallelism)
    pieces = (archives.select("archive", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("records") - 1, F.lit(0)), F.lit(range_records).cast("long")))
        .alias("first")).repartition(tasks, "archive", "first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                filesystem, path = open_filesystem(piece["archive"])
                out = []
                with filesystem.open_input_file(path) as file:
                    reader = ArchiveReader(file, file.size())
                    entries = reader.index()[piece["first"]:piece["first"] + range_records]
                    for headers, payload in reader.records(entries):
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        size = int(headers["x-payload-length"])
                        kind = headers["warc-type"]
                        if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
                            raise ValueError(f"{path}: payload of page {headers.get('x-page-id')} is damaged")
                        refers, page = headers.get("x-refers-to-page-id"), headers.get("x-page-id")
                        out.append((None if page is None else int(page), size, digest, kind,
                                    None if refers is None else int(refers),
                                    payload if with_payload and kind == "response" else None))
                        if len(out) == 256:
                            yield table(out)
                            out = []
                if out:
                    yield table(out)

    def table(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))[:len(kinds)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)],
                                          list(kinds))

    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * with_payload)
    return pieces.mapInArrow(run, schema)


def round_trip(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the archives under ``path`` (a new shared scratch folder by default) and read them back."""
    return read_archives(write_archives(pages, path or scratch_path(pages.sparkSession, "warc"), min_revisit_bytes))
