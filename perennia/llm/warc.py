"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A package is a ZIP archive with stored (not deflated) members: ``archive/data.warc.gz`` holds the records, each a gzip
member of its own, and ``indexes/index.cdxj`` a line for each record with its place.  A reader parses the end of the
archive, its ZIP64 directory if there is one, and the central directory; from these it knows where a member's bytes lie
in the package, reads the index, and then any range of records by itself.  Archives are read and written through
``pyarrow.fs``, so the folder may be a local one or in a store; only bytes that are asked for are read.

A payload that several pages have is written once, as a response; the other records revisit it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch
from perennia.sources.scratch import stored

#: Bytes of records in a package, and bytes of a range that is read at once (a larger record is a range of its own).
PACKAGE_BYTES, RANGE_BYTES = 16 << 20, 4 << 20
#: Bytes of archives that a task reads.
TASK_BYTES = 128 << 20
#: Names of the stored members.
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Identifiers of records are made from this and what they hold.
_SPACE = uuid.UUID("00000000-0000-0000-0000-000000000000")

_MANIFEST = "package string, records long, bytes long"
_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- writing


def _record_id(page: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(_SPACE, f'{page} {digest}').urn}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, revisit: bool) -> bytes:
    """One record, compressed as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page, digest),
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None,
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "WARC-Refers-To": _record_id(refers_to, digest) if revisit else None,
        "Page-ID": page,
        "Refers-To-Page-ID": refers_to if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def package(records: list[bytes], lines: list[dict], zip64: bool = False) -> bytes:
    """A ZIP archive with the records and their index as stored members."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name, data in ((RECORDS, b"".join(records)), (INDEX, "".join(json.dumps(x) + "\n" for x in lines).encode())):
            with archive.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                member.write(data)
    return out.getvalue()


def with_revisits(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """page_id, url, payload (UTF-8 bytes, null as empty), hex digest, refers_to of the pages to write.

    Of equal payloads of at least ``least`` bytes, the row with the largest id is the response and the others refer
    to it.  The groups are found on digests alone.  Rows without an id refer to a row that has one, if there is any.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    kept = rows.filter(F.length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("m"))
    kept = kept.filter("m > 1").select("digest", "largest")
    other = (F.length("payload") >= least) & (F.col("page_id").isNull() | (F.col("page_id") != F.col("largest")))
    return rows.join(kept, "digest", "left").select("page_id", "url", "payload", "digest", F.when(other, F.col("largest")).alias("refers_to"))


def write(rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", size: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Packages of all rows of ``with_revisits`` in ``folder``; returns package, records and bytes of each.

    Runs the job.  A task's files carry the number of its attempt, and the returned table names those of the attempts
    that counted, so repeated attempts do no harm.  An empty table writes no package.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        attempt, number = TaskContext.get().taskAttemptId(), 0
        records: list[bytes] = []
        lines: list[dict] = []
        offset = 0

        def flush() -> pa.RecordBatch:
            name = f"{root}/part-{attempt:08d}-{number:05d}.wacz"
            data = package(records, lines, zip64)
            with store.open_output_stream(name) as out:
                out.write(data)
            made = (f"{folder.rstrip('/')}/part-{attempt:08d}-{number:05d}.wacz", len(records), len(data))
            return batch({n: pa.array([v]) for n, v in zip(("package", "records", "bytes"), made)})

        for b in batches:
            for page, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = base64.b32encode(bytes.fromhex(digest)).decode()
                data = record(page, url, payload, text, refers, date, refers is not None)
                lines.append({"page": page, "type": "revisit" if refers is not None else "response", "offset": offset, "length": len(data)})
                records.append(data)
                offset += len(data)
                if offset >= size:
                    yield flush()
                    records, lines, offset, number = [], [], 0, number + 1
        if records:
            yield flush()

    return stored(rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(written, _MANIFEST))


# -- reading


@dataclass
class Member:
    """A member of a ZIP archive: where its bytes start, how many, and whether they are stored as they are."""

    name: str
    start: int
    length: int
    stored: bool


def _read_at(file, offset: int, length: int) -> bytes:
    return file.read_at(length, offset)


def members(file) -> dict[str, Member]:
    """The members of an archive, from its central directory and the heads of the members.

    ``file`` offers size() and read_at(length, offset).  The directory may be that of ZIP64, in the archive's end or in
    the extra fields of its entries.  A file that is no archive is an error.
    """
    size = file.size()
    tail_at = max(0, size - 65557)  # the end record and the longest comment
    tail = _read_at(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP archive: it has no end of a central directory")
    entries, length, start = struct.unpack_from("<HII", tail, end + 10)
    at = tail_at + end - 20
    if at >= 0 and (locator := _read_at(file, at, 20))[:4] == b"PK\x06\x07":
        wide = _read_at(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is not where its locator says")
        entries, length, start = struct.unpack_from("<QQQ", wide, 32)
    directory, at, found = _read_at(file, start, length), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain = struct.unpack_from("<II", directory, at + 20)
        names, extras, notes = struct.unpack_from("<HHH", directory, at + 28)
        head = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        packed, head = _wide(directory[at + 46 + names : at + 46 + names + extras], packed, plain, head)
        local = _read_at(file, head, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} does not start where the directory says")
        skip = 30 + sum(struct.unpack_from("<HH", local, 26))
        found[name] = Member(name, head + skip, packed, method == 0 and not flags & 1)
        at += 46 + names + extras + notes
    return found


def _wide(extra: bytes, packed: int, plain: int, head: int) -> tuple[int, int]:
    """Length and place of a member, from the ZIP64 extra field where the plain fields are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field = at + 4
            if plain == 0xFFFFFFFF:
                field += 8
            if packed == 0xFFFFFFFF:
                packed, field = struct.unpack_from("<Q", extra, field)[0], field + 8
            if head == 0xFFFFFFFF:
                head = struct.unpack_from("<Q", extra, field)[0]
        at += 4 + size
    return packed, head


def located(packages: DataFrame, package: str = "package", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(package, start, length): ranges of whole records of each package, from its directory and index."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b[0].to_pylist():
                store, name = _store(path)
                with store.open_input_file(name) as file:
                    found = members(file)
                    data, index = found[RECORDS], found[INDEX]
                    if not (data.stored and index.stored):
                        raise ValueError(f"{path}: records and index have to be stored as they are")
                    lines = _read_at(file, index.start, index.length).splitlines()
                starts: list[int] = []
                lengths: list[int] = []
                for line in lines:
                    place = json.loads(line)
                    at, length = data.start + place["offset"], place["length"]
                    if starts and starts[-1] + lengths[-1] == at and lengths[-1] + length <= range_bytes:
                        lengths[-1] += length
                    else:
                        starts.append(at)
                        lengths.append(length)
                yield batch({"package": pa.array([path] * len(starts)), "start": pa.array(starts, pa.int64()), "length": pa.array(lengths, pa.int64())})

    return packages.select(package).mapInArrow(ranges, "package string, start long, length long")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and payload of a record; the payload of a revisit is empty."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    for line in http.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields.setdefault(f"http {name.strip().lower()}", value.strip())
    return fields, payload


def read(ranges: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``located`` ranges: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    payload_bytes and payload_digest are those of the full payload, for revisits those of the response they refer to;
    their payload is null.  A payload that does not have the digest of its record is an error.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, name = _store(path)
                with store.open_input_file(name) as file:
                    data = _read_at(file, start, length)
                rows: list[tuple] = []
                while data:
                    unpack = zlib.decompressobj(31)
                    fields, payload = parsed(unpack.decompress(data))
                    data = unpack.unused_data
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and digest_text(payload) != digest:
                        raise ValueError(f"{path}: the payload of page {fields.get('page-id')} is damaged")
                    page, refers = (int(fields[k]) if k in fields else None for k in ("page-id", "refers-to-page-id"))
                    size = int(fields["http content-length"])
                    rows.append((page, fields.get("warc-target-uri"), kind, size, digest, refers, payload if with_payload and kind == "response" else None))
                columns = list(zip(*rows, strict=True)) or [()] * 7
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                names = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
                yield batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    table = stored(ranges.select("package", "start", "length"))
    return table.repartition(_read_tasks(table)).mapInArrow(records, _RECORD)


def _read_tasks(ranges: DataFrame) -> int:
    """A task for every ``TASK_BYTES`` of archive, at least the session's shuffle partitions if there are as many ranges.

    The number is given because ranges are tiny rows, which adaptive execution would put into one partition.
    """
    of = ranges.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    wanted = max(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(of["bytes"] or 0) // TASK_BYTES))
    return max(1, min(of["n"], wanted))
