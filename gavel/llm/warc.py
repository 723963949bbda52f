"""Web archives in ZIP packages: written once, then read back by ranges.

A package is a ZIP file of stored (uncompressed) members: `archive/data.warc.gz`, one gzip member per
record, and `indexes/index.cdxj`, one line per record with its place in that member.  The reader gets
the end-of-central-directory records (ZIP64 ones too), walks the central directory, finds the data
offset of the stored members, and then reads single records by range: no member is extracted.

Duplicates: payloads are grouped by SHA-256.  In each group the record with the smallest id is the
`response`, others are `revisit` records that name it and carry no payload, but its length and digest.

Scale: only (id, digest) rows are aggregated, with map-side combine; the groups with two rows or more
are joined back by digest, where adaptive execution splits a hot digest.  A task writes packages of
bounded size.  Files are named by a fresh id per attempt and only the paths that a finished attempt
reports are read, so a lost executor leaves at most an unread file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import as_bytes, small_batches
from gavel.session import checkpoint_dir, stored

PACKAGE_BYTES = 64 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed date of all records: archives of equal input are equal.
DATE = "2024-01-01T00:00:00Z"
_ENDS = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a revisit has headers for its payload, but no block."""
    clean = "".join(c for c in url if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {clean}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    block = b"" if revisit else payload
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; a short or over-long block is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record block does not have its stated length")
    return fields, rest[:size]


# ---- packages


class PackageWriter:
    """Stored members in one ZIP file with ZIP64 directory records; bytes go out as they come."""

    def __init__(self, out) -> None:
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, chunks: Iterator[bytes]) -> None:
        start, raw = self.at, name.encode()
        # bit 3: sizes follow the data, as they are not known before; ZIP64 sizes in the descriptor
        self._put(struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 8, 0, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20))
        self._put(raw + struct.pack("<HHQQ", 1, 16, 0, 0))
        size = crc = 0
        for chunk in chunks:
            self._put(chunk)
            size, crc = size + len(chunk), zlib.crc32(chunk, crc)
        self._put(struct.pack("<4sIQQ", b"PK\x07\x08", crc, size, size))
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        start = self.at
        for raw, crc, size, offset in self.entries:
            head = (b"PK\x01\x02", 45, 45, 8, 0, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 28, 0, 0, 0, 0, 0xFFFFFFFF)
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", *head) + raw + struct.pack("<HHQQQ", 1, 24, size, size, offset))
        size, end, n = self.at - start, self.at, len(self.entries)
        self._put(struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1))
        self._put(struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))


def directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """name → (data offset, size, crc) of the stored members, by ranged reads of `file` (seek, read)."""

    def get(at: int, n: int) -> bytes:
        file.seek(at)
        data = file.read(n)
        if len(data) != n:
            raise ValueError("package is cut short")
        return data

    tail_at = max(0, size - 22 - 65535)
    tail = get(tail_at, size - tail_at)
    end = tail.rfind(_ENDS[0])
    if end < 0 or len(tail) - end < 22:
        raise ValueError("no end of central directory")
    number, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if end >= 20 and tail[end - 20 : end - 16] == _ENDS[1]:
        at = struct.unpack("<Q", tail[end - 12 : end - 4])[0]
        wide = get(at, 56)
        if wide[:4] != _ENDS[2]:
            raise ValueError("no ZIP64 end of central directory where its locator points")
        number, length, start = struct.unpack("<QQQ", wide[32:56])
    raw, at, members = get(start, length), 0, {}
    for _ in range(number):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("central directory entry expected")
        method, crc, packed, plain = struct.unpack("<H4xIII", raw[at + 10 : at + 28])
        n_name, n_extra, n_comment = struct.unpack("<HHH", raw[at + 28 : at + 34])
        offset = struct.unpack("<I", raw[at + 42 : at + 46])[0]
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = [struct.unpack("<Q", extra[i : i + 8])[0] for i in range(4, 4 + n - n % 8, 8)]
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n :]
        if method == 0:
            n_local = sum(struct.unpack("<HH", get(offset + 26, 4)))
            members[name] = (offset + 30 + n_local, plain, crc)
        at += 46 + n_name + n_extra + n_comment
    return members


def read_package(file, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of all records, each read by its range from the index."""
    members = directory(file, size)
    (data_at, data_size, _), (index_at, index_size, index_crc) = members[DATA], members[INDEX]
    file.seek(index_at)
    index = file.read(index_size)
    if zlib.crc32(index) != index_crc:
        raise ValueError("index is damaged")
    for line in index.decode().splitlines():
        place = json.loads(line.split(" ", 2)[2])
        if place["offset"] + place["length"] > data_size:
            raise ValueError("index points beyond its member")
        file.seek(data_at + place["offset"])
        yield parse_record(gzip.decompress(file.read(place["length"])))


# ---- jobs


def _writer(folder: str, most: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True)

        store, root = fs.FileSystem.from_uri(folder)
        source, done = rows(), []
        row = next(source, None)
        while row is not None:
            path = f"{root}/{uuid.uuid4().hex}.wacz"
            lines: list[str] = []

            def records():
                nonlocal row
                at = 0
                while row is not None and at < most:
                    packed = gzip.compress(record(*row), 6, mtime=0)
                    place = {"offset": at, "length": len(packed), "filename": "data.warc.gz"}
                    lines.append(f"{'-' if row[0] is None else row[0]} {DATE} {json.dumps(place)}\n")
                    at += len(packed)
                    yield packed
                    row = next(source, None)

            with store.open_output_stream(path) as out:
                package = PackageWriter(out)
                package.member(DATA, records())
                package.member(INDEX, iter(["".join(lines).encode()]))
                package.close()
                size = package.at
            done.append((path, size, len(lines)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "size", "records"])

    return write


def _reader(folder: str):
    def number(urn: str | None) -> int | None:
        text = (urn or "")[len("<urn:page:") : -1]
        return int(text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema(
            [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                rows = []
                with store.open_input_file(path) as file:
                    for head, block in read_package(file, size):
                        kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                        n = int(head["X-Payload-Length"])
                        if kind == "response" and (len(block) != n or sha1_base32(block) != said):
                            raise ValueError(f"damaged record in {path}")
                        rows.append((number(head["WARC-Record-ID"]), n, said, kind, number(head.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return read


def deduplicated(pages: DataFrame, page: str, url: str, html: str, least: int = 0) -> DataFrame:
    """page_id, url, payload (bytes, null html empty), refers_to, revisit.

    Only payloads of at least `least` bytes are compared.  Rows that share the smallest id of their payload (repeated
    rows) are all responses; a null id never is the smallest, and where all ids are null all rows are responses."""
    rows = pages.select(
        F.col(page).cast("long").alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(as_bytes(html), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    big = F.length("payload") >= least
    groups = rows.where(big).groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select(F.col("sha").alias("_sha"), "refers_to")
    joined = rows.join(groups, (F.col("sha") == F.col("_sha")) & big, "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


def write_packages(records: DataFrame, folder: str, most: int = PACKAGE_BYTES) -> DataFrame:
    """Write `records` (as `deduplicated` gives them) below `folder`; the written packages: path, size, records."""
    small_batches(records.sparkSession)
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    return stored(records.mapInArrow(_writer(folder, most), "path string, size long, records long"), "manifest")


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """The records of the packages: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    number = packages.count()
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return packages.repartition(max(1, number)).mapInArrow(_reader(folder), schema)


def archived(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write every page to packages in the shared folder and read all records back."""
    shared = checkpoint_dir(pages.sparkSession)
    folder = f"{shared if '://' in shared or shared.startswith('file:') else 'file://' + shared}/packages-{uuid.uuid4().hex}"
    return read_packages(write_packages(deduplicated(pages, page, url, html, least), folder), folder)
