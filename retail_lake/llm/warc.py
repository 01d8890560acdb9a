"""WARC records in ZIP archives, written and read by ranges.

An archive is a ZIP file with two stored (uncompressed) members: ``MEMBER`` holds
the records, each a gzip member of its own, and ``INDEX`` a line for every record
with its place in ``MEMBER``. A reader finds both through the central directory
(ZIP64 too), reads the index, and fetches the records by byte range; nothing is
extracted. Ranges of some megabytes are the units of work, so that a large archive
is read by many tasks.

Every task attempt writes archives of fresh names and only the names of finished
tasks are listed, so lost executors leave files that nothing reads.
"""

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.segments import byte_slices
from retail_lake.plans.lake import scratch_folder

MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
#: Payloads of at least this many bytes are stored once.
LEAST_BYTES = 1000
#: Bytes of records after which a task begins another archive, and of one range read.
ARCHIVE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string"

# Signatures and layouts of ZIP structures.
_EOCD, _EOCD64, _LOCATOR64, _CENTRAL, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_STORED = 0
_NONE16, _NONE32 = 0xFFFF, 0xFFFFFFFF
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- ZIP directories -----------------------------------------------------------


@dataclass(frozen=True)
class Entry:
    name: str
    method: int
    size: int
    header: int


class Archive:
    """Members of a ZIP file, by range reads of a file open for random access."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.length = file, file.size()

    def read(self, offset: int, size: int) -> bytes:
        found = self.file.read_at(size, offset)
        if len(found) != size:
            raise ValueError(f"the archive ends within the {size} bytes at {offset}")
        return found

    def entries(self) -> dict[str, Entry]:
        size, offset = self._directory()
        data, at, found = self.read(offset, size), 0, {}
        while at + 46 <= len(data) and data[at : at + 4] == _CENTRAL:
            _, flags, method = struct.unpack_from("<HHH", data, at + 6)
            compressed, plain, n, m, k = struct.unpack_from("<IIHHH", data, at + 20)
            (header,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            compressed, header = self._wide(data[at + 46 + n : at + 46 + n + m], plain, compressed, header)
            found[name] = Entry(name, method, compressed, header)
            at += 46 + n + m + k
        if at != len(data):
            raise ValueError("the central directory is damaged")
        return found

    @staticmethod
    def _wide(extra: bytes, plain: int, compressed: int, header: int) -> tuple[int, int]:
        """Sizes and offsets that need 64 bits stand in an extra field, in fixed order
        and only those whose 32-bit field is full."""
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:
                numbers = [x for (x,) in struct.iter_unpack("<Q", extra[4 : 4 + length // 8 * 8])]
                if plain == _NONE32:
                    numbers.pop(0)
                if compressed == _NONE32:
                    compressed = numbers.pop(0)
                if header == _NONE32:
                    header = numbers.pop(0)
            extra = extra[4 + length :]
        return compressed, header

    def _directory(self) -> tuple[int, int]:
        """Size and offset of the central directory."""
        tail = self.read(start := max(0, self.length - 22 - _NONE16), self.length - start)
        at = tail.rfind(_EOCD)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_EOCD, 0, at)
        if at < 0:
            raise ValueError("not a ZIP archive")
        (entries,) = struct.unpack_from("<H", tail, at + 10)
        size, offset = struct.unpack_from("<II", tail, at + 12)
        if entries == _NONE16 or _NONE32 in (size, offset):
            locator = self.read(start + at - 20, 20)
            if locator[:4] == _LOCATOR64:
                wide = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if wide[:4] != _EOCD64:
                    raise ValueError("the ZIP64 directory is damaged")
                size, offset = struct.unpack_from("<QQ", wide, 40)
        return size, offset

    def stored(self, entry: Entry) -> int:
        """Where the bytes of a stored member begin."""
        if entry.method != _STORED:
            raise ValueError(f"{entry.name} is compressed as a whole; ranges of it cannot be read")
        head = self.read(entry.header, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"{entry.name} has no local header")
        return entry.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- records -------------------------------------------------------------------


def _one_line(text: str) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit of page ``refers_to`` without it.
    The HTTP header of either tells the payload's full length."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", "<urn:page:%s>" % ("" if page_id is None else page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if revisit:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple:
    """The columns of RECORD; the payload of a revisit is NULL. A response whose
    payload does not have its digest or length raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != length or hashlib.sha1(body).digest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    page, to = (re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(n, "<urn:page:>"))[1] for n in ("WARC-Record-ID", "WARC-Refers-To"))
    payload = None if kind == "revisit" else body
    return (int(page) if page else None, fields.get("WARC-Target-URI"), kind, int(to) if to else None, payload, length, digest.hex())


# --- writing -------------------------------------------------------------------


class _Stream(io.RawIOBase):
    """A sink without seeking, as object stores offer it."""

    def __init__(self, sink: pa.NativeFile):
        self.sink = sink

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.sink.write(data)
        return len(data)


def _archives(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        name = f"{uuid.uuid4().hex}.wacz"
        index, offset = [], 0
        with store.open_output_stream(f"{root}/{name}") as sink, zipfile.ZipFile(_Stream(sink), "w", zipfile.ZIP_STORED) as archive:
            with archive.open(MEMBER, "w", force_zip64=True) as member:
                while row is not None and offset < ARCHIVE_BYTES:
                    data = gzip.compress(record(*row), 6, mtime=0)
                    member.write(data)
                    index.append(json.dumps({"page_id": row[0], "offset": offset, "length": len(data)}))
                    offset += len(data)
                    row = next(rows, None)
            archive.writestr(INDEX, "\n".join(index))
        yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [len(index)]})


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        ids, urls, to = (batch.column(n).to_pylist() for n in ("page_id", "url", "refers_to"))
        yield from zip(ids, urls, byte_slices(batch.column("payload")), to, strict=True)


def revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload)`` with ``refers_to``: of equal payloads of at least
    ``LEAST_BYTES`` the greatest ``page_id``, NULL for that page itself. Pages without
    an id refer to the one with the greatest; if none has an id, none refers. Rows
    that repeat the greatest id are all stored."""
    size = F.octet_length("payload")
    hashed = pages.withColumn("_same", F.when(size >= LEAST_BYTES, F.sha2("payload", 256)))
    copies = (
        hashed.where("_same is not null").groupBy("_same").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").drop("_n")
    )
    to = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return hashed.join(copies, "_same", "left").select("page_id", "url", "payload", to.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``(page_id, url, payload)`` to archives in ``folder``, which all executors
    share; NULL payloads are empty. The archives' names and numbers of records."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    pages = pages.withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")))
    return stored(revisits(pages).mapInArrow(lambda x: _archives(x, folder), "archive string, records bigint"), "archives")


# --- reading -------------------------------------------------------------------


def _opened(path: str) -> pa.NativeFile:
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring records, by the directories and indexes alone."""
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            out: list[tuple[str, int, list[int]]] = []
            with _opened(path) as file:
                archive = Archive(file)
                entries = archive.entries()
                base, at = archive.stored(entries[MEMBER]), archive.stored(entries[INDEX])
                lines = archive.read(at, entries[INDEX].size).splitlines()
            for entry in map(json.loads, lines):
                start, length = base + entry["offset"], entry["length"]
                if out and start == out[-1][1] + sum(out[-1][2]) and out[-1][3] + length <= RANGE_BYTES:
                    out[-1][2].append(length)
                    out[-1][3] += length
                else:
                    out.append([path, start, [length], length])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int64()))],
                names=["archive", "start", "lengths"],
            )


def _records(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORD.split(", ")]
    for batch in batches:
        for run in batch.to_pylist():
            with _opened(run["archive"]) as file:
                data = Archive(file).read(run["start"], sum(run["lengths"]))
            out, at = [], 0
            for length in run["lengths"]:
                row = parsed(gzip.decompress(data[at : at + length]))
                out.append(row if payloads else (*row[:4], None, *row[5:]))
                at += length
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (RECORD) of the archives named in the column ``archive``; without
    ``payloads`` that column is NULL. Revisits have none either way."""
    spark = archives.sparkSession
    ranges = stored(archives.select("archive").mapInArrow(_ranges, "archive string, start bigint, lengths array<bigint>"), "ranges")
    tasks = max(1, min(ranges.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spread = ranges.repartition(tasks, F.xxhash64("archive", "start"))
    return spread.mapInArrow(lambda x: _records(x, payloads), RECORD)


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = renamed(table(spark, sf_dir, "pages"), page_id="page_id", url="url", payload="html")
    archives = write(pages, scratch_folder(spark, "warc"))
    return read(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# DuckDB's sha1 gives the digest of the same bytes.
OP9_SQL = f"""
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
  CASE WHEN strlen(coalesce(html, '')) >= {LEAST_BYTES} AND page_id < max(page_id) OVER same THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(coalesce(html, '')) >= {LEAST_BYTES} AND page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))"""
