"""WARC records in ZIP packages: written by Spark tasks, read back by byte ranges without extraction.

A package holds stored (not compressed) members archive/data.warc.gz, one gzip member per record, and
indexes/index.cdxj, one line per record with its place. Readers take the central directory, ZIP64 forms included,
from the end of the file, find members and indexes in it, and fetch records by their ranges.
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
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.llm import storage

WINDOW_BYTES = 4 << 20
GROUP_RECORDS = 512
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_END, _END64, _LOCATOR, _CENTRAL, _LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_RECORD_DDL = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit has the HTTP head only, with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in (url or "about:blank"))
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{sha}')}>",
            "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha}", f"Page-Id: {'' if page_id is None else page_id}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{sha}')}>", f"Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 5, mtime=0)


def parse(member: bytes) -> dict:
    """Fields of a record from its gzip member; digest and length are taken from the payload where the record has it."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
    revisit = fields["WARC-Type"] == "revisit"
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or digest(payload) != sha):
        raise ValueError("payload does not match its record")
    number = lambda name: int(v) if (v := fields.get(name, "").strip()) else None
    return {"page_id": number("Page-Id"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_digest": sha,
            "payload_bytes": size, "refers_to": number("Refers-To-Page-Id"), "payload": None if revisit else payload}


class ZipWriter:
    """Stored members one after the other; ZIP64 fields are always written, so sizes have no limit."""

    def __init__(self, out) -> None:
        self.out, self.at, self.entries = out, 0, []

    def put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def member(self, name: str, parts: Iterator[bytes]) -> None:
        """A member of parts whose size is known only afterwards: a data descriptor follows it."""
        start, raw = self.at, name.encode()
        self.put(struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 8, 0, 0, 0x21, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))
        crc, begin = 0, self.at
        for p in parts:
            crc = zlib.crc32(p, crc)
            self.put(p)
        size = self.at - begin
        self.put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        begin = self.at
        for raw, crc, size, start in self.entries:
            self.put(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 8, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 28, 0, 0, 0, 0, 0xFFFFFFFF)
                     + raw + struct.pack("<HHQQQ", 1, 24, size, size, start))
        size, end = self.at - begin, self.at
        self.put(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, len(self.entries), len(self.entries), size, begin))
        self.put(struct.pack("<IIQI", _LOCATOR, 0, end, 1))
        self.put(struct.pack("<IHHHHIIH", _END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))


def members(read, size: int) -> dict[str, tuple[int, int]]:
    """(offset, size) of the data of each stored member; read(offset, length) gives bytes of the package."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", _END))
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, begin):
        mark, _, where, _ = struct.unpack_from("<IIQI", tail, at - 20)
        if mark != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        end = read(where, 56)
        mark, count, length, begin = *struct.unpack_from("<I", end), *struct.unpack_from("<QQQ", end, 32)
        if mark != _END64:
            raise ValueError("no ZIP64 end of a central directory")
    central, out, at = read(begin, length), {}, 0
    for _ in range(count):
        mark, _, _, _, method, _, _, _, packed, plain, n, extra, comment, _, _, _, start = struct.unpack_from("<IHHHHHHIIIHHHHHII", central, at)
        if mark != _CENTRAL:
            raise ValueError("broken central directory")
        name = central[at + 46 : at + 46 + n].decode()
        more = central[at + 46 + n : at + 46 + n + extra]
        while len(more) >= 4:
            tag, width = struct.unpack_from("<HH", more)
            if tag == 1:
                wide = list(struct.unpack_from(f"<{width // 8}Q", more, 4))
                plain, packed, start = (wide.pop(0) if v == 0xFFFFFFFF else v for v in (plain, packed, start))
            more = more[4 + width :]
        if method == 0:
            local = read(start, 30)
            n_local, extra_local = struct.unpack_from("<HH", local, 26)
            out[name] = (start + 30 + n_local + extra_local, packed)
        at += 46 + n + extra + comment
    return out


def _open(path: str):
    where, inner = arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return where, inner


def write(pages: DataFrame, folder: str, fewest: int = 0) -> DataFrame:
    """Writes one package per task below `folder` and returns a table of them: (path, records, bytes).

    Of pages whose payloads (html in UTF-8; NULL: empty) are equal and have at least `fewest` bytes, that with the
    least page_id is a response and the others revisit it. Rows that share that page_id are all responses. A page
    without page_id revisits if another page has an id, else it is a response. An attempt of a task that is lost leaves a file
    that no row names; the table names the files of the attempts that counted.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    keys = pages.where(F.octet_length("payload") >= fewest).select("page_id", "sha")
    least = keys.groupBy("sha").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1 and least is not null")
    revisits = keys.join(least.select("sha", "least"), "sha").where("page_id is null or page_id > least").select("page_id", "sha", "least").distinct()
    joined = pages.alias("p").join(revisits.alias("r"), F.expr("p.sha = r.sha and p.page_id <=> r.page_id"), "left").select("p.page_id", "p.url", "p.payload", "r.least")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, inner = _open(folder)
        where.create_dir(inner, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        lines: list[bytes] = []
        at = 0

        def records() -> Iterator[bytes]:
            nonlocal at
            for batch in batches:
                for page_id, url, raw, least in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    sha = digest(raw)
                    out = record(page_id, url, raw, sha, least, least is not None)
                    lines.append(json.dumps({"digest": sha, "offset": at, "length": len(out)}).encode() + b"\n")
                    at += len(out)
                    yield out

        stream = records()
        head = next(stream, None)
        if head is None:
            return
        with where.open_output_stream(f"{inner}/{name}") as sink:
            package = ZipWriter(sink)
            package.member(DATA, (x for part in ((head,), stream) for x in part))
            package.member(INDEX, iter(lines))
            package.close()
        yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": len(lines), "bytes": package.at}], schema=_MANIFEST)

    return storage.kept(joined.mapInArrow(pack, "path string, records bigint, bytes bigint"), f"{folder}-manifest")


def read(spark: SparkSession, packages: DataFrame) -> DataFrame:
    """The records of the packages in column `path`: page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload.

    First each package's directory and index are read; then groups of records are dealt to tasks, which fetch their
    ranges, neighbours in one request of up to a few MB. Packages without the two members give no records. Response
    payloads are checked against their digests; a revisit gives the length and digest of the full payload, and no payload.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, inner = _open(path)
                with where.open_input_file(inner) as f:
                    found = members(lambda at, n: f.read_at(n, at), f.size())
                    if DATA not in found or INDEX not in found:
                        continue
                    begin = found[DATA][0]
                    lines = [json.loads(x) for x in f.read_at(found[INDEX][1], found[INDEX][0]).splitlines()]
                for i in range(0, len(lines), GROUP_RECORDS):
                    own = lines[i : i + GROUP_RECORDS]
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([[begin + x["offset"] for x in own]], pa.list_(pa.int64())),
                                                      pa.array([[x["length"] for x in own]], pa.list_(pa.int64()))], names=["path", "at", "size"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                where, inner = _open(path)
                with where.open_input_file(inner) as f:
                    i = 0
                    while i < len(at):
                        j = i + 1
                        while j < len(at) and at[j] == at[j - 1] + size[j - 1] and at[j] + size[j] - at[i] <= WINDOW_BYTES:
                            j += 1
                        window = f.read_at(at[j - 1] + size[j - 1] - at[i], at[i])
                        rows = [parse(window[a - at[i] : a - at[i] + n]) for a, n in zip(at[i:j], size[i:j])]
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        i = j

    groups = packages.select("path").mapInArrow(plan, "path string, at array<bigint>, size array<bigint>")
    # few rows, one per group of records: dealt out so that reading does not follow how the packages were written
    return groups.repartition(max(2, spark.sparkContext.defaultParallelism)).mapInArrow(fetch, _RECORD_DDL)


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page, written to packages and read back."""
    spark = pages.sparkSession
    made = write(pages, storage.run_dir(spark, "archives"))
    return read(spark, made).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
