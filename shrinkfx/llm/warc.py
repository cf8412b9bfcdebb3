"""WARC records in ZIP-packaged archives, read in place.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, one line per record with its offset
and length in the data member. The reader finds the members through the end record, the
ZIP64 directory if there is one and the central directory, and then range-reads single
records; nothing is extracted.

Archives are written and read inside tasks through Arrow file systems, below the shared
folder, so the path must be one that Arrow opens (local, HDFS, S3, GCS). A writer task
writes under a name of its own and renames when done: a rerun replaces its own archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import materialize, stage_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORD_URN = "urn:shrinkfx:record:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64 << 20
#: payload bytes after which a batch of read records is handed on
BATCH_BYTES = 8 << 20
#: tasks over which the rows of one payload are spread
SALTS = 16
RECORDS = ("record_id long, target_uri string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -----------------------------------------------------------------------

def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{RECORD_URN}{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#[]!*()~')}")
    if revisit:
        head += [f"WARC-Refers-To: <{RECORD_URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _urn(value: str | None) -> int | None:
    digits = (value or "").strip("<>").removeprefix(RECORD_URN)
    return int(digits) if digits else None


def parse_record(raw: bytes) -> tuple:
    """A record's fields in the order of ``RECORDS``; a response's digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = _headers(head)
    http, _, payload = rest[: int(h["content-length"])].partition(b"\r\n\r\n")
    digest, kind = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"]
    if kind == "response" and base32_sha1(payload) != digest:
        raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    url = h.get("warc-target-uri")
    return (_urn(h["warc-record-id"]), None if url is None else unquote(url), kind,
            _urn(h.get("warc-refers-to")), int(_headers(http)["content-length"]), digest,
            payload if kind == "response" else None)


# --- archives ----------------------------------------------------------------------

class ArchiveWriter:
    """One archive, written front to back; index lines are kept until it is closed."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.fs, self.path, self.temp = fs, path, f"{path}.{uuid.uuid4().hex}.tmp"
        self.out = fs.open_output_stream(self.temp)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page_id, url, payload: bytes, digest: str, refers_to, date: str) -> None:
        pack = zlib.compressobj(3, zlib.DEFLATED, 31)
        raw = pack.compress(_record(page_id, url, payload, digest, refers_to, date)) + pack.flush()
        self.data.write(raw)
        line = {"offset": self.at, "length": len(raw), "digest": digest, "url": url, "filename": DATA}
        self.index.append(f"{page_id} {json.dumps(line)}\n")
        self.at += len(raw)

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as f:
            f.write("".join(self.index).encode())
        self.zip.close()
        self.out.close()
        self.fs.move(self.temp, self.path)
        return self.path, len(self.index)


def directory(source) -> dict[str, tuple[int, int]]:
    """name -> (place of the content, size) of the stored members of a ZIP file.

    ``source`` is a random-access file. Only the tail, the directory and each member's
    local header are read. Raises ValueError for anything that is not such an archive."""
    size = source.size()
    tail_size = min(size, 22 + 65535 + 20)
    tail = _range(source, size - tail_size, tail_size)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0:  # the signature may occur in the comment: its length must fit
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, at = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == entries or 0xFFFFFFFF in (length, at):
        if end < 20 or tail[end - 20: end - 16] != b"PK\x06\x07":
            raise ValueError("ZIP64 locator missing")
        record = _range(source, struct.unpack_from("<Q", tail, end - 12)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record missing")
        entries, length, at = struct.unpack_from("<QQQ", record, 32)
    table, pos, found = _range(source, at, length), 0, {}
    for _ in range(entries):
        if table[pos: pos + 4] != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        method, packed, full, n, x, c = (struct.unpack_from(f, table, pos + o)[0] for f, o in (
            ("<H", 10), ("<I", 20), ("<I", 24), ("<H", 28), ("<H", 30), ("<H", 32)))
        place = struct.unpack_from("<I", table, pos + 42)[0]
        name = table[pos + 46: pos + 46 + n].decode("utf-8")
        extra, e = table[pos + 46 + n: pos + 46 + n + x], 0
        while e + 4 <= len(extra):
            tag, span = struct.unpack_from("<HH", extra, e)
            if tag == 1:  # 64-bit values stand for those that overflow, in this order
                wide = iter(struct.unpack_from(f"<{span // 8}Q", extra, e + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                place = next(wide) if place == 0xFFFFFFFF else place
            e += 4 + span
        if method == 0:
            local = _range(source, place, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"local header of {name} is damaged")
            found[name] = (place + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        pos += 46 + n + x + c
    return found


def _range(source, at: int, n: int) -> bytes:
    source.seek(at)
    return source.read(n)


def read_archive(fs: pafs.FileSystem, path: str) -> Iterator[bytes]:
    """The records of an archive, each by one range read where the index says."""
    with fs.open_input_file(path) as f:
        members = directory(f)
        place, size = members[INDEX]
        for line in _range(f, place, size).decode().splitlines():
            entry = json.loads(line.partition(" ")[2])
            start = members[entry["filename"]][0] + entry["offset"]
            yield zlib.decompress(_range(f, start, entry["length"]), 31)


# --- jobs --------------------------------------------------------------------------

def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                  url_col: str = "url", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads of at least ``min_bytes`` the
    smallest id is the response (refers_to null), the others point to it; where none has an
    id, all are responses. Groups are counted on digests with partial aggregation; only
    shared digests are joined back, each spread over ``SALTS`` tasks, as one payload may
    belong to a third of all rows."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = (rows.where(F.length("payload") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    name = F.when(F.col("page_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("page_id"))
    rows = rows.withColumn("salt", F.pmod(name, F.lit(SALTS)).cast("int"))
    firsts = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.join(firsts, ["digest", "salt"], "left")
            .select("page_id", "url", "payload", refers.alias("refers_to")))


def write_archives(records: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``records`` (see ``with_revisits``) as archives below ``folder`` and return the
    manifest (archive, records): one or more archives per partition, none for an empty
    one. Null payloads are empty; a null id or url is left out of the record."""
    spark = records.sparkSession
    folder = folder or stage_path(spark, "warc")
    fs_path = pafs.FileSystem.from_uri(folder)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        fs.create_dir(fs_path, recursive=True)
        part, made, writer = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    writer = ArchiveWriter(fs, f"{fs_path}/part-{part:06d}-{len(made):04d}.wacz")
                payload = payload or b""
                writer.add(page_id, url, payload, base32_sha1(payload), refers_to, date)
                if writer.at >= archive_bytes:
                    made.append(writer.close())
                    writer = None
        if writer is not None:
            made.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()),
                                          pa.array([m[1] for m in made], pa.int64())],
                                         names=["archive", "records"])

    manifest = arrow_map(records.select("page_id", "url", "payload", "refers_to"), run,
                         "archive string, records long")
    return materialize(manifest, "warc-manifest").withColumn("folder", F.lit(folder))


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records (``RECORDS``) of the archives in ``manifest``, one archive at a time per
    task; without ``payloads`` that column is null, the digest is checked all the same."""
    spark: SparkSession = manifest.sparkSession
    n = manifest.count()
    types = pa.schema([("record_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("payload", pa.binary())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, folder in zip(b.column("archive").to_pylist(), b.column("folder").to_pylist()):
                rows, size = [], 0
                for raw in read_archive(pafs.FileSystem.from_uri(folder)[0], archive):
                    row = parse_record(raw)
                    rows.append(row if payloads else (*row[:-1], None))
                    size += len(raw) if payloads else 0
                    if len(rows) == 512 or size > BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    spread = manifest.select("archive", "folder").repartition(max(1, min(n, 10_000)))
    return arrow_map(spread, run, RECORDS)
