"""WARC archives packaged in ZIP files: a writer, and a reader that extracts nothing.

A package is a ZIP file of stored members: archives below archive/, every record compressed by itself as is usual for
archives on the web, and indexes below indexes/ (a line per record, whose JSON part gives its offset in the archive member
of that file name, and its length). Packages written here have one of each. The reader parses the end-of-central-directory
record, the ZIP64 locator and record, and the central directory with its ZIP64 extra fields, finds where the stored
members lie in the file, reads every index, and then reads records by byte range. Ranges, not files, are dealt out to
tasks, so one large package is read by many. An archive that no index names, an index line without its archive, and a
compressed member are errors.

Packages are written by tasks into the shared folder through Arrow file systems. Every attempt of a task writes files of
its own names, and only what successful attempts report is read, so lost executors and repeated attempts do no harm.

Defined results: a null page is an empty payload; a null page id stays null; records with equal payloads of at least
MIN_REVISIT bytes are revisits of the one with the largest page id, and rows that repeat that id are all responses; an
empty table gives no package and no rows; other columns are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _common as c

MIN_REVISIT = 1000
#: Payload bytes after which a package is closed, and bytes of neighbouring records that one range takes.
PACKAGE_BYTES, RANGE_BYTES = 16 << 20, 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES, INDEXES = "archive/", "indexes/"
DATA = "data.warc.gz"
LEVEL = 3
#: Size and digest are those of the full payload, as the record states them; a revisit has no payload of its own.
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


# --- records -----------------------------------------------------------------------------------------------------------
def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One compressed WARC record; with refers_to a revisit, whose block has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": name(refers_to), "WARC-Profile": PROFILE}
    plain = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    return gzip.compress(plain, LEVEL, mtime=0)


def parse_record(raw: bytes) -> tuple:
    """A row of RECORDS; a response's payload is checked against its digest."""
    top, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not at a record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    return number(head["WARC-Record-ID"]), size, digest, kind, number(head.get("WARC-Refers-To")), head["WARC-Target-URI"], payload if kind == "response" else None


# --- ZIP directories ---------------------------------------------------------------------------------------------------
def directory(read: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (data offset, length, method) of the members. read(offset, length) reads the file of `size` bytes."""
    tail_at = max(0, size - 65_557)  # the record and the longest comment
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    # a comment may hold the mark: the record is where the length of its comment reaches the end of the file
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack("<H", tail[at + 20 : at + 22])[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end-of-central-directory record")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    locator = tail[at - 20 : at] if at >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        (end64,) = struct.unpack("<Q", locator[8:16])
        record64 = read(end64, 56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 record where its locator points")
        count, length, start = struct.unpack("<QQQ", record64[32:56])
    raw, at, found = read(start, length), 0, {}
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n_name, n_extra, n_note = struct.unpack("<H8xIIHHH", raw[at + 10 : at + 34])
        (local,) = struct.unpack("<I", raw[at + 42 : at + 46])
        name = raw[at + 46 : at + 46 + n_name].decode()
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # 64-bit values, present in this order where the 32-bit field is full
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        header = read(local, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header where {name} should begin")
        n_local = struct.unpack("<HH", header[26:30])
        found[name] = (local + 30 + sum(n_local), packed, method)
        at += 46 + n_name + n_extra + n_note
    return found


def package(records: list[tuple[int | None, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of the records (page id, bytes)."""
    out, lines, at = io.BytesIO(), [], 0
    for page_id, raw in records:
        lines.append(json.dumps({"page_id": page_id, "filename": DATA, "offset": at, "length": len(raw)}))
        at += len(raw)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(ARCHIVES + DATA), "w", force_zip64=zip64 or at >= 1 << 31) as member:
            for _, raw in records:
                member.write(raw)
        z.writestr(zipfile.ZipInfo(INDEXES + "index.cdxj"), "\n".join(lines))
    return out.getvalue()


def ranges(read: Callable[[int, int], bytes], size: int, range_bytes: int = RANGE_BYTES) -> Iterator[tuple[int, list[int]]]:
    """(offset in the file, lengths of the neighbouring records that start there), each of about range_bytes or one record."""
    members = directory(read, size)
    used = {k: v for k, v in members.items() if k.startswith((ARCHIVES, INDEXES)) and not k.endswith("/")}
    if packed := [name for name, (_, _, method) in used.items() if method]:
        raise ValueError(f"members must be stored, not compressed: {packed}")
    lines = [json.loads(line[line.index(b"{") :]) for name, (at, n, _) in used.items() if name.startswith(INDEXES) for line in read(at, n).splitlines() if line.strip()]
    named = {ARCHIVES + x["filename"] for x in lines}
    archives = {name: used[name][0] for name in used if name.startswith(ARCHIVES)}
    if named != archives.keys():
        raise ValueError(f"indexes and archives differ: {sorted(named ^ archives.keys())}")
    start, lengths = None, []
    for x in lines:
        at, n = archives[ARCHIVES + x["filename"]] + int(x["offset"]), int(x["length"])
        if lengths and (sum(lengths) + n > range_bytes or at != start + sum(lengths)):
            yield start, lengths
            lengths = []
        if not lengths:
            start = at
        lengths.append(n)
    if lengths:
        yield start, lengths


# --- on Spark ----------------------------------------------------------------------------------------------------------
def _reader(f) -> Callable[[int, int], bytes]:
    def read(offset: int, length: int) -> bytes:
        f.seek(offset)
        return f.read(length)

    return read


def typed_records(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which record each page becomes; refers_to is null for responses."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html")})
    first = page.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    # small payloads have no partner: each gets a key of its own, or all empty pages would meet in one task
    own = F.concat(F.lit("-"), F.hex(F.xxhash64("page_id", "url")))
    page = page.withColumn("key", F.when(F.col("n") >= min_bytes, F.col("digest")).otherwise(own))
    joined = page.join(first.withColumnRenamed("digest", "key").hint("merge"), "key", "left")
    revisit = (F.col("n") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("first")).alias("refers_to"))


def write_packages(typed: DataFrame, root: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes packages below root; returns (path, size) of each, already evaluated."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(root)
        fs.create_dir(folder, recursive=True)
        held, total = [], 0

        def flush() -> pa.RecordBatch:
            raw, path = package(held), f"{folder}/{uuid.uuid4().hex}.zip"
            with fs.open_output_stream(path) as out:
                out.write(raw)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(raw)], pa.int64())], ["path", "size"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (batch.column(k)[i].as_py() for k in range(5))
                raw = record(page_id, url, html.encode(), digest, refers_to)
                held.append((page_id, raw))
                total += len(raw)
                if total >= package_bytes:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    return c.cut(typed.mapInArrow(write, "path string, size long"))


def read_packages(packages: DataFrame, root: str) -> DataFrame:
    """RECORDS of the packages (path, size), read by range."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for x in batch.to_pylist():
                with fs.open_input_file(x["path"]) as f:
                    found = list(ranges(_reader(f), x["size"]))
                yield pa.RecordBatch.from_arrays([pa.array([x["path"]] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.list_(pa.int64()))], ["path", "start", "lengths"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for x in batch.to_pylist():
                with fs.open_input_file(x["path"]) as f:
                    raw = _reader(f)(x["start"], sum(x["lengths"]))
                rows, at = [], 0
                for n in x["lengths"]:
                    rows.append(parse_record(raw[at : at + n]))
                    at += n
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    n = packages.sparkSession.sparkContext.defaultParallelism
    dealt = packages.repartition(n).mapInArrow(plan, "path string, start long, lengths array<long>").repartition(4 * n)
    return dealt.mapInArrow(read, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = c.fresh_path(spark, "warc")
    written = write_packages(typed_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), root)
    size, digest = F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes"), F.coalesce(F.sha1("payload"), "payload_digest")
    return read_packages(written, root).select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s FROM p),
f AS (SELECT s, max(page_id) AS first FROM d WHERE n >= {MIN_REVISIT} GROUP BY s)
SELECT page_id, n::BIGINT AS payload_bytes, d.s AS payload_digest, CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.s = f.s"""
