"""WARC archives: a deterministic sharded writer, and a reader.

Writing:

1. Records with equal payloads of at least ``REVISIT_BYTES`` bytes become one response
   (the one with the largest page_id) and revisits of it; smaller ones are all responses.
2. The records' keys (page_id, url, digest) and payload sizes, without the payloads, are sorted and
   summed up: a new range begins whenever ``range_bytes`` of payload are full. Each
   record's headers and digests are made anew, the record is compressed as a gzip member of
   its own and sent, once, to its range, where a new file begins whenever ``roll_bytes`` of
   members are full. Ranges depend on the records alone, not on how Spark deals them out, so
   the same table gives the same bytes in the same files.
3. Each file is written by one task under a temporary name and renamed when it is
   complete; a repeated task writes the same bytes again. What counts is the manifest,
   written last: file, records, bytes and SHA-1. Files that it does not name are not read.

Files are written through Arrow's file systems from the URI of the folder (local or
mounted folders, HDFS, S3, GCS), so the folder must be one that executors can reach;
the manifest is written, and everything is read, by Spark.

Defined results: a null html is an empty payload; a null page_id sorts first and is
written as ``null`` (it is a response only if all others of its payload have none);
of rows that repeat page_id and payload the one with the largest url is the response, of rows that
repeat all three one, and the others revisit it (such equal rows lie in one range); payloads of any length are written whole, one longer
than ``roll_bytes`` ends its file; a url that is null or holds a line break is
written percent-encoded; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, map_texts, shared_folder

REVISIT_BYTES = 1000
ROLL_BYTES, RANGE_BYTES = 16 << 20, 128 << 20
#: Every record's date, unless the caller names a column: the table has none, and the clock would not be deterministic.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest"
_CHUNK = 1 << 16


# ------------------------------------------------------------------ records


def decide(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, bytes, large, revisit, and for revisits refers_id and refers_url.

    Rows equal in page_id, url and payload are not told apart here: the writer, where they stand
    side by side, makes all but the first of them revisits.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.select("*", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    p = p.withColumn("large", F.col("bytes") >= revisit_bytes)
    shared = p.filter("large").groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "url")).alias("best"), F.count("*").alias("n")).filter("n > 1")
    shared = keep(shared.select(F.col("digest").alias("_d"), F.col("bytes").alias("_b"), "best"))
    p = p.join(shared, F.col("large") & (F.col("digest") == F.col("_d")) & (F.col("bytes") == F.col("_b")), "left")
    # structs compare their fields with nulls equal
    revisit = F.col("best").isNotNull() & ~F.coalesce(F.struct("page_id", "url") == F.col("best"), F.lit(False))
    return p.select("page_id", "url", "html", "digest", "bytes", "large", revisit.alias("revisit"), F.when(revisit, F.col("best.page_id")).alias("refers_id"),
                    F.when(revisit, F.col("best.url")).alias("refers_url"))


def _order() -> list[F.Column]:
    return [F.col(c).asc_nulls_first() for c in ("page_id", "url", "digest")]


def _key(page_id: int | None, url: str | None, digest: str) -> tuple:
    """A record's place in the order that Spark sorts by (nulls first, texts by bytes)."""
    return page_id is not None, page_id or 0, url is not None, (url or "").encode(), digest


def ranges(records: DataFrame, range_bytes: int) -> list[tuple]:
    """The first key of every range but the first: a new one begins whenever ``range_bytes`` of payload are full."""
    order = _order()
    d = records.select("page_id", "url", "digest", "bytes").repartitionByRange(*order).sortWithinPartitions(*order)
    d = keep(d.withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    begin = d.groupBy("part").agg(F.sum("bytes").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(begin, "part")
    d = d.withColumn("range", F.floor((F.col("begin") + F.col("inside")) / range_bytes))
    first = d.groupBy("range").agg(F.min(F.struct("page_id", "url", "digest")).alias("key")).collect()  # a row per range
    return sorted({_key(*r.key) for r in first})[1:]


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:sha1:{digest}>"


def _page(record: str) -> int | None:
    page = record.removeprefix("<urn:page:").split(":", 1)[0]
    return None if page == "null" else int(page)


def _uri(url: str | None) -> str:
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_id: int | None, refers_url: str | None, date: str = DATE) -> bytes:
    """One whole record. A revisit holds the HTTP header only, with the length of the payload that it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: {_base32(digest)}", f"WARC-Block-Digest: {_base32(hashlib.sha1(block).hexdigest())}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_id, digest)}", f"WARC-Refers-To-Target-URI: {_uri(refers_url)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member: no name and no time in its header."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _members(cuts: list[tuple]):
    def run(batches):
        for batch in batches:
            cols = [batch.column(k) for k in range(8)]
            for a in range(0, batch.num_rows, 64):
                made, part = [], []
                for page, url, html, digest, _, revisit, refers, refers_url in zip(*(c.slice(a, 64).to_pylist() for c in cols)):
                    made.append(member(record(page, url, html.encode(), digest, revisit, refers, refers_url)))
                    part.append(bisect_right(cuts, _key(page, url, digest)))
                same = [cols[k].slice(a, 64) for k in (0, 1, 3)]
                once = pc.and_(cols[4].slice(a, 64), pc.invert(cols[5].slice(a, 64)))  # may be written as a response once
                yield pa.RecordBatch.from_arrays([*same, once, pa.array(made, pa.binary()), pa.array(part, pa.int32())],
                                                 names=["page_id", "url", "digest", "once", "member", "part"])

    return run


# ------------------------------------------------------------------ files


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    path = uri.removeprefix("file:") if not uri.startswith("file://") else uri  # Hadoop writes file:/folder
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _file_name(part: int, number: int) -> str:
    return f"pages-{part:06d}-{number:05d}.warc.gz"


def _as_revisit(data: bytes, page_id: int | None, url: str | None, digest: str) -> bytes:
    """The member of a response anew as a revisit of an equal row."""
    _, _, payload = parse(next(members_of(memoryview(data))))
    return member(record(page_id, url, payload, digest, True, page_id, url))


def _writer(folder: str, roll_bytes: int):
    """Rows of one range (or several, one after the other) in their order: writes the files, yields their lines of the manifest."""

    def run(batches):
        fs, base = _file_system(folder)
        out = temporary = last = now = None
        lines: list[list] = []

        def close():
            out.close()
            fs.move(temporary, posixpath.join(base, lines[-1][0]))

        for batch in batches:
            cols = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
            for page, url, digest, once, part, data in zip(*cols, batch.column(4)):
                buffer = data.as_buffer()
                if once and last == (page, url, digest):
                    buffer = pa.py_buffer(_as_revisit(buffer, page, url, digest))
                last = page, url, digest
                if part != now or lines[-1][2] >= roll_bytes:
                    if out is not None:
                        close()
                    number = number + 1 if part == now else 0
                    now = part
                    # attempts never share a temporary name; the last rename wins, with the same bytes
                    temporary = posixpath.join(base, f".{_file_name(part, number)}.{uuid.uuid4().hex}")
                    out = fs.open_output_stream(temporary, compression=None)
                    lines.append([_file_name(part, number), 0, 0, hashlib.sha1()])
                out.write(buffer)
                lines[-1][1] += 1
                lines[-1][2] += buffer.size
                lines[-1][3].update(buffer)
        if out is not None:
            close()
        name, records, size, sha1 = zip(*lines) if lines else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(records, pa.int64()), pa.array(size, pa.int64()),
                                          pa.array([h.hexdigest() for h in sha1], pa.string())], names=["file", "records", "bytes", "sha1"])

    return run


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` as archives to the new ``folder``; returns the manifest (file, records, bytes, sha1).

    An earlier manifest of the folder is an error: archives are not added to."""
    fs, base = _file_system(folder)
    if fs.get_file_info(posixpath.join(base, MANIFEST)).type != pyarrow.fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds archives already")
    fs.create_dir(base, recursive=True)
    rows = decide(pages, revisit_bytes).select("page_id", "url", "html", "digest", "large", "revisit", "refers_id", "refers_url", "bytes")
    cuts = ranges(rows, range_bytes)
    made = map_texts(rows.drop("bytes"), _members(cuts), "page_id long, url string, digest string, once boolean, member binary, part int")
    made = made.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", *_order())
    lines = map_texts(made, _writer(folder, roll_bytes), "file string, records long, bytes long, sha1 string")
    lines.write.parquet(posixpath.join(folder, MANIFEST))
    return manifest(pages.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(folder, MANIFEST))


# ------------------------------------------------------------------ reading


def members_of(data: memoryview) -> Iterator[bytes]:
    """The uncompressed members of a gzip file, one after the other."""
    at = 0
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            chunk = data[at : at + _CHUNK]
            if not chunk:
                raise ValueError("truncated archive")
            parts.append(z.decompress(chunk))
            at += len(chunk) - len(z.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP header and payload of a record; its lengths and its block digest must be right."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:20]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.removesuffix(":"), "") for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or _base32(hashlib.sha1(block).hexdigest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _read(batches):
    """Rows (sha1 of the manifest, content of a file) to records."""
    for batch in batches:
        for want, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = memoryview(content.as_buffer())
            if hashlib.sha1(data).hexdigest() != want:
                raise ValueError("a file is not what the manifest says")
            rows = []
            for raw in members_of(data):
                h, http, payload = parse(raw)
                revisit = h["WARC-Type"] == "revisit"
                digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                length = int(http.decode().split("Content-Length: ", 1)[1].split("\r\n")[0])
                if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
                    raise ValueError(f"payload of {h['WARC-Record-ID']} is not what its headers say")
                rows.append((_page(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], length, digest,
                             _page(h["WARC-Refers-To"]) if revisit else None, None if revisit else payload))
                if len(rows) == 256:
                    yield _record_batch(rows)
                    rows = []
            if rows:
                yield _record_batch(rows)


READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split(" ")[0] for f in READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the folder's manifest names, each file and record held against its digests.

    page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "pages-*.warc.gz").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    named = files.join(manifest(spark, folder).select("file", "sha1"), "file").select("sha1", "content")
    return map_texts(named, _read, READ)


def round_trip(pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes ``pages`` and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = folder or shared_folder(pages.sparkSession)
    write(pages, folder, roll_bytes)
    return read(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
