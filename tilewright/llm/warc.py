"""WARC archives with a two-level capture index.

Captures are sorted by their key, the URL with its host reversed
("com,example)/path"), and each task writes its run of them as two files: the
archive, a gzip member for each record, and the index, lines of (key, record)
in compressed blocks of BLOCK_LINES, followed by a sparse directory with the
first key of each block and its place. A look-up finds the files whose range of
keys holds a URL, the block by binary search in the file's directory, the lines
by binary search in the block, and reads the ranges of bytes that these name.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.joins import WAYS, spread_join

from .shared import fresh_path, open_store, slices, written, written_slim

BLOCK_LINES = 512
#: Payloads of at least so many bytes are stored once.
LEAST_SHARED = 1000
WARC_DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_FOOT = struct.Struct("<QQ8s")
MAGIC = b"CAPINDEX"


def reversed_host_key(url):
    """Column: the host's labels reversed and joined by commas, ")", then the rest
    from the path on. A URL without "://" has itself as the key, null has ""."""
    host = F.lower(F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*(.*)$", 1)
    turned = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(F.instr(url, "://") > 0, turned).otherwise(url), F.lit(""))


def _header(kind: str, page: str, url: str, digest: str, refers: str | None, block: bytes, block_type: str) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {json.dumps(url)[1:-1]}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: {block_type}",
        f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        lines[4:4] = [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(kind: str, page: str, url: str, digest: str, refers: str | None, payload: bytes) -> bytes:
    """One gzip member. The block is an HTTP response with the payload, or nothing
    for a revisit."""
    body = b"" if kind == "revisit" else HTTP_HEAD % len(payload) + payload
    return gzip.compress(_header(kind, page, url, digest, refers, body, "application/http; msgtype=response"), 6, mtime=0)


def info_record() -> bytes:
    """What an archive starts with."""
    body = b"software: tilewright\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {WARC_DATE}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields and the payload, without the HTTP header in front of it."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record is not whole")
    return fields, rest[:n].partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else rest[:n]


class IndexWriter:
    def __init__(self, out):
        self.out, self.at, self.lines, self.directory = out, 0, [], []

    def add(self, key: str, *where) -> None:
        self.lines.append(json.dumps([key, *where]))
        if len(self.lines) == BLOCK_LINES:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            data = gzip.compress("\n".join(self.lines).encode(), 6, mtime=0)
            self.out.write(data)
            self.directory.append([json.loads(self.lines[0])[0], self.at, len(data)])
            self.at += len(data)
            self.lines = []

    def close(self) -> None:
        self.flush()
        data = gzip.compress(json.dumps(self.directory).encode(), 6, mtime=0)
        self.out.write(data + _FOOT.pack(self.at, len(data), MAGIC))
        self.out.close()


class IndexReader:
    """Captures of a key, by binary search in the directory and in its blocks."""

    def __init__(self, file):
        self.file, end = file, file.size()
        at, size, magic = _FOOT.unpack(self._range(end - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a capture index, or not whole")
        self.directory = json.loads(gzip.decompress(self._range(at, size)))
        self.firsts = [d[0] for d in self.directory]
        self.held: tuple[int, list] = (-1, [])

    def _range(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def block(self, k: int) -> list:
        if self.held[0] != k:
            _, at, size = self.directory[k]
            self.held = k, [json.loads(x) for x in gzip.decompress(self._range(at, size)).decode().split("\n")]
        return self.held[1]

    def captures(self, key: str) -> Iterator[list]:
        # the last block that starts before the key may end with it
        for k in range(max(0, bisect.bisect_left(self.firsts, key) - 1), len(self.directory)):
            if self.firsts[k] > key:
                return
            lines = self.block(k)
            for line in lines[bisect.bisect_left(lines, key, key=lambda x: x[0]) :]:
                if line[0] != key:
                    return
                yield line


def _name(number: int | None) -> str:
    return "null" if number is None else str(number)


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's response, compressed where it is read, so that the shuffles to
    come move no plain payloads."""
    names = ["page_id", "url", "key", "digest", "size"]
    for batch in slices(batches):
        columns = [batch.column(c) for c in names]
        rows = zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "payload")], strict=True)
        data = [record("response", _name(page), url or "", digest, None, payload) for page, url, digest, payload in rows]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], [*names, "data"])


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    archive, index, at, first, last, n = None, None, 0, None, None, 0
    before = None
    for batch in slices(batches):
        for row in batch.to_pylist():
            # equal rows follow each other; the first of them is the response
            me = row["key"], row["url"], row["page_id"], row["digest"]
            if row["record_type"] == "response" and row["shared"] and me == before:
                row |= {"record_type": "revisit", "refers_to": row["page_id"]}
            before = me
            if archive is None:
                store, place = open_store(folder)
                store.create_dir(place, recursive=True)
                name = f"pages-{uuid.uuid4().hex}"
                archive = store.open_output_stream(f"{place}/{name}.warc.gz", compression=None)
                index = IndexWriter(store.open_output_stream(f"{place}/{name}.idx", compression=None))
                first = row["key"]
                head = info_record()
                archive.write(head)
                at = len(head)
            data = row["data"]
            if row["record_type"] == "revisit":
                data = record("revisit", _name(row["page_id"]), row["url"] or "", row["digest"], _name(row["refers_to"]), b"")
            archive.write(data)
            index.add(row["key"], at, len(data))
            at, last, n = at + len(data), row["key"], n + 1
    if archive is not None:
        archive.close()
        index.close()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ([name], [first], [last], [n])], ["file", "first", "last", "n"])


def write_archive(pages: DataFrame, folder: str | None = None) -> str:
    """Writes a record for each row of ``pages`` (page_id, url, html) and returns
    the folder: files/ with archives and indexes, manifest with the files of the
    tasks that were committed and their ranges of keys.

    The payload is the html in UTF-8, empty if it is null. Of the records with
    equal payloads of at least LEAST_SHARED bytes, the one with the largest page_id
    is a response and the others revisit it; all else are responses. Of repeated
    rows of that page_id and URL one is the response; the others refer to its
    page_id. A null page_id is the least.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("key", reversed_host_key(F.col("url")))
    rows = rows.withColumn("size", F.octet_length("payload"))
    place = F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("page_id"), F.xxhash64("url").alias("url"))
    firsts = rows.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.max(place).alias("shown"), F.count("*").alias("copies")).where("copies > 1").select("digest", "shown", F.lit(True).alias("shared"))
    # small payloads take no part in the join, and rows of one payload are dealt to many tasks
    part = F.when(F.col("size") >= LEAST_SHARED, F.pmod(F.xxhash64("page_id", "url"), F.lit(WAYS))).otherwise(F.xxhash64("page_id", "url", "digest"))
    parts = rows.where(F.col("size") >= LEAST_SHARED).select("digest", part.alias("part")).distinct()
    firsts = parts.join(firsts, "digest")
    built = rows.mapInArrow(_responses, "page_id long, url string, key string, digest string, size int, data binary").withColumn("part", part)
    shown_id = F.when(F.col("shown.page_id") > -(2**63), F.col("shown.page_id"))
    decided = built.join(firsts, ["digest", "part"], "left").select("page_id", "url", "data", "digest", "key", "shared", (place == F.col("shown")).alias("is_shown"), shown_id.alias("refers_to"))
    kind = F.when(F.col("shared") & ~F.col("is_shown"), "revisit").otherwise("response")
    out = decided.withColumn("record_type", kind).withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("refers_to")))
    ordered = out.repartitionByRange("key", F.coalesce("page_id", F.lit(-1))).sortWithinPartitions("key", "page_id", "url", "digest").select("page_id", "url", "data", "digest", "key", "shared", "record_type", "refers_to")
    written_slim(ordered.mapInArrow(lambda it: _write(it, f"{folder}/files"), "file string, first string, last string, n long"), "manifest", f"{folder}/manifest")
    return folder


def _look_up(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    store, place = open_store(folder)
    now = index = archive = None
    names = ["key", "url", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def number(text: str) -> int | None:
        text = text.rpartition(":")[2].rstrip(">")
        return None if text == "null" else int(text)

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        rows, size = [], 0
        for name, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != now:
                now = name
                index, archive = IndexReader(store.open_input_file(f"{place}/{name}.idx")), store.open_input_file(f"{place}/{name}.warc.gz")
            for _, at, n in index.captures(key):
                archive.seek(at)
                head, payload = parse_record(archive.read(n))
                revisit = head["WARC-Type"] == "revisit"
                told = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(payload).hexdigest() != told:
                    raise ValueError(f"the payload of {head['WARC-Record-ID']} does not have its digest")
                rows.append((key, json.loads(f'"{head["WARC-Target-URI"]}"'), number(head["WARC-Record-ID"]), None if revisit else len(payload), told, head["WARC-Type"], number(head["WARC-Refers-To"]) if revisit else None, payload if payloads else None))
                size += len(payload)
                if size > 8 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)


def look_up(spark: SparkSession, folder: str, urls: DataFrame, payloads: bool = True) -> DataFrame:
    """All captures of the ``urls`` (url), whatever the case of their hosts: key,
    url, page_id, payload_bytes, payload_digest, record_type, refers_to, payload.
    A revisit has its payload in the record that it refers to, and null bytes.
    Without ``payloads`` records are read and verified but not returned."""
    files = spark.read.parquet(f"{folder}/manifest").orderBy("first", "last").collect()  # a row for each task that wrote
    ranges = spark.sparkContext.broadcast([(f.first, f.last, f.file) for f in files])

    def holders(batches):
        firsts = [r[0] for r in ranges.value]
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                k = bisect.bisect_right(firsts, key) - 1
                while k >= 0 and ranges.value[k][1] >= key:
                    found.append((ranges.value[k][2], key))
                    k -= 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*found, strict=True) if found else ([], []))], ["file", "key"])

    keys = urls.select(reversed_host_key(F.col("url").cast("string")).alias("key")).distinct()
    asked = keys.mapInArrow(holders, "file string, key string").repartition(max(1, len(files)), "file").sortWithinPartitions("file", "key")
    kind = "key string, url string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return asked.mapInArrow(lambda it: _look_up(it, f"{folder}/files", payloads), kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as an archive, looks every one of its URLs up again, and
    returns of each record: page_id, payload_bytes, payload_digest, record_type,
    refers_to. Revisits take their bytes from the response of the same digest."""
    spark = pages.sparkSession
    folder = write_archive(pages)
    read = written(look_up(spark, folder, pages.select("url"), payloads=False).drop("payload", "url", "key"), "warc-read")
    lengths = read.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("full"))
    # only the digests that are revisited
    lengths = lengths.join(read.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest", "left_semi")
    whole = read.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    revisits = spread_join(read.where("record_type = 'revisit'").withColumn("row", F.monotonically_increasing_id()), lengths, ["payload_digest"], by=["row"])
    return whole.unionByName(revisits.select("page_id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
