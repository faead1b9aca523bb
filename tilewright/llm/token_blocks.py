"""Token ids in a binary file format of patched frame-of-reference blocks.

A file holds a run of documents in order of their ids:

    b"PFOR1\\n"
    blocks, each of BLOCK ids but the last:
        u32 minimum, u16 ids, u8 width, u16 exceptions, u32 bytes of the packed part
        packed part: id - minimum in ``width`` bits each, big-endian, zero if it does not fit
        exceptions: u16 positions, then u32 values
    directory: i64 doc_id, i64 ids of each document (as zlib-compressed columns)
    index: u64 byte offset of each block
    footer: u64 documents, u64 blocks, u64 ids, u64 offset of the directory, u64 offset of the index, b"PFOR1\\n"

The width of a block is that of the WIDTH_SHARE-quantile of its ids less their
minimum, so a few large ids cost an exception each and not a wider block.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh_path, open_store, slices, written_slim
from .tokenise import default_tokenizer, encoder

MAGIC = b"PFOR2\n"
BLOCK = 1024
WIDTH_SHARE = 0.95
_HEAD, _FOOT = struct.Struct("<IHBHI"), struct.Struct("<QQQQQ6s")


def pack_block(ids: np.ndarray) -> bytes:
    """One block. ids: 1 to 65535 of uint32."""
    low = int(ids.min())
    over = (ids - np.uint32(low)).astype(np.uint32)
    rank = min(len(over) - 1, int(np.ceil(WIDTH_SHARE * len(over))) - 1)
    width = int(np.partition(over, rank)[rank]).bit_length()
    odd = np.flatnonzero(over >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    kept = over.copy()
    kept[odd] = 0
    bits = np.unpackbits(kept.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    body = np.packbits(bits).tobytes() if width else b""
    return _HEAD.pack(low, len(ids), width, len(odd), len(body)) + body + odd.astype("<u2").tobytes() + over[odd].astype("<u4").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    low, n, width, odd, size = _HEAD.unpack_from(data)
    at = _HEAD.size
    over = np.zeros(n, np.uint32)
    if width:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, 32 - width :] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
        over = np.packbits(bits, axis=1).view(">u4").ravel().astype(np.uint32)
    at += size
    over[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return (over + np.uint32(low)).astype("<u4")


class BlockWriter:
    """Writes one file, a block at a time."""

    def __init__(self, out):
        self.out, self.at, self.index, self.docs, self.sizes = out, 0, [], [], []
        self.rest = b""
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.rest += ids
        if len(self.rest) >= 16 * 4 * BLOCK:
            self.flush(len(self.rest) // (4 * BLOCK))

    def flush(self, blocks: int) -> None:
        ids = np.frombuffer(self.rest, "<u4")
        for k in range(blocks):
            self.index.append(self.at)
            self._put(pack_block(ids[k * BLOCK : (k + 1) * BLOCK]))
        self.rest = self.rest[4 * BLOCK * blocks :]

    def close(self) -> None:
        if self.rest:
            self.flush(-(-len(self.rest) // (4 * BLOCK)))
        directory = self.at
        # a doc_id that is null is 0 here, and 1 in the last column
        for column in ([d or 0 for d in self.docs], self.sizes, [int(d is None) for d in self.docs]):
            data = zlib.compress(np.array(column, "<i8").tobytes())
            self._put(struct.pack("<Q", len(data)) + data)
        index = self.at
        self._put(np.array(self.index, "<u8").tobytes())
        self._put(_FOOT.pack(len(self.docs), len(self.index), int(np.sum(self.sizes, dtype=np.int64)), directory, index, MAGIC))
        self.out.close()


class BlockReader:
    """Reads documents of one file by the ranges of bytes that hold them."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        n_docs, n_blocks, self.n_ids, self.directory, index, magic = _FOOT.unpack(self._range(end - _FOOT.size, end))
        if magic != MAGIC:
            raise ValueError("not a token block file, or not whole")
        tail = self._range(self.directory, end)
        at, columns = 0, []
        for _ in range(3):
            (size,) = struct.unpack_from("<Q", tail, at)
            columns.append(np.frombuffer(zlib.decompress(tail[at + 8 : at + 8 + size]), "<i8"))
            at += 8 + size
        self.doc_ids, self.sizes, null = columns
        self.no_id = null.astype(bool)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.index = np.append(np.frombuffer(tail, "<u8", n_blocks, index - self.directory), np.uint64(self.directory))

    def _range(self, a: int, b: int) -> bytes:
        self.file.seek(a)
        return self.file.read(b - a)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at the places first to last - 1 of the file."""
        a, b = first // BLOCK, -(-last // BLOCK)
        if a >= b:
            return np.empty(0, "<u4")
        at = self.index[a : b + 1].astype(np.int64) - int(self.index[a])
        data = self._range(int(self.index[a]), int(self.index[b]))
        whole = np.concatenate([unpack_block(data[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)])
        return whole[first - a * BLOCK : last - a * BLOCK]


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    end, writer, name = np.array([end_id], "<u4").tobytes(), None, None
    for batch in slices(batches):
        if writer is None:
            store, place = open_store(folder)
            name = f"ids-{uuid.uuid4().hex}.pfor"
            store.create_dir(place, recursive=True)
            writer = BlockWriter(store.open_output_stream(f"{place}/{name}"))
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist()), strict=True):
            writer.add(doc_id, ids + end)
    if writer is not None:
        writer.close()
        row = [[name], [TaskContext.get().partitionId()], [len(writer.docs)], [sum(writer.sizes)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.string(), *[pa.int64()] * 3), strict=True)], ["file", "part", "n_docs", "n_ids"])


def write_token_blocks(docs: DataFrame, folder: str | None = None, end_id: int = 2, tokenizer: str | None = None) -> str:
    """Encodes every whole text of ``docs`` (doc_id, text), appends ``end_id`` and
    writes the ids in order of doc_id, a file for each task. Returns the folder.

    ``folder/manifest`` lists the files of the tasks that were committed; a file
    that a lost or repeated task left behind is in no list, so it is never read.
    Null and empty texts have the end id alone; null doc_ids come first. Rows
    with the same doc_id are all written, in the order of a hash of their whole
    texts, however they are read; equal rows, which only differ by where they were
    read, are dealt to many tasks.
    """
    folder = folder or fresh_path(docs.sparkSession, "token-blocks")
    path = tokenizer or default_tokenizer()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text"), "row"]
    ordered = slim.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    written_slim(ordered.mapInArrow(lambda it: _write(it, f"{folder}/files", path, end_id), "file string, part long, n_docs long, n_ids long"), "manifest", f"{folder}/manifest")
    return folder


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, place = open_store(folder)
    step = 256 * BLOCK
    for batch in batches:
        for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with store.open_input_file(f"{place}/{name}") as file:
                reader = BlockReader(file)
                n = len(reader.doc_ids)
                crc = np.zeros(n, np.int64)
                doc = 0
                for first in range(0, reader.n_ids, step):
                    last = min(first + step, reader.n_ids)
                    ids = memoryview(reader.ids(first, last).tobytes())
                    while doc < n and reader.starts[doc] < last:
                        a, b = max(first, reader.starts[doc]), min(last, reader.starts[doc + 1])
                        crc[doc] = zlib.crc32(ids[4 * (a - first) : 4 * (b - first)], crc[doc])
                        if b < reader.starts[doc + 1]:
                            break
                        doc += 1
                ids = pa.array(reader.doc_ids, mask=reader.no_id)
                yield pa.RecordBatch.from_arrays([ids, pa.array(reader.starts[:-1] + before), pa.array(reader.sizes), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document, decoded from the files. The list of files, a row for each
    task that wrote, gives the ids before each file."""
    files = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()
    before = np.concatenate(([0], np.cumsum([f.n_ids for f in files]))).tolist()
    rows = spark.createDataFrame([(f.file, b) for f, b in zip(files, before, strict=False)], "file string, before long")
    return rows.repartition(max(1, len(files))).mapInArrow(lambda it: _read(it, f"{folder}/files"), "doc_id long, start long, n_tokens long, ids_crc32 long")
