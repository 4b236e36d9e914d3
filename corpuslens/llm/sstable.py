"""Token ids in sorted-string-table shards, and their lookup by binary search.

A shard holds documents in ascending order of their keys:

    block*  index  bloom  footer  pad

* A key is the doc_id as 8 big-endian bytes with the sign bit turned, so that bytes sort
  as numbers do; a null doc_id has the empty key, which comes first. Keys may repeat.
* A block (about 64 KB before compression) is a zstd frame of entries: varints for the
  length of the prefix shared with the key before it in the block, of the rest of the key
  and of the value, then the rest of the key and the value. A value is a byte for the ids'
  width (2 or 4), then the ids, little-endian.
* The index has each block's last key (length and bytes), offset, length and CRC.
* The Bloom filter has ten bits a key and seven probes.
* The footer of 72 bytes has the magic, the places of index and filter, the counts of
  documents and ids, the shard's place in the order of shards, and a CRC of the index, the
  filter and the footer's other fields, so no changed byte passes. One pad byte ends the file, as the writer ends each record with one.

Shards are written by Spark's own text writer as one record a file, so they get its
commit protocol: a task that is lost and run again leaves no half-written shard, and any
store that Spark writes to will do. That writer puts out the bytes of a string as they are,
so a cast of the binary column to string, which Spark doesn't check, is all it takes; the
CRC of each shard and those of its blocks would show a writer that did otherwise.
Memory holds one shard of ``SHARD_BYTES`` at a time, in the worker and in the executor.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices
from corpuslens.llm.store import Workspace
from corpuslens.llm.tokenizing import BYTE_BPE, encoder

MAGIC = b"CLSST\x00\x00\x01"
_FOOTER = struct.Struct("<8sQQQQQQQII")
BLOCK_BYTES, SHARD_BYTES = 64 << 10, 64 << 20
END_ID = 0
#: Bytes of text that a task encodes at once.
SLICE_BYTES = 1 << 20
PROBES, BITS_A_KEY = 7, 10


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x5BD1E995) | 1
    return [(a + k * b) % bits for k in range(PROBES)]


def _checked(tail: bytes, fields: tuple) -> int:
    """The CRC of index and filter, and of the footer's other fields."""
    return zlib.crc32(_FOOTER.pack(*fields, 0, 0), zlib.crc32(tail))


class ShardWriter:
    """Builds one shard in memory; keys must not fall."""

    def __init__(self, place: int):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=1).compress
        self.place, self.parts, self.size, self.index, self.keys, self.n_ids = place, [], 0, [], [], 0
        self._start_block()

    def _start_block(self) -> None:
        self.block, self.block_size, self.last = [], 0, b""

    def _end_block(self) -> None:
        if self.block:
            data = self.pack(b"".join(self.block))
            self.index.append((self.last, self.size, len(data), zlib.crc32(data)))
            self.parts.append(data)
            self.size += len(data)
            self._start_block()

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key = key_of(doc_id)
        shared = 0
        while self.block and shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        narrow = not len(ids) or int(ids.max()) < 1 << 16
        value = (b"\x02" + ids.astype("<u2").tobytes()) if narrow else (b"\x04" + ids.astype("<u4").tobytes())
        entry = b"".join((_varint(shared), _varint(len(key) - shared), _varint(len(value)), key[shared:], value))
        self.block.append(entry)
        self.block_size += len(entry)
        self.last = key
        self.keys.append(key)
        self.n_ids += len(ids)
        if self.block_size >= BLOCK_BYTES:
            self._end_block()

    def finish(self) -> bytes:
        self._end_block()
        index = b"".join(_varint(len(k)) + k + _varint(at) + _varint(n) + _varint(crc) for k, at, n, crc in self.index)
        bits = max(64, BITS_A_KEY * len(self.keys))
        bloom = np.zeros(-(-bits // 8), np.uint8)
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        tail = index + bloom.tobytes()
        fields = (MAGIC, self.size, len(index), self.size + len(index), bits, len(self.keys), self.n_ids, self.place)
        return b"".join([*self.parts, tail, _FOOTER.pack(*fields, _checked(tail, fields), 0)])


class Shard:
    """Reads a shard; ``get`` reads one or two of its blocks only."""

    def __init__(self, data: bytes):
        import zstandard

        self.data, self.unpack = data, zstandard.ZstdDecompressor().decompress
        *fields, crc, _ = _FOOTER.unpack_from(data, len(data) - 1 - _FOOTER.size)
        magic, at, size, bloom, self.bits, self.n_docs, self.n_ids, self.place = fields
        tail = data[at : bloom + -(-self.bits // 8)]
        if magic != MAGIC or _checked(tail, fields) != crc:
            raise ValueError("not a whole shard")
        self.bloom = tail[size:]
        self.last, self.where, k = [], [], 0
        while k < size:
            n, k = _read_varint(tail, k)
            self.last.append(tail[k : k + n])
            start, k = _read_varint(tail, k + n)
            n, k = _read_varint(tail, k)
            crc, k = _read_varint(tail, k)
            self.where.append((start, n, crc))

    def _entries(self, block: int) -> Iterator[tuple[bytes, np.ndarray]]:
        start, n, crc = self.where[block]
        data = self.data[start : start + n]
        if zlib.crc32(data) != crc:
            raise ValueError("a block has changed")
        data = self.unpack(data)
        at, key = 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            own, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + own]
            at += own
            yield key, np.frombuffer(data[at + 1 : at + size], "<u2" if data[at] == 2 else "<u4").astype("<u4")
            at += size

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for block in range(len(self.where)):
            for key, ids in self._entries(block):
                yield id_of(key), ids

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of each document with this doc_id; none if there is no such one."""
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits)):
            return []
        found, block = [], bisect_left(self.last, key)
        while block < len(self.where):
            for k, ids in self._entries(block):
                if k == key:
                    found.append(ids)
                elif k > key:
                    return found
            block += 1
        return found


def _shard_rows(vocabulary: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        made = lambda w: pa.RecordBatch.from_arrays([pa.array([w.finish()], pa.binary())], ["shard"])
        writer = None
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                texts = tokens.encode(piece.column(1).to_pylist())
                for doc_id, ids in zip(piece.column(0).to_pylist(), texts, strict=True):
                    writer = writer or ShardWriter(part << 32 | seq)
                    writer.add(doc_id, np.append(ids, np.uint32(END_ID)))
                    if writer.size >= SHARD_BYTES:
                        yield made(writer)
                        writer, seq = None, seq + 1
        if writer:
            yield made(writer)

    return rows


def write_shards(docs: DataFrame, path: str, vocabulary: str = BYTE_BPE) -> None:
    """Encode ``docs(doc_id, text)`` and write shards in ascending doc_id order to ``path``.

    Rows that share a doc_id follow each other, in the order of a hash of their texts, and
    may be parted between tasks. A null text is empty and has the end id alone.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = text.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    shards = ordered.mapInArrow(_shard_rows(vocabulary), "shard binary")
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            data = batch.column(0)[k].as_py()
            if not data:
                continue
            shard, out, at = Shard(data), [[], [], [], []], 0
            for doc_id, ids in shard.scan():
                for column, value in zip(out, (doc_id, at, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                    column.append(value)
                at += len(ids)
            kinds = [pa.array([shard.place] * len(out[0]), pa.int64()), *(pa.array(c, pa.int64()) for c in out)]
            yield pa.RecordBatch.from_arrays(kinds, ["place", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_shards(docs: DataFrame, path: str, work: Workspace) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the shards at ``path``.

    The counts of ids before each shard are summed over one row a shard of 64 MB, in one
    task: half a million rows for 100 TB of text.
    """
    files = docs.sparkSession.read.format("binaryFile").load(path).select("content")
    found = work.write(files.mapInArrow(_read_rows, "place long, doc_id long, at long, n_tokens long, ids_crc32 long"), "documents")
    sizes = found.groupBy("place").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select("place", (F.sum("n").over(Window.orderBy("place")) - F.col("n")).alias("before"))
    return found.join(work.write(before, "places"), "place").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Write shards of ``docs(doc_id, text)`` in the shared folder and read them back.

    One row per row of ``docs``: doc_id, start (ids of all documents before it), n_tokens
    (with the end id) and ids_crc32 (of the ids as little-endian unsigned 32-bit integers).
    A null or empty text has one id. Rows with a null doc_id come first. An empty table
    gives no rows. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "sstable")
    write_shards(docs, f"{work.path}/shards", vocabulary)
    return read_shards(docs, f"{work.path}/shards", work)
