"""Token ids in sorted-string-table shards.

A shard, all numbers little-endian:
  blocks   entries in key order. An entry: u16 bytes shared with the key before, u16 further bytes of the key, u32 ids,
           the further bytes, the ids. A block's first entry shares nothing. At least BLOCK_BYTES, one entry or more.
  index    for each block: u64 offset, u32 size, u32 entries, u16 key length, the first key
  bloom    the filter's bits
  footer   u64 index offset, u64 index size, u64 bloom offset, u64 bloom size, u32 hashes, u64 documents, u64 ids,
           u32 bytes of an id (2 or 4), u32 crc32 of index and bloom, 8 bytes of magic
A key is the document's id as 8 bytes, big-endian with the sign bit turned, so that bytes sort as ids do; no bytes at all
stand for a null id, which sorts first.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches_of, scratch_path, stored, text_of
from .tokens import TEXTS, encoder, widened

MAGIC = b"TOKSST02"
BLOCK_BYTES = 1 << 16
#: Bytes of text that a shard has on average, at most.
SHARD_BYTES = 1 << 27
BLOOM_BITS, BLOOM_HASHES = 10, 7
_ENTRY, _INDEX, _FOOTER = struct.Struct("<HHI"), struct.Struct("<QIIH"), struct.Struct("<QQQQIQQII8s")


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def _hashes(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h & ((1 << 64) - 1), (h >> 64) | 1


def _places(key: bytes, bits: int, hashes: int) -> list[int]:
    a, b = _hashes(key)
    return [(a + i * b) % bits for i in range(hashes)]


class ShardWriter:
    """Entries must come in ascending order of key; equal keys may follow each other. Blocks are written as they fill."""

    def __init__(self, out, width: int = 4):
        self.out, self.width, self.at, self.index, self.keys = out, width, 0, [], array("Q")
        self.block, self.first, self.last, self.entries, self.ids, self.documents, self.least = bytearray(), b"", b"", 0, 0, 0, b""

    def add(self, key: bytes, ids: bytes) -> None:
        if self.documents and key < self.last:
            raise ValueError("keys must ascend")
        if not self.documents:
            self.least = key
        shared = 0 if not self.entries else len(os.path.commonprefix([self.last, key]))
        if not self.entries:
            self.first = key
        self.block += _ENTRY.pack(shared, len(key) - shared, len(ids) // self.width) + key[shared:] + ids
        self.last = key
        self.entries += 1
        self.ids += len(ids) // self.width
        self.documents += 1
        self.keys.extend(_hashes(key))
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.entries:
            self.out.write(bytes(self.block))
            self.index.append((self.at, len(self.block), self.entries, self.first))
            self.at += len(self.block)
            self.block, self.entries = bytearray(), 0

    def finish(self) -> int:
        """Writes what is left; the size in bytes."""
        self._flush()
        index = b"".join(_INDEX.pack(at, size, n, len(key)) + key for at, size, n, key in self.index)
        bits = max(64, self.documents * BLOOM_BITS)
        bloom = bytearray((bits + 7) // 8)
        for a, b in zip(self.keys[::2], self.keys[1::2], strict=True):
            for i in range(BLOOM_HASHES):
                p = (a + i * b) % (len(bloom) * 8)
                bloom[p >> 3] |= 1 << (p & 7)
        footer = _FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), BLOOM_HASHES, self.documents, self.ids, self.width, zlib.crc32(index + bytes(bloom)), MAGIC)
        self.out.write(index + bytes(bloom) + footer)
        return self.at + len(index) + len(bloom) + len(footer)


class ShardReader:
    """Reads a shard from a seekable file. Only footer, index and filter are held; blocks are read as they are needed."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - _FOOTER.size)
        at, size, self.bloom_at, self.bloom_size, self.hashes, self.documents, self.ids, self.width, crc, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        file.seek(at)
        both = file.read(size + self.bloom_size)
        if zlib.crc32(both) != crc:
            raise ValueError("index or filter is damaged")
        self.bloom, self.blocks, i = both[size:], [], 0
        while i < size:
            offset, n, entries, k = _INDEX.unpack_from(both, i)
            i += _INDEX.size
            self.blocks.append((offset, n, entries, both[i : i + k]))
            i += k
        self.firsts = [b[3] for b in self.blocks]

    def _entries(self, block) -> Iterator[tuple[bytes, bytes]]:
        offset, size, n, _ = block
        self.file.seek(offset)
        data, i, key = self.file.read(size), 0, b""
        for _ in range(n):
            shared, more, ids = _ENTRY.unpack_from(data, i)
            i += _ENTRY.size
            key = key[:shared] + data[i : i + more]
            i += more
            yield key, widened(data[i : i + self.width * ids], self.width)
            i += self.width * ids

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for block in self.blocks:
            yield from self._entries(block)

    def get(self, key: bytes) -> list[bytes]:
        """The ids of all entries of the key: the filter first, then a binary search of the index, then a block."""
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _places(key, len(self.bloom) * 8, self.hashes)):
            return []
        out, i = [], max(0, bisect_right(self.firsts, key) - 1)
        while i and self.firsts[i] == key:  # equal keys may have begun in a block before
            i -= 1
        for block in self.blocks[i:]:
            if block[3] > key:
                break
            out += [ids for k, ids in self._entries(block) if k == key]
        return out


def _plain(scalar: pa.Scalar):
    return scalar.as_py()


def _place(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system, path


def write_shards(docs: DataFrame, path: str, tokenizer: str, style: str, end_id: int, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes docs and writes one shard for each range of ids; the manifest: shard, file, documents, ids, bytes, and the
    least and greatest key (see key_of()).

    shards: by default as many as SHARD_BYTES of text ask for, or as the session has shuffle partitions if those are more. Rows are dealt by range of (id, hash of the text), so shards ascend and a range is one task's. Within one id, rows
    stand in order of that hash. Null texts count as empty. A task writes to a name of its own and renames at its end,
    so a task that ran twice leaves one shard; the manifest, stored when all are written, says which files count. What a
    task holds of a document once it is written is two hashes for the filter.
    """
    spark = docs.sparkSession
    key = F.col(id_col).cast("long")
    if not shards:
        size = docs.agg(F.sum(F.octet_length(text_of(docs, text_col)).cast("long"))).first()[0] or 0
        shards = max(-(-size // SHARD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(key.alias("k"), F.xxhash64(text_of(docs, text_col)).alias("h"), text_of(docs, text_col).alias("t"))
    dealt = rows.repartitionByRange(shards, F.col("k").asc_nulls_first(), F.col("h")).sortWithinPartitions(F.col("k").asc_nulls_first(), "h").select(F.spark_partition_id().alias("p"), "k", "t")

    def run(batches):
        one = encoder(tokenizer, style)
        end = one.packed([end_id])
        writer = out = None
        for batch in batches:
            for p, k, t in zip(*(map(_plain, batch.column(i)) for i in range(3)), strict=True):
                if writer is None:
                    system, base = _place(path)
                    system.create_dir(base, recursive=True)
                    draft, final, shard = f"{base}/.draft-{uuid.uuid4().hex}", f"shard-{p:06d}.sst", p
                    out = system.open_output_stream(draft)
                    writer = ShardWriter(out, one.width)
                writer.add(key_of(k), one.encode(t) + end)
        one.forget()
        if writer is not None:
            size = writer.finish()
            out.close()
            system.move(draft, f"{base}/{final}")
            numbers = (pa.array([x], pa.int64()) for x in (writer.documents, writer.ids, size))
            keys = (pa.array([x], pa.binary()) for x in (writer.least, writer.last))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"{path}/{final}"]), *numbers, *keys], ["shard", "file", "documents", "ids", "bytes", "least", "greatest"])

    with batches_of(spark, TEXTS):
        return stored(dealt.mapInArrow(run, "shard int, file string, documents long, ids long, bytes long, least binary, greatest binary"), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids for each document of the shards, each shard read by one task. start: the ids of all documents before it."""
    from pyspark.sql import Window

    # one row a shard; the window's single task sees no documents
    offsets = manifest.withColumn("before", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("file", "before")
    n = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = _place(file)
                with system.open_input_file(path) as f:
                    rows, held = [], 0
                    for key, ids in ShardReader(f):
                        rows.append((id_of(key), at, len(ids) // 4, ids))
                        at, held = at + len(ids) // 4, held + len(ids)
                        if len(rows) == 2000 or held > 1 << 24:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "n_tokens", "ids"])

    return offsets.repartitionByRange(n, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def lookup(manifest_rows: list, doc_id: int | None) -> list[bytes]:
    """The ids of each document of that id (null ids have a key too), in the order they are stored; none: an empty list.
    Only shards whose keys span it are opened, and their filter asked before a block is read."""
    key, out = key_of(doc_id), []
    for row in sorted(manifest_rows, key=lambda r: r.shard):
        if row.least <= key <= row.greatest:
            system, path = _place(row.file)
            with system.open_input_file(path) as f:
                out += ShardReader(f).get(key)
    return out


def shard_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "shards")
