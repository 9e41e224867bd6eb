"""Token ids in sorted-string-table shards.

Documents are range-partitioned and sorted by identifier; each partition becomes one shard file in the
shared folder.  A shard holds blocks of prefix-compressed entries (key, token ids), a sparse index with
the last key of each block, a Bloom filter over the keys, and a footer with totals and a checksum.
Looking up one identifier costs a Bloom probe, a binary search in the index and one block.

File layout, little-endian::

    "SSTIDS01"
    block*      zstd of entry*; entry = varint shared, varint rest, varint value bytes, rest of key, value
    index       block* of (u32 key bytes, key, u64 offset, u32 bytes, u32 entries)
    bloom       bits
    footer      u64 index offset, u64 index bytes, u64 bloom offset, u64 bloom bytes, u64 documents,
                u64 tokens, u32 id width, u32 Bloom probes, u32 crc32 of index and bloom, "SSTIDS01"

Shards are written under a name unique to the task attempt and become visible only through the
manifest, a table that Spark commits; files of failed attempts are never referred to.

Defined results
---------------
* ids are integers or strings (others: TypeError before any job);
* null and empty texts hold the end id alone; a null id sorts first; every input row is an entry,
  repeated ids too, and a lookup returns all entries of its key;
* an empty table gives no shards and empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from symcube.llm.common import bound_batches, id_type, materialize, shared_dir
from symcube.llm.tokens import encoded, encoder, in_order

MAGIC = b"SSTIDS01"
FOOTER = struct.Struct("<6Q3I8s")
#: Bits and probes per key: a false-positive rate of about 1 %.
BLOOM_BITS, BLOOM_PROBES = 10, 7


def encode_key(key: int | str | None) -> bytes:
    """Bytes that sort as Spark sorts the identifiers."""
    if key is None:
        return b"\x00"
    if isinstance(key, int):
        return b"\x01" + (key + (1 << 63)).to_bytes(8, "big")
    return b"\x02" + key.encode()


def decode_key(raw: bytes) -> int | str | None:
    kind, rest = raw[:1], raw[1:]
    return None if kind == b"\x00" else int.from_bytes(rest, "big") - (1 << 63) if kind == b"\x01" else rest.decode()


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 128:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit numbers, one row per probe (double hashing of the two halves of a 64-bit hash)."""
    a, b = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return (a + np.arange(probes, dtype=np.uint64)[:, None] * b) % np.uint64(bits)


class Writer:
    """Writes one shard; ``add`` takes the entries in key order."""

    def __init__(self, path: str, width: int, block_bytes: int = 64 << 10):
        self.fs, self.path = pafs.FileSystem.from_uri(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path)
        self.out.write(MAGIC)
        self.at, self.width, self.limit = len(MAGIC), width, block_bytes
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.block, self.entries, self.last = bytearray(), 0, b""
        self.index: list[tuple[bytes, int, int, int]] = []
        self.hashes: list[int] = []
        self.docs = self.tokens = 0

    def add(self, key: bytes, ids: bytes) -> None:
        shared = 0
        if self.entries:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(ids)) + key[shared:] + ids
        self.entries, self.last = self.entries + 1, key
        self.hashes.append(xxhash.xxh3_64_intdigest(key))
        self.docs, self.tokens = self.docs + 1, self.tokens + len(ids) // self.width
        if len(self.block) >= self.limit:
            self._flush()

    def _flush(self) -> None:
        data = self.zstd.compress(bytes(self.block))
        self.out.write(data)
        self.index.append((self.last, self.at, len(data), self.entries))
        self.at += len(data)
        self.block, self.entries = bytearray(), 0

    def close(self) -> None:
        if self.entries:
            self._flush()
        index = b"".join(struct.pack("<I", len(k)) + k + struct.pack("<QII", *rest) for k, *rest in self.index)
        bits = max(64, BLOOM_BITS * self.docs + -BLOOM_BITS * self.docs % 8)
        bloom = np.zeros(bits, np.uint8)
        bloom[_probes(np.array(self.hashes, np.uint64), bits, BLOOM_PROBES).ravel().astype(np.int64)] = 1
        packed = np.packbits(bloom).tobytes()
        crc = zlib.crc32(packed, zlib.crc32(index))
        self.out.write(index + packed)
        self.out.write(
            FOOTER.pack(self.at, len(index), self.at + len(index), len(packed), self.docs, self.tokens, self.width, BLOOM_PROBES, crc, MAGIC)
        )
        self.out.close()


class Reader:
    """Reads one shard: ``get`` looks up a key, iteration yields all entries in key order."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        if size < FOOTER.size:
            raise ValueError(f"{path} is no complete shard")
        foot = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        index_at, index_len, bloom_at, bloom_len, self.docs, self.tokens, self.width, self.probes, crc, magic = foot
        if magic != MAGIC:
            raise ValueError(f"{path} is no complete shard")
        index, self.bloom = self.file.read_at(index_len, index_at), self.file.read_at(bloom_len, bloom_at)
        if zlib.crc32(self.bloom, zlib.crc32(index)) != crc:
            raise ValueError(f"{path} is damaged")
        self.last: list[bytes] = []
        self.where: list[tuple[int, int, int]] = []
        at = 0
        while at < len(index):
            n = struct.unpack_from("<I", index, at)[0]
            self.last.append(index[at + 4 : at + 4 + n])
            self.where.append(struct.unpack_from("<QII", index, at + 4 + n))
            at += 4 + n + 16

    def _block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        offset, size, entries = self.where[i]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(size, offset))
        key, at = b"", 0
        for _ in range(entries):
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, np.frombuffer(data, f"<u{self.width}", n // self.width, at).astype("<u4")
            at += n

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.where)):
            yield from self._block(i)

    def may_hold(self, key: bytes) -> bool:
        at = _probes(np.array([xxhash.xxh3_64_intdigest(key)], np.uint64), 8 * len(self.bloom), self.probes).ravel()
        return all(self.bloom[int(x) >> 3] >> (7 - (int(x) & 7)) & 1 for x in at)

    def get(self, key: int | str | None) -> list[np.ndarray]:
        """The token ids of every entry of an identifier."""
        raw, found = encode_key(key), []
        if self.may_hold(raw):
            i = bisect.bisect_left(self.last, raw)
            while i < len(self.last):
                found += [v for k, v in self._block(i) if k == raw]
                if self.last[i] != raw:
                    break
                i += 1
        return found


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write the shards; returns the manifest: part, path, id_type, first_key, last_key, n_docs, n_tokens."""
    kind, arrow = id_type(docs, doc_id)
    if not (pa.types.is_integer(arrow) or pa.types.is_string(arrow)):
        raise TypeError(f"shards are keyed by integers or strings, not by {kind}")
    bound_batches(docs.sparkSession)
    root = path or f"{shared_dir(docs.sparkSession)}/shards"
    rows = in_order(docs, doc_id, text)

    def task(batches):
        from pyspark import TaskContext

        writer, part, first = None, TaskContext.get().partitionId(), b""
        name = f"{root}/{part:06d}-{uuid.uuid4().hex}.sst"
        for keys, ids in encoded(batches, tokenizer, end_id):
            for key, data in zip(map(encode_key, keys), ids, strict=True):
                if writer is None:
                    writer, first = Writer(name, encoder(tokenizer).dtype.itemsize), key
                writer.add(key, data)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [name], "id_type": [kind], "first_key": [first], "last_key": [writer.last], "n_docs": [writer.docs], "n_tokens": [writer.tokens]}
            )

    return materialize(rows.mapInArrow(task, "part int, path string, id_type string, first_key binary, last_key binary, n_docs long, n_tokens long"), "manifest")


def read_shards(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the shards: doc_id, start (ids of all documents before), n_tokens, ids_crc32[, ids].

    ``start`` is a prefix sum over the manifest, one small row per shard.
    """
    from pyspark.sql import Window as W

    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shards = manifest.select("part", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    n = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count())
    head = manifest.select("id_type").first()  # one small row per shard; none for an empty table
    kind = head["id_type"] if head else "bigint"
    arrow = to_arrow_type(_parse_datatype_string(kind))
    fields = [("doc_id", arrow), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if with_ids else []
    schema = pa.schema(fields)

    def task(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                size = 0
                for key, ids in Reader(path):
                    data = ids.tobytes()
                    row = (decode_key(key), start, len(ids), zlib.crc32(data))
                    rows.append((*row, data) if with_ids else row)
                    start += len(ids)
                    size += len(data) if with_ids else 64
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    spread = shards.select("path", "base").repartition(n)
    return spread.mapInArrow(task, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def lookup(manifest: DataFrame, keys: list) -> dict:
    """Token ids of a few identifiers, opening only shards whose key range holds them."""
    found: dict = {k: [] for k in keys}
    raw = [encode_key(k) for k in keys]
    if keys:
        near = manifest.where(F.col("first_key") <= F.lit(max(raw))).where(F.col("last_key") >= F.lit(min(raw)))
        for shard in near.select("path", "first_key", "last_key").orderBy("part").toLocalIterator():
            wanted = [k for k, r in zip(keys, raw, strict=True) if bytes(shard.first_key) <= r <= bytes(shard.last_key)]
            if wanted:
                reader = Reader(shard.path)
                for k in wanted:
                    found[k] += reader.get(k)
    return found
