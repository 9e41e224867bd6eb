"""A blocked Bloom filter: built in the executors, bounded in size, probed with numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of one transport segment of the filter (the size that bitmap_or_agg asks for).
SEGMENT = 4096


def probes(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Bit numbers, eight rows: one bit in each 32-bit word of the hash's block of 256 bits."""
    block = (hashes >> np.uint64(32)) % np.uint64(blocks)
    odd = (np.arange(8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
    bit = ((hashes & np.uint64(0xFFFFFFFF)) * odd[:, None] & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
    return block * np.uint64(256) + np.arange(8, dtype=np.uint64)[:, None] * np.uint64(32) + bit


def values(column: pa.Array) -> np.ndarray:
    """64-bit hashes of a column: of longs as they are, of 16-byte binaries the first eight bytes."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint64)[::2]
    return column.to_numpy().astype(np.int64).view(np.uint64)


def build(hashes: DataFrame, most_bytes: int, mix: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """The filter of a column of 64-bit (or 128-bit binary) hashes, as bytes: twelve bits a hash or more, up to ``most_bytes``.

    Beyond that it becomes less selective, never larger.  ``mix`` spreads values that are no hashes yet.
    """
    n = hashes.count()
    size = SEGMENT
    while size < most_bytes and size * 8 < 12 * n:
        size *= 2

    def task(batches):
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            own = values(batch.column(0))
            own = mix(own) if mix else own
            at = np.unique(probes(own, size // 32).ravel()).astype(np.int64)
            segments, begins = np.unique(at // (8 * SEGMENT), return_index=True)
            for s, part in zip(segments.tolist(), np.split(at, begins[1:]), strict=True):
                bits.setdefault(s, np.zeros(SEGMENT, np.uint8))
                places = np.zeros(8 * SEGMENT, bool)
                places[part - s * 8 * SEGMENT] = True
                bits[s] |= np.packbits(places, bitorder="little")
        for s, part in bits.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "bits": pa.array([part.tobytes()], pa.binary())})

    parts = hashes.mapInArrow(task, "segment int, bits binary").groupBy("segment").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    out = np.zeros(size, np.uint8)
    for row in parts.toLocalIterator():
        out[row.segment * SEGMENT : (row.segment + 1) * SEGMENT] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def may_hold(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = probes(hashes, len(bloom) // 32).astype(np.int64)
    return (bloom[at >> 3] >> (at & 7) & 1).all(0)
