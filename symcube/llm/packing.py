"""Concatenate-and-cut packing of token ids into sequences of fixed length.

Pass 1 encodes the documents once, where they are stored (or range-sorted by id, at the cost of a shuffle
of the texts), and writes (document, partition, offset within the partition, ids).  The partitions' token totals, one small row each, give every partition's
global offset by a prefix sum.  Pass 2 then cuts each document, by itself, at the multiples of the
sequence length: no state crosses partitions, so a lost executor only repeats its own tasks.
The boundary records are the pieces with ``continued`` (the document began in an earlier sequence) or
``continues`` (it goes on in the next one).  Only the last sequence can be shorter than ``length``.

Defined results
---------------
* null and empty texts give a piece that holds the end id alone;
* documents follow each other as the input's partitions and rows do; with ``by_id`` by id, null ids
  first, equal ids by a hash of their text; every input row is packed, repeated rows too;
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from symcube.llm.common import bound_batches, id_type, materialize, release_memory, text_or_empty
from symcube.llm.tokens import CACHE_WORDS, encoded, encoder, in_order


def encode_once(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", by_id: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pass 1, written: doc_id, part, local (tokens of the partition before it), n_tokens, ids (narrow little-endian)."""
    bound_batches(docs.sparkSession)
    plain = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = in_order(docs, doc_id, text) if by_id else plain
    kind, arrow = id_type(rows, "doc_id")

    def task(batches):
        part, local = TaskContext.get().partitionId(), 0
        width = encoder(tokenizer, cache_words).dtype.itemsize
        for keys, ids in encoded(batches, tokenizer, end_id, cache_words=cache_words):
            n = np.array([len(x) // width for x in ids], np.int64)
            ends = local + np.cumsum(n)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": keys, "part": np.full(len(keys), part, np.int32), "local": ends - n, "n_tokens": n, "ids": pa.array(ids, pa.binary())},
                schema=pa.schema([("doc_id", arrow), ("part", pa.int32()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]),
            )
            local = int(ends[-1])

    return materialize(rows.mapInArrow(task, f"doc_id {kind}, part int, local long, n_tokens long, ids binary"), "ids")


def with_start(ids: DataFrame) -> DataFrame:
    """Adds ``begin``, the number of ids of all documents before; sums one row per partition."""
    totals = ids.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # one row per partition of pass 1, so the broadcast stays tiny
    return ids.join(F.broadcast(bases), "part").withColumn("begin", F.col("base") + F.col("local"))


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = True, by_id: bool = False, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, continued, continues[, ids].

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers.  ``cache_words`` bounds the words
    whose ids a Python worker remembers: fewer cost some CPU time and save memory.
    """
    stored = with_start(encode_once(docs, tokenizer, end_id, doc_id, text, by_id, cache_words)).select("doc_id", "begin", "n_tokens", "ids")
    kind, arrow = id_type(stored, "doc_id")
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    flags = ["continued", "continues"]
    fields = [("doc_id", arrow), *((n, pa.int64()) for n in names), *((n, pa.bool_()) for n in flags)]
    fields += [("ids", pa.binary())] if keep_ids else []
    schema = pa.schema(fields)

    def task(batches):
        release_memory()  # of the encoder's words, which this pass doesn't need
        for batch in batches:
            rows: list[tuple] = []
            for key, begin, n, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                wide = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4").tobytes()
                at = 0
                while at < n:
                    to = min(n, at + length - (begin + at) % length)
                    piece = wide[4 * at : 4 * to]
                    row = (key, at, to - at, zlib.crc32(piece), n, (begin + at) // length, (begin + at) % length, at > 0, to < n)
                    rows.append((*row, piece) if keep_ids else row)
                    at = to
                if keep_ids and len(rows) >= 2_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    more = "".join(f", {n} long" for n in names) + "".join(f", {n} boolean" for n in flags) + ", ids binary" * keep_ids
    return stored.mapInArrow(task, f"doc_id {kind}{more}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
