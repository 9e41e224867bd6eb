"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are partitioned by their number of shingles, in steps of the square root of two.  For a
partition with items of up to U shingles, every document is covered by windows of 2U shingles that
begin every U/2, so whatever the document's length, an item inside it lies in a window of comparable
size: its Jaccard similarity with that window is at least 0.26 for a containment of 0.8.  Windows and
items are compared by ``hashes`` min-wise hashes, each a band of its own (32 hashes miss such a pair
with probability below 1e-4).  Each candidate pair is then verified by exact containment of the item's
shingle set in the whole document's.

Words are runs of characters other than ASCII white space and punctuation, A-Z lower-cased; a shingle
is five words.  The items are cut into portions of about ``index_shingles`` shingles by their row number, and
each portion is a pass of its own: its shingle sets (eight bytes a shingle) are broadcast, every Python worker
builds the index from them, and the broadcast is destroyed before the next portion.  Neither the driver nor
a worker ever holds more than one portion.  With one portion the documents are filtered in the scan's own
stage; with several, every pass but the last writes what it leaves to the shared folder.

Defined results
---------------
* an item of fewer than five words is one shingle of all its words; items without words or with null
  text are found nowhere; null and empty documents contain nothing;
* repeated items and repeated documents give a row for each pairing; null ids are carried as null;
* ids are integers, decimals, strings or dates (others: TypeError before any job);
* an empty table on either side gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm.common import Workspace, id_type, release_memory, sliced

SHINGLE, THRESHOLD, HASHES = 5, 0.8, 32
_SPLIT = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_STEP = np.uint64(0x100000001B3)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_SPLIT).split()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def word_hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, number of words per text); each distinct word is hashed once."""
    vocab: dict[bytes, int] = {}
    index = [vocab.setdefault(w, len(vocab)) for words in texts for w in words]
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    return table[np.array(index, np.int64)], np.fromiter(map(len, texts), np.int64, len(texts))


def shingles(hashes: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts one after the other, shingles per text)."""
    n = np.maximum(sizes - k + 1, 0)
    ends = np.cumsum(sizes)
    first = np.repeat(ends - sizes - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = np.zeros(len(first), np.uint64)
    for j in range(k):
        h = h * _STEP + mix(hashes[first + j] + np.uint64(j))
    return mix(h), n


def _hash(values: np.ndarray, i: int) -> np.ndarray:
    """The i-th of the min-wise hash functions."""
    rng = np.random.default_rng(1000 + i)
    a, b = (np.uint64(x) for x in rng.integers(1, 1 << 62, 2))
    return ((values * (a * np.uint64(2) + np.uint64(1)) + b) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Index:
    """Items of one shingle length: shingle sets, and per size class the sorted signatures."""

    k: int
    ids: list = field(default_factory=list)
    sets: list[np.ndarray] = field(default_factory=list)

    def build(self, hashes: int) -> Index:
        classes: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            u, step = 1, 0
            while u < len(s):
                step += 1
                u = int(np.ceil(2 ** (step / 2)))
            classes.setdefault(u, []).append(i)
        self.classes = []
        for u, members in sorted(classes.items()):
            bands = []
            for h in range(hashes):
                low = np.array([_hash(self.sets[i], h).min() for i in members], np.uint32)
                order = np.argsort(low, kind="stable")
                near = np.zeros(1 << 16, bool)
                near[low & 0xFFFF] = True
                bands.append((low[order], np.array(members)[order], near))
            self.classes.append((u, bands))
        return self

    def candidates(self, values: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that share a min-wise hash in some window."""
        pairs: set[tuple[int, int]] = set()
        bands = len(self.classes[0][1])
        layout = []
        for u, _ in self.classes:
            g = max(1, u // 2)
            blocks = -(-sizes // g)
            doc = np.repeat(np.arange(len(sizes)), blocks)
            begin = np.cumsum(sizes) - sizes
            at = begin[doc] + g * (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            layout.append((doc, at))
        for h in range(bands):
            hashed = _hash(values, h)
            for (_, signatures), (doc, at) in zip(self.classes, layout, strict=True):
                low, members, near = signatures[h]
                least = np.minimum.reduceat(hashed, at)
                window = least.copy()
                for s in range(1, 4):
                    same = doc[s:] == doc[:-s]
                    np.minimum(window[:-s], least[s:], out=window[:-s], where=same)
                some = np.flatnonzero(near[window & 0xFFFF])
                left, right = np.searchsorted(low, window[some], "left"), np.searchsorted(low, window[some], "right")
                for w, a, b in zip(some[left < right], left[left < right], right[left < right], strict=True):
                    pairs.update((int(doc[w]), int(m)) for m in members[a:b])
        return pairs

    def find(self, hashes: np.ndarray, sizes: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int, int]]:
        """(document, item number, shingles of the item, shingles of it in the document)."""
        values, n = shingles(hashes, sizes, self.k)
        if not len(values):
            return
        starts = np.cumsum(n) - n
        for d, i in sorted(self.candidates(values, n)):
            found = int(np.isin(self.sets[i], values[starts[d] : starts[d] + n[d]]).sum())
            if found >= threshold * len(self.sets[i]):
                yield d, i, len(self.sets[i]), found


@dataclass
class Portion:
    """Shingle sets of some items; the index is built where it is used, once per Python worker."""

    ids: list
    ks: list[int]
    sets: list[bytes]
    built: list[Index] | None = None

    def indexes(self, hashes: int = HASHES) -> list[Index]:
        if self.built is None:
            by_k: dict[int, Index] = {}
            for i, k, data in zip(self.ids, self.ks, self.sets, strict=True):
                index = by_k.setdefault(k, Index(k))
                index.ids.append(i)
                index.sets.append(np.frombuffer(data, np.uint64))
            self.built = [x.build(hashes) for x in by_k.values()]
        return self.built


def item_sets(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id, row, k (words of a shingle), n, shingles (sorted 64-bit hashes) of every item with a word."""
    kind, arrow = id_type(items, item_id)
    fields = [("item_id", arrow), ("row", pa.int64()), ("k", pa.int32()), ("n", pa.int64()), ("shingles", pa.binary())]

    def task(batches):
        for batch in sliced(batches, 2):
            rows = []
            for i, row, body in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if words := words_of(body):
                    k = min(SHINGLE, len(words))
                    values = np.unique(shingles(*word_hashes([words]), k)[0])
                    rows.append((i, row, k, len(values), values.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))

    slim = items.select(F.col(item_id).alias("item_id"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(task, f"item_id {kind}, row long, k int, n long, shingles binary")


def portions(items: DataFrame, item_id: str, text: str, limit: int, work: Workspace) -> Iterator[tuple[Portion, bool]]:
    """(portion, whether it is the last), each of about ``limit`` shingles; items are dealt by a hash of their row number."""
    sets = work.put(item_sets(items, item_id, text), "items")
    total = sets.agg(F.sum("n").alias("n")).first()["n"] or 0
    count = -(-total // limit)
    for c in range(count):
        rows = sets.where(F.pmod(F.xxhash64("row"), F.lit(count)) == c).select("item_id", "k", "shingles").toArrow()
        yield Portion(*(rows.column(i).to_pylist() for i in range(3))), c == count - 1


def _search(texts: list[str | None], index: list[Index], threshold: float) -> Iterator[tuple[int, object, int, int]]:
    hashes, sizes = word_hashes([words_of(t) for t in texts])
    for x in index:
        for d, i, n, found in x.find(hashes, sizes, threshold):
            yield d, x.ids[i], n, found


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    index_shingles: int = 1 << 20,
) -> DataFrame:
    """One row per document and item inside it: doc_id, item_id, n_shingles, n_found, containment."""
    spark, work = docs.sparkSession, Workspace(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    (kind, arrow), (item_kind, item_arrow) = id_type(docs, doc_id), id_type(items, item_id)
    fields = [("doc_id", arrow), ("item_id", item_arrow), ("n_shingles", pa.int64()), ("n_found", pa.int64()), ("containment", pa.float64())]
    shape = f"doc_id {kind}, item_id {item_kind}, n_shingles long, n_found long, containment double"
    found = spark.createDataFrame([], shape)
    for portion, _ in portions(items, item_id, item_text, index_shingles, work):
        sent = work.send(portion)

        def task(batches, sent=sent):
            for batch in sliced(batches, 1):
                keys = batch.column(0).to_pylist()
                rows = [(keys[d], i, n, f, f / n) for d, i, n, f in _search(batch.column(1).to_pylist(), sent.value.indexes(), threshold)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))

        found = found.unionByName(work.put(slim.mapInArrow(task, shape), "found"))
        work.clear("items", "found")
    work.clear("found")
    return found


def _clean(sent, threshold: float):
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_memory()
        for column in columns:
            keep = []
            for part in sliced([pa.RecordBatch.from_arrays([column], names=["text"])], 0, keep_caches=True):
                flags = np.ones(part.num_rows, bool)
                flags[[d for d, *_ in _search(part.column(0).to_pylist(), sent.value.indexes(), threshold)]] = False
                keep.append(flags)
            yield pa.array(np.concatenate(keep) if keep else np.zeros(0, bool))

    return clean


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, index_shingles: int = 1 << 20) -> DataFrame:
    """The documents that contain no test item, with all their columns; no shuffle."""
    work = Workspace(docs.sparkSession)
    for portion, last in portions(items, item_id, item_text, index_shingles, work):
        sent = docs.sparkSession.sparkContext.broadcast(portion)

        # only the texts go to Python; the rows stay where they are
        docs = docs.where(F.arrow_udf(_clean(sent, threshold), "boolean")(F.col(text).cast("string")))
        if not last:
            docs = work.put(docs, "left")
            sent.destroy()
    return docs
