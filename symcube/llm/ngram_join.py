"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct three-word shingles, as 64-bit hashes.  Equal sets (equal 128-bit hashes)
are one class from the start.  All tokens have one global order: tokens of a single document first, then rare
ones, then frequent ones, each by hash.  A set of n tokens can lose at most t = n - ceil(0.9 n) of them and
still link, so it indexes a prefix in that order from which no t tokens can remove every signature.  A
rare token is a signature by itself.  Frequent tokens are dealt into subclasses by hash, and their
signatures are the pairs of tokens of one subclass; a subclass with m tokens in the prefix withstands
the loss of m - 1, so the prefix is extended by one token for each subclass.  The number of subclasses
grows with the set's size (by powers of two; sets near a boundary are indexed for both sides), which
keeps the pairs of a long document in proportion to its length.  Unique tokens take up their place in
the prefix, but need no index entry.

Which token is unique, rare or frequent: of all documents, every token whose hash lies in the lowest
part of the hash range (nearly twice the prefix's share of a set) is counted exactly; the prefix rarely
reaches further, as it takes the tokens with the lowest hashes first.  Tokens above that are treated
like frequent ones.  The counted tokens of several documents, and among them those of at least
``frequent``, go into two Bloom filters of at most ``bloom_bytes`` each, which are broadcast.  A filter
that is too small for the corpus takes rare tokens for frequent ones, which costs some more signatures;
whatever the filters hold, the result is the same.  The one pass over the texts stores the counted tokens;
sets whose rare tokens fill the prefix are signed from those, and only the others' texts are read again.

Sets that share a signature are candidates.  Each signature points to its first holder, found by partial
aggregation, so no bucket is ever expanded to its pairs.  The candidates are verified in two steps:

1. Every set is compared exactly with one of its first holders, its pivot.  A hot pivot's sets are dealt into
   portions, each with a copy of the pivot.  What links is closed to classes.
2. The connected components of the candidate graph are the clusters.  A cluster that is one class by now is
   done: a large group of near copies ends here, in linear work.  In any other cluster, pairs of different
   classes are verified exactly with an inverted index.  Clusters of more than ``block_tokens`` tokens are
   cut into blocks by size and hash, and each pair of blocks of neighbouring sizes is a task of its own,
   except for pairs of blocks of the cluster's largest class, which is connected already.

Defined results
---------------
* A-Z are lower-cased; words are runs of other characters than [\\x20\\x09-\\x0D]; a document with one or
  two words has one shingle, the whole sequence; without words, or with null text, n_shingles is 0 and
  the document is linked with nothing, its component_id is its own id;
* every input row gives a row, repeated rows too; rows with null id take part, but component_id is the
  smallest id that is not null (null if there is none);
* ids are integers, decimals, strings or dates (others: TypeError before any job);
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm import bloom
from symcube.llm.common import Workspace, id_type, sliced
from symcube.llm.decontaminate import mix, shingles, word_hashes
from symcube.llm.graph import connected_components

WORDS, LINK = 3, (90, 100)


def least_overlap(n: int, link: tuple[int, int] = LINK) -> int:
    """The least intersection of a set of n tokens with any set that it links with."""
    return -(-link[0] * n // link[1])


def counted_range(link: tuple[int, int]) -> np.uint64:
    """Tokens with a hash below this are counted: nearly twice the share of a set that its prefix takes."""
    share = min(15 * (link[1] - link[0]) * 16 // (8 * link[1]), 15)
    return np.uint64(max(share, 1) << 60)


def token_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    split = [(t or "").encode().lower().split() for t in texts]
    values, n = shingles(*word_hashes(split), words)
    for w, e, k in zip(split, np.cumsum(n), n, strict=True):
        if k:
            out.append(np.unique(values[e - k : e]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), 1)] if w else [], np.uint64))
    return out


def set_id(tokens: np.ndarray) -> bytes:
    """128 bits: tells all sets of a corpus apart."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _levels(n: int, link: tuple[int, int]) -> range:
    """Size levels of a set and of all sizes that it can link with."""
    return range(least_overlap(n, link).bit_length(), (n * link[1] // link[0]).bit_length() + 1)


class Tokens:
    """What the corpus says about tokens; the same for every set, whatever it says.

    Two Bloom filters: the counted tokens of several documents (a counted token that it doesn't hold is
    unique), and among them the frequent ones.
    """

    def __init__(self, shared: np.ndarray, frequent: np.ndarray):
        self.shared, self.frequent = shared, frequent

    def is_shared(self, tokens: np.ndarray) -> np.ndarray:
        return bloom.may_hold(self.shared, mix(tokens))

    def is_frequent(self, tokens: np.ndarray) -> np.ndarray:
        return bloom.may_hold(self.frequent, mix(tokens))


def early_signatures(front: np.ndarray, n: int, known: Tokens, link: tuple[int, int] = LINK) -> np.ndarray | None:
    """The signatures of a set of n tokens whose counted tokens fill the prefix by themselves; None if they don't."""
    if n * link[1] // link[0] == n:
        return np.zeros(0, np.uint64)  # too small to link with another set
    shared = front[known.is_shared(front)]
    need = n - least_overlap(n, link) + 1 - (len(front) - len(shared))  # unique tokens stand first, and no other set indexes them
    if need <= 0:
        return np.zeros(0, np.uint64)
    rare = shared[~known.is_frequent(shared)]
    return mix(rare[:need]) if len(rare) >= need else None


def signatures(tokens: np.ndarray, known: Tokens, link: tuple[int, int] = LINK) -> np.ndarray:
    """The signatures of a set; two sets that link, and differ, have one in common."""
    n, end = len(tokens), int(np.searchsorted(tokens, counted_range(link)))
    front = tokens[:end]
    if (early := early_signatures(front, n, known, link)) is not None:
        return early
    shared = front[known.is_shared(front)]
    need = n - least_overlap(n, link) + 1 - (end - len(shared))
    often = known.is_frequent(shared)
    rare = shared[~often]
    out = [mix(rare)]
    rest = np.concatenate([tokens[end:], shared[often]])
    for level in _levels(n, link):
        classes = np.uint64(max(1, (1 << level) // 64))
        own = mix(rest) % classes
        first = np.zeros(len(rest), bool)
        first[np.unique(own, return_index=True)[1]] = True
        gain = len(rare) + np.cumsum(~first)
        stop = int(np.searchsorted(gain, need)) + 1
        chosen, own = rest[:stop], own[:stop]
        order = np.argsort(own, kind="stable")
        chosen, own = chosen[order], own[order]
        bounds = np.flatnonzero(np.diff(own)) + 1
        for part in np.split(chosen, bounds):
            if len(part) > 1:
                i, j = np.triu_indices(len(part), 1)
                low, high = np.minimum(part[i], part[j]), np.maximum(part[i], part[j])
                out.append(mix(low * np.uint64(3) + mix(high + np.uint64(level))))
    return np.unique(np.concatenate(out))


def forest(sets: list[np.ndarray], side: np.ndarray | None = None, link: tuple[int, int] = LINK, known: np.ndarray | None = None) -> np.ndarray:
    """Component labels (the least member's number) of the exact link graph of some sets.

    With ``side``, only pairs of different sides are compared.  Sets with equal ``known`` are connected already.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    label = np.arange(count)
    if known is not None:
        _, first, group = np.unique(known, return_index=True, return_inverse=True)
        label = first[group]
    universe, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    frequency = np.bincount(inverse, minlength=len(universe))
    rank = np.empty(len(universe), np.int64)
    rank[np.argsort(frequency, kind="stable")] = np.arange(len(universe))
    ends = np.cumsum(sizes)
    ranked = [np.sort(rank[inverse[e - n : e]]) for e, n in zip(ends, sizes, strict=True)]
    flat, begin = np.concatenate(ranked), ends - sizes
    prefix = [r[: len(r) - least_overlap(len(r), link) + 1] for r in ranked]
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    token = np.concatenate(prefix)
    holder = np.repeat(place, [len(p) for p in prefix])
    by = np.lexsort((holder, token))
    token, holder = token[by], holder[by]
    marked = np.zeros(len(universe), bool)
    for p in range(1, count):
        x = order[p]
        left, right = np.searchsorted(token, prefix[x], "left"), np.searchsorted(token, prefix[x], "right")
        shared = right - left > 1
        if not shared.any():
            continue
        near = np.concatenate([holder[a:b] for a, b in zip(left[shared], right[shared], strict=True)])
        near = order[np.unique(near[near < p])]
        near = near[sizes[near] >= least_overlap(sizes[x], link)]
        if side is not None:
            near = near[side[near] != side[x]]
        marked[ranked[x]] = True
        step = 32
        while len(near := near[label[near] != label[x]]):
            some, near = near[:step], near[step:]
            n = sizes[some]
            starts = np.cumsum(n) - n
            at = np.repeat(begin[some] - starts, n) + np.arange(n.sum())
            both = np.add.reduceat(marked[flat[at]], starts, dtype=np.int64)
            for y in some[link[1] * both >= link[0] * (sizes[x] + n - both)]:
                low, high = sorted((label[x], label[y]))
                if low != high:
                    label[label == high] = low
            step = min(2 * step, 2048)
        marked[ranked[x]] = False
    return label


def _binary(values: list[bytes], counts: list[int]) -> pa.Array:
    """Each 16-byte value as often as its count says."""
    data = np.repeat(np.frombuffer(b"".join(values), "V16"), counts).tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(data) // 16, [None, pa.py_buffer(data)]).cast(pa.binary())


def _tokens(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def measured(docs: DataFrame, doc_id: str, text: str, words: int, link: tuple[int, int]) -> DataFrame:
    """The one pass over all texts: doc_id, tag (hash of id and text), n_shingles, sid, front (the counted tokens)."""
    kind, arrow = id_type(docs, doc_id)
    limit = counted_range(link)

    def task(batches):
        for batch in sliced(batches, 2):
            sets = token_sets(batch.column(2).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(arrow),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[: np.searchsorted(s, limit)].tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "tag", "n_shingles", "sid", "front"],
            )

    return texts_of(docs, doc_id, text).mapInArrow(task, f"doc_id {kind}, tag long, n_shingles long, sid binary, front binary")


def texts_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, tag, text: a tag tells rows apart, but for repeated rows."""
    body = F.col(text).cast("string")
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), body).alias("tag"), body.alias("text"))


def corpus_tokens(sets: DataFrame, frequent: int, bloom_bytes: int, work: Workspace) -> Tokens:
    """Exact document counts of the counted tokens, reduced to two bounded filters."""

    def task(batches):
        for batch in sliced(batches, 0, 8_000_000):
            front = _tokens(batch.column(0))
            yield pa.RecordBatch.from_pydict({"token": np.concatenate(front).view(np.int64)})

    each = sets.select("front").where("front IS NOT NULL").mapInArrow(task, "token long")
    counts = work.put(each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    filled = lambda df: bloom.build(df.select("token"), bloom_bytes, mix)
    return Tokens(filled(counts), filled(counts.where(F.col("n") >= frequent)))


def _early_task(link: tuple[int, int], sent):
    """(sig, sid, tag) from (tag, n_shingles, sid, front); a set whose text is needed gives a row without sig."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in sliced(batches, 3, 8_000_000):
            sids, sigs, late, tags = [], [], [], []
            for tag, n, sid, front in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if sid in seen:
                    continue  # copies of a set are dropped before the shuffle
                if len(seen) > 300_000:
                    seen.clear()
                seen.add(sid)
                own = early_signatures(np.frombuffer(front, np.uint64), n, sent.value, link)
                if own is None:
                    late.append(sid)
                    tags.append(tag)
                elif len(own):
                    sigs.append(own.view(np.int64))
                    sids.append(sid)
            if sigs:
                flat = pa.array(np.concatenate(sigs))
                yield pa.RecordBatch.from_arrays([flat, _binary(sids, [len(x) for x in sigs]), pa.nulls(len(flat), pa.int64())], names=["sig", "sid", "tag"])
            if late:
                yield pa.RecordBatch.from_arrays([pa.nulls(len(late), pa.int64()), pa.array(late, pa.binary()), pa.array(tags, pa.int64())], names=["sig", "sid", "tag"])

    return task


def picked_sets(batches: Iterator[pa.RecordBatch], words: int, tags: np.ndarray) -> Iterator[tuple[list[bytes], list[np.ndarray]]]:
    """(sids, sets) of the rows of (tag, text) whose tag the filter may hold; repeated sets of a task once."""
    seen: set[bytes] = set()
    for batch in sliced(batches, 1):
        keep = np.flatnonzero(bloom.may_hold(tags, mix(batch.column(0).to_numpy().view(np.uint64))))
        if len(keep):
            found = [(set_id(s), s) for s in token_sets(batch.column(1).take(pa.array(keep)).to_pylist(), words) if len(s)]
            fresh = {k: s for k, s in found if k not in seen}
            if len(seen) > 300_000:
                seen.clear()
            seen.update(fresh)
            yield list(fresh), list(fresh.values())


def _late_task(words: int, link: tuple[int, int], known, tags):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, sets in picked_sets(batches, words, tags.value):
            sigs = [signatures(s, known.value, link).view(np.int64) for s in sets]
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), _binary(sids, [len(x) for x in sigs])], names=["sig", "sid"])

    return task


def _picked_task(words: int, tags):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, sets in picked_sets(batches, words, tags.value):
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sid", "tokens"])

    return task


def _held_task(sent):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bloom.may_hold(sent.value, mix(batch.column(0).to_numpy().view(np.uint64)))
            yield batch.filter(pa.array(hit))

    return task


def candidate_edges(index: DataFrame, bloom_bytes: int, work: Workspace) -> DataFrame:
    """(a, b): a set and the first holder of one of its signatures.

    Most signatures have one holder.  A bounded filter of the others keeps those rows out of the join.
    """
    first = index.groupBy("sig").agg(F.min("sid").alias("b"), F.max("sid").alias("top")).where("b <> top").select("sig", "b")
    first = work.put(first, "first")
    sent = work.send(bloom.build(first.select("sig"), bloom_bytes, mix))
    held = index.mapInArrow(_held_task(sent), "sig long, sid binary")
    edges = held.join(first, "sig").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct()
    return work.put(edges, "candidates")


def _pivot_task(link: tuple[int, int]):
    """Links (a, b) from (pivot, part, member, sid, tokens), where a pivot's own row comes before those of its sets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pivot = b"", np.zeros(0, np.uint64)
        for batch in sliced(batches, 4, 8_000_000):
            linked = []
            for key, member, sid, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                x = np.frombuffer(tokens, np.uint64)
                if not member:
                    own, pivot = key, x
                elif key == own:
                    at = np.minimum(np.searchsorted(pivot, x), len(pivot) - 1)
                    both = int((pivot[at] == x).sum())
                    if link[1] * both >= link[0] * (len(x) + len(pivot) - both):
                        linked.append((sid, key))
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*linked, strict=True)], names=["a", "b"])

    return task


def _block_task(link: tuple[int, int]):
    """Links (a, b) from (root, low, high, sid, tokens, block, known), sorted by the first three."""

    def done(rows: list[tuple[bytes, bytes, int, bytes]]) -> pa.RecordBatch | None:
        unique = {r[0]: r for r in rows}
        sids = sorted(unique)
        if len(sids) < 2:
            return None
        sets = [np.frombuffer(unique[s][1], np.uint64) for s in sids]
        side = np.array([unique[s][2] for s in sids])
        known = np.unique([unique[s][3] for s in sids], return_inverse=True)[1]
        label = forest(sets, side if len(set(side)) > 1 else None, link, known)
        linked = [(sids[i], sids[k]) for i, k in enumerate(label) if i != k]
        if not linked:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*linked, strict=True)], names=["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in sliced(batches, 4, 8_000_000):
            for *k, sid, tokens, block, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if rows and (out := done(rows)):
                        yield out
                    key, rows = k, []
                rows.append((sid, tokens, block, known))
        if rows and (out := done(rows)):
            yield out

    return task


def _dealt(df: DataFrame, keys: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *more)


def pivot_links(have: DataFrame, link: tuple[int, int], portion: int) -> DataFrame:
    """Verified links (a, b) of every set with its pivot."""
    sizes = have.where("pivot IS NOT NULL").groupBy("pivot").agg(F.ceil(F.count("*") / portion).alias("parts"))
    own = have.select(F.col("sid").alias("pivot"), "sid", "tokens").join(sizes, "pivot")
    own = own.select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"), "sid", "tokens")
    rest = have.select("pivot", "sid", "tokens").join(sizes, "pivot")
    rest = rest.select("pivot", F.pmod(F.xxhash64("sid"), "parts").alias("part"), F.lit(1).alias("member"), "sid", "tokens")
    return _dealt(own.unionByName(rest), ["pivot", "part"], ("member",)).mapInArrow(_pivot_task(link), "a binary, b binary")


def block_links(have: DataFrame, link: tuple[int, int], block_tokens: int, work: Workspace, rows: int) -> DataFrame:
    """Verified links (a, b) between different classes ("known") of the clusters ("root")."""
    # a large cluster is cut by size: linked sets are in the same band or in neighbouring ones
    have = have.withColumn("band", F.floor(F.log("n") / F.log(F.lit(link[1] / link[0]))).cast("long"))
    # each step is a table by itself: sums are taken by partial aggregation, and no hot cluster is gathered for the next one
    large = work.put(have.groupBy("root").agg(F.sum("n").alias("n")).where(F.col("n") > block_tokens).select("root"), "large", rows)
    per_band = work.put(have.join(large, "root", "left_semi").groupBy("root", "known", "band").agg(F.sum("n").alias("n")), "bands", rows)
    per_class = work.put(per_band.groupBy("root", "known").agg(F.sum("n").alias("n")), "per_class", rows)
    largest = work.put(per_class.groupBy("root").agg(F.max(F.struct("n", "known")).alias("m")).select("root", F.col("m.known").alias("main")), "largest", rows)
    # blocks are numbered by kind (1: of the largest class), band and a part by hash
    group = (F.col("known") == F.col("main")).cast("long") * 4096 + F.col("band")
    grouped = work.put(per_band.join(largest, "root").select("root", "main", group.alias("g"), "n"), "grouped", rows)
    per_group = grouped.groupBy("root", "main", "g").agg(F.ceil(F.sum("n") / block_tokens).alias("parts"))
    cut = per_group.groupBy("root", "main").agg(F.map_from_entries(F.collect_list(F.struct("g", "parts"))).alias("parts"))
    cut = work.put(cut, "cut", rows)
    have = have.join(cut, "root", "left").withColumn("g", group)
    number = lambda g, p: g * F.lit(1 << 32) + p
    block = number(F.col("g"), F.pmod(F.xxhash64("sid"), F.element_at("parts", F.col("g"))))
    # what a block meets: the blocks of neighbouring bands, but those of the largest class don't meet each other
    others = F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)
    mains = F.when(F.col("g") < 4096, F.transform(others, lambda b: b + 4096)).otherwise(F.array().cast("array<bigint>"))
    met = F.filter(F.concat(others, mains), lambda g: F.map_contains_key("parts", g))
    near = F.flatten(F.transform(met, lambda g: F.transform(F.sequence(F.lit(0).cast("long"), F.element_at("parts", g) - 1), lambda p: number(g, p))))
    whole = F.col("parts").isNull()
    have = have.withColumn("block", F.when(whole, F.lit(0).cast("long")).otherwise(block))
    have = have.withColumn("other", F.explode(F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(near)))
    met_rows = have.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "sid", "tokens", "block", "known")
    return _dealt(met_rows, ["root", "low", "high"]).mapInArrow(_block_task(link), "a binary, b binary")


def _classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    link: tuple[int, int] = LINK,
    frequent: int = 3,
    bloom_bytes: int = 32 << 20,
    block_tokens: int = 500_000,
    portion: int = 100,
) -> DataFrame:
    """One row per input row: doc_id, tag (hash of id and text), n_shingles, component_id, stays."""
    work = Workspace(docs.sparkSession)
    texts = texts_of(docs, doc_id, text).select("tag", "text").where("text IS NOT NULL")
    bloom_of = lambda tags: work.send(bloom.build(tags, bloom_bytes, mix))

    sets = work.put(measured(docs, doc_id, text, words, link), "sets")
    base = sets.drop("front")
    known = work.send(corpus_tokens(sets, frequent, bloom_bytes, work))
    early = sets.where("sid IS NOT NULL").select("tag", "n_shingles", "sid", "front").mapInArrow(_early_task(link, known), "sig long, sid binary, tag long")
    early = work.put(early, "early")
    late = early.where("sig IS NULL").groupBy("sid").agg(F.min("tag").alias("tag")).select("tag")  # one document of each set
    late = work.put(texts.mapInArrow(_late_task(words, link, known, bloom_of(late)), "sig long, sid binary"), "late")
    index = early.where("sig IS NOT NULL").select("sig", "sid").unionByName(late)
    edges = candidate_edges(index, bloom_bytes, work)
    count = edges.count()
    clusters = connected_components(edges, work=work, rows=count)

    # one document of each clustered set supplies its tokens
    pivots = edges.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("pivot"))
    members = base.where("sid IS NOT NULL").groupBy("sid").agg(F.min("tag").alias("tag"), F.max("n_shingles").alias("n"))
    members = clusters.select(F.col("node").alias("sid"), "root").join(members, "sid").join(pivots, "sid", "left")
    members = work.put(members, "members", 2 * count)  # a node is the end of an edge
    count = members.count()
    tokens = texts.mapInArrow(_picked_task(words, bloom_of(members.select("tag"))), "sid binary, tokens binary")
    tokens = work.put(tokens, "tokens").groupBy("sid").agg(F.first("tokens").alias("tokens"))
    have = work.put(members.drop("tag").join(tokens, "sid"), "have", 20 * count)  # these rows are large

    links = work.put(pivot_links(have, link, portion), "links")
    classes = connected_components(links, work=work, rows=count).select(F.col("node").alias("sid"), F.col("root").alias("class"))
    placed = members.select("sid", "root").join(classes, "sid", "left").select("sid", "root", F.coalesce("class", "sid").alias("known"))
    split = placed.groupBy("root").agg(F.min("known").alias("low"), F.max("known").alias("high")).where("low <> high").select("root")
    rest = work.put(placed.join(split, "root").select("sid", "known"), "open", count)
    more = work.put(block_links(have.select("sid", "root", "n", "tokens").join(rest, "sid"), link, block_tokens, work, count), "more")
    if not more.isEmpty():
        classes = connected_components(links.unionByName(more), work=work, rows=count + more.count()).select(F.col("node").alias("sid"), F.col("root").alias("class"))

    labelled = base.where("sid IS NOT NULL").join(classes, "sid", "left").withColumn("class", F.coalesce("class", "sid"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag"))  # the smallest id; null if there is none
    ids = labelled.groupBy("class").agg(first.alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tag") == F.col("first.tag"))
    linked = labelled.join(ids, "class").select("doc_id", "tag", "n_shingles", F.col("first.doc_id").alias("component_id"), own.alias("stays"))
    alone = base.where("sid IS NULL").select("doc_id", "tag", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    result = work.put(linked.unionByName(alone), "result", base.count())
    work.clear("result")
    return result


def similarity_classes(docs: DataFrame, **how) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two sets link when link[1] * intersection >= link[0] * union; see ``_classes`` for the parameters.
    """
    return _classes(docs, **how).select("doc_id", "n_shingles", "component_id")


def keep_first_of_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = 500_000, **how) -> DataFrame:
    """The rows of ``docs`` without all but one document of each class, with all their columns.

    Rows with equal id and text share their fate.  The list of dropped rows (24 bytes each) is broadcast up to
    ``broadcast_rows``; beyond, an ordinary anti-join gives the same rows.
    """
    classes = _classes(docs, doc_id, text, **how)
    gone = classes.where(~F.col("stays")).select("doc_id", "tag").distinct()
    on = [gone["doc_id"].eqNullSafe(docs[doc_id]), gone["tag"] == F.xxhash64(docs[doc_id], docs[text].cast("string"))]
    few = gone.count() <= broadcast_rows
    return docs.join(F.broadcast(gone) if few else gone, on, "left_anti")
