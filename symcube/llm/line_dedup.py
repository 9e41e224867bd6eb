"""Line dedup by pairwise alignment of overlapping documents.

1. Pairs.  A document is linked with earlier ones through the hashes of its lines.  A *rare* line (found in at
   most ``rare_df`` documents) and the runs of lines around it point to the first document that holds them, and
   so does every run of ``passage_words`` words, whatever its lines' frequency.  These runs are called windows:
   all runs of ``min_words`` up to ``passage_words`` words, and the shortest runs of ``passage_words`` words
   that start or end at a line.  A window is in an earlier document just if its first holder is one, so one
   link per window loses no overlap with any earlier document, though a line that millions of documents
   share costs one link each; nothing is capped, and no group is expanded to its pairs.
2. Alignment.  Both documents of a pair meet with their full lists of lines and are aligned by patience diff: lines
   unique in both are anchors, their longest increasing sequence is kept, and the ranges between anchors are
   aligned in the same way, by their longest common run where no line is unique.  A hot partner's pairs are
   dealt into portions, each with a copy of the partner's lines.  A diff drops one of two blocks that cross,
   and pairs a repeated passage once; windows of the later document that the alignment left out are therefore
   looked up among the partner's windows.
3. Cut.  A common block is deleted from the later document if it has ``passage_words`` words, or ``min_words``
   words and a rare line, so that short boilerplate lines alone change no document.

Lines are told apart by 128-bit hashes.

Defined results
---------------
* lines end at ``\\n`` and are compared without leading and trailing white space; lines without a word
  match nothing and break no block, and those between two deleted lines are deleted with them; a block that a
  document repeats is deleted at every place if an earlier document has it;
* documents come in the order of their ids (null ids last), equal ids in the order of a hash of their
  text; rows with equal id and text are one document and get the same result each (in a line's frequency each row
  counts);
* ids are integers, decimals, strings or dates (others: TypeError before any job);
* null texts have no lines and stay null; a document without common blocks keeps its text as it is;
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm import bloom
from symcube.llm.common import Workspace, id_type, sliced
from symcube.llm.decontaminate import mix

RARE_DF, MIN_WORDS, PASSAGE_WORDS = 64, 10, 20
_SIZE = 16


def lines_of(text: str) -> tuple[list[bytes], list[int], list[int]]:
    """(digests, words, line numbers) of the lines with a word."""
    rows = [(xxhash.xxh3_128_digest(x.strip().encode()), n, i) for i, x in enumerate(text.split("\n")) if (n := len(x.split()))]
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def window_ranges(words: list[int], min_words: int, passage_words: int) -> dict[tuple[int, int], int]:
    """(first, last) -> words of each window."""
    found: dict[tuple[int, int], int] = {}
    for step in (1, -1):
        for start in range(len(words)):
            total, at = 0, start
            while 0 <= at < len(words) and total < passage_words:
                total += words[at]
                if total >= passage_words or step > 0 and total >= min_words:
                    found[min(start, at), max(start, at)] = total
                at += step
    return found


def window_hash(digests: list[bytes], first: int, last: int) -> bytes:
    return digests[first] if first == last else xxhash.xxh3_128_digest(b"".join(digests[first : last + 1]))


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
        back[i] = at[pile - 1] if pile else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def longest_run(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """(place in a, place in b, length) of a longest common run: a search over its length with rolling hashes."""
    x, y = (mix(np.array(v, np.int64).view(np.uint64) + np.uint64(1)) for v in (a, b))
    size = max(len(x), len(y))
    weights = np.cumprod(np.full(size, 0x100000001B3, np.uint64))
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * weights[: len(v)])]) for v in (x, y)]

    def common(n: int) -> tuple[int, int] | None:
        # a run that begins at i is weighted once more, so that equal runs have equal sums wherever they stand
        here, there = ((s[n:] - s[:-n]) * weights[size - 1 - np.arange(len(s) - n)] for s in sums)
        at = np.flatnonzero(np.isin(here, there))
        return (int(at[0]), int(np.flatnonzero(there == here[at[0]])[0])) if len(at) else None

    low, high, (i, j) = 0, min(len(a), len(b)), (0, 0)
    while low < high:
        middle = (low + high + 1) // 2
        if found := common(middle):
            low, (i, j) = middle, found
        else:
            high = middle - 1
    n = 0
    while n < low and a[i + n] == b[j + n]:
        n += 1
    return i, j, n


def align(a: list[int], b: list[int], searches: int = 64) -> list[tuple[int, int]]:
    """Places of equal lines that patience diff pairs, in ascending order.

    Ranges without a unique line cost a search for a run each; after so many ``searches`` they stay unaligned, and
    their blocks are left to the lookup of windows, which finds every block.
    """
    out: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        a0, a1, b0, b1 = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        here, there = Counter(a[a0:a1]), Counter(b[b0:b1])
        if here.keys().isdisjoint(there):
            continue
        place = {v: j for j, v in enumerate(b[b0:b1], b0) if there[v] == 1}
        once = [(i, place[v]) for i, v in enumerate(a[a0:a1], a0) if here[v] == 1 and v in place]
        if once:
            pairs = [once[k] for k in increasing([j for _, j in once])]
        elif searches <= 0:
            continue
        else:
            searches -= 1
            i, j, n = longest_run(a[a0:a1], b[b0:b1])
            pairs = [(a0 + i + k, b0 + j + k) for k in range(n)]
        out += pairs
        if pairs:
            ends = [(a0 - 1, b0 - 1), *pairs, (a1, b1)]
            ranges += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(ends, ends[1:], strict=False) if p + 1 < q and r + 1 < s]
    return sorted(out)


def runs(pairs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(first, last) of the runs of pairs that are consecutive on both sides."""
    begin = 0
    for k in range(1, len(pairs) + 1):
        if k == len(pairs) or pairs[k] != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
            yield pairs[begin][0], pairs[k - 1][0]
            begin = k


class Partner:
    """The earlier document of a pair; its tables are built once for all later ones."""

    def __init__(self, digests: list[bytes], words: list[int], min_words: int, passage_words: int):
        self.min_words, self.passage_words = min_words, passage_words
        self.number = {d: n for n, d in enumerate(dict.fromkeys(digests))}
        self.lines = [self.number[d] for d in digests]
        self.windows = {window_hash(digests, a, b) for a, b in window_ranges(words, min_words, passage_words)}

    def common_blocks(self, digests: list[bytes], words: list[int], rare: set[bytes]) -> list[tuple[int, int]]:
        """(first, last) of the blocks of a later document to delete, as places among its lines with a word."""
        here = [self.number.get(d, -1 - k) for k, d in enumerate(digests)]
        before = np.concatenate([[0], np.cumsum(words)])
        near = np.concatenate([[0], np.cumsum([d in rare for d in digests])])

        def goes(a: int, b: int) -> bool:
            n = before[b + 1] - before[a]
            return n >= self.passage_words or n >= self.min_words and near[b + 1] > near[a]

        found = [r for r in runs(align(here, self.lines)) if goes(*r)]
        covered = np.zeros(len(words) + 1, np.int64)
        for a, b in found:
            covered[a : b + 1] = 1
        covered = np.concatenate([[0], np.cumsum(covered)])
        for a, b in window_ranges(words, self.min_words, self.passage_words):
            if covered[b + 1] - covered[a] <= b - a and goes(a, b) and window_hash(digests, a, b) in self.windows:
                found.append((a, b))
        return found


def _merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Line ranges (first, last, next line with a word) that overlap or touch as one (first, last)."""
    out: list[tuple[int, int, int]] = []
    for a, b, after in sorted(found):
        if out and a <= out[-1][2]:
            out[-1] = (out[-1][0], *max(out[-1][1:], (b, after)))
        else:
            out.append((a, b, after))
    return [(a, b) for a, b, _ in out]


def _split(data: bytes) -> list[bytes]:
    return [data[i : i + _SIZE] for i in range(0, len(data), _SIZE)]


def _ints(data: bytes) -> list[int]:
    return np.frombuffer(data, np.int32).tolist()


def _task_lines(types):
    def task(batches):
        for batch in sliced(batches, 2):
            rows = []
            for key, tag, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                digests, words, at = lines_of(body)
                if digests:
                    rows.append((key, tag, b"".join(digests), np.array(words, np.int32).tobytes(), np.array(at, np.int32).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], schema=pa.schema(types))

    return task


def _task_windows(types, min_words: int, passage_words: int):
    """(hash, doc_id, tag, words, line): each window, and each line below ``passage_words``, once per document."""

    def task(batches):
        for batch in sliced(batches, 2, 500_000):
            cols: list[list] = [[] for _ in types]
            for key, tag, data, numbers in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                digests, words = _split(data), _ints(numbers)
                # every document that holds a short line counts for its frequency
                found = {d: (n, True) for d, n in zip(digests, words, strict=True) if n < passage_words}
                for (a, b), n in window_ranges(words, min_words, passage_words).items():
                    found.setdefault(window_hash(digests, a, b), (n, False))
                cols[0] += found
                cols[1] += [key] * len(found)
                cols[2] += [tag] * len(found)
                cols[3] += [n for n, _ in found.values()]
                cols[4] += [line for _, line in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, types, strict=True)], schema=pa.schema(types))

    return task


def _task_held(sent):
    def task(batches):
        for batch in batches:
            yield batch.filter(pa.array(bloom.may_hold(sent.value, bloom.values(batch.column(0)))))

    return task


def _task_align(types, min_words: int, passage_words: int):
    """Blocks to delete, from rows of which a partner's own comes before those of its later documents."""

    def task(batches):
        key, partner = None, None
        for batch in sliced(batches, 6, 4_000_000):
            rows = []
            for p, p_tag, _, member, doc, tag, data, numbers, places, rare in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not member:
                    if key != (p, p_tag):
                        key, partner = (p, p_tag), Partner(_split(data), _ints(numbers), min_words, passage_words)
                elif key == (p, p_tag):
                    at = _ints(places)
                    found = partner.common_blocks(_split(data), _ints(numbers), set(rare or ()))
                    if found:
                        cut = [{"first": at[a], "last": at[b], "after": at[b + 1] if b + 1 < len(at) else at[b] + 1} for a, b in sorted(set(found))]
                        rows.append((doc, tag, cut, p))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], schema=pa.schema(types))

    return task


def _task_merge(types):
    def task(batches):
        for batch in batches:
            rows = []
            for doc, tag, cuts, origin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                merged = _merged([(c["first"], c["last"], c["after"]) for cut in cuts for c in cut])
                rows.append((doc, tag, [{"first": a, "last": b} for a, b in merged], sorted(origin, key=lambda x: (x is None, x))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], schema=pa.schema(types))

    return task


def common_blocks(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rare_df: int = RARE_DF,
    min_words: int = MIN_WORDS,
    passage_words: int = PASSAGE_WORDS,
    bloom_bytes: int = 32 << 20,
    portion: int = 200,
    work: Workspace | None = None,
) -> DataFrame:
    """Blocks to delete: doc_id, tag (hash of id and text), cut: array of (first, last) line numbers, from_ids."""
    spark, work = docs.sparkSession, work or Workspace(docs.sparkSession)
    kind, arrow = id_type(docs, doc_id)
    slim = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text).cast("string")).alias("tag"), F.col(text).cast("string").alias("text"))
    who = [("doc_id", arrow), ("tag", pa.int64())]
    lists = slim.mapInArrow(_task_lines([*who, ("digests", pa.binary()), ("words", pa.binary()), ("places", pa.binary())]), f"doc_id {kind}, tag long, digests binary, words binary, places binary")
    lists = work.put(lists, "lines")
    types = [("hash", pa.binary()), *who, ("words", pa.int32()), ("line", pa.bool_())]
    shape = f"hash binary, doc_id {kind}, tag long, words int, line boolean"
    found = work.put(lists.select("doc_id", "tag", "digests", "words").mapInArrow(_task_windows(types, min_words, passage_words), shape), "windows")

    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "tag")
    # partial aggregation reduces a window of any frequency before the exchange
    holders = found.groupBy("hash").agg(F.min(order).alias("holder"), F.count("*").alias("df"), F.max(order).alias("last"))
    holders = work.put(holders.where("holder <> last").select("hash", "holder", "df"), "holders")
    # most windows have one holder; a bounded filter keeps those rows out of the join
    sent = work.send(bloom.build(holders.select("hash"), bloom_bytes))
    shared = found.mapInArrow(_task_held(sent), shape).join(holders, "hash")
    # a frequent run holds frequent lines only, and so needs the words of a passage
    shared = shared.where((F.col("words") >= passage_words) | (F.col("df") <= rare_df))
    shared = shared.where(~(F.col("tag").eqNullSafe(F.col("holder.tag")) & F.col("doc_id").eqNullSafe(F.col("holder.doc_id"))))
    partner = F.when(F.col("words") >= min(min_words, passage_words), F.struct("holder.doc_id", "holder.tag"))
    rare = F.when(F.col("line") & (F.col("df") <= rare_df), F.col("hash"))
    # a document's own windows: bounded by the document; sets, as repeated rows repeat them
    per_doc = shared.groupBy("doc_id", "tag").agg(F.collect_set(partner).alias("partners"), F.collect_set(rare).alias("rare"))
    per_doc = work.put(per_doc.where(F.size("partners") > 0), "linked")
    count = per_doc.agg(F.sum(F.size("partners")).alias("n")).first()["n"] or 0  # of pairs; no more documents than twice that
    pairs = per_doc.select("doc_id", "tag", "rare", F.explode("partners").alias("p")).select(F.col("p.doc_id").alias("p_id"), F.col("p.tag").alias("p_tag"), "doc_id", "tag", "rare")
    sizes = pairs.groupBy("p_id", "p_tag").agg(F.ceil(F.count("*") / portion).alias("parts"))

    ends = pairs.select("doc_id", "tag").unionByName(pairs.select(F.col("p_id").alias("doc_id"), F.col("p_tag").alias("tag"))).distinct()
    ends = ends.withColumnsRenamed({"doc_id": "e_id", "tag": "e_tag"})
    both = lambda x, y: x.eqNullSafe(y)
    have = lists.join(ends, [both(lists["doc_id"], ends["e_id"]), lists["tag"] == ends["e_tag"]], "left_semi")
    have = have.groupBy("doc_id", "tag").agg(F.first(F.struct("digests", "words", "places")).alias("l")).select("doc_id", "tag", "l.*")
    have = work.put(have, "have", 4 * count)
    no_set = F.lit(None).cast("array<binary>").alias("rare")
    named = sizes.withColumnsRenamed({"p_id": "s_id", "p_tag": "s_tag"})
    own = have.join(named, [both(have["doc_id"], named["s_id"]), have["tag"] == named["s_tag"]])
    own = own.select(F.col("s_id").alias("p_id"), F.col("s_tag").alias("p_tag"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"), "doc_id", "tag", "digests", "words", "places", no_set)
    dealt = pairs.join(named, [both(pairs["p_id"], named["s_id"]), pairs["p_tag"] == named["s_tag"]])
    dealt = dealt.select("p_id", "p_tag", F.pmod(F.xxhash64("tag"), "parts").alias("part"), F.col("doc_id").alias("d_id"), F.col("tag").alias("d_tag"), "rare")
    later = dealt.join(have, [both(F.col("d_id"), have["doc_id"]), F.col("d_tag") == have["tag"]])
    later = later.select("p_id", "p_tag", "part", F.lit(1).alias("member"), "doc_id", "tag", "digests", "words", "places", "rare")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = own.unionByName(later).repartition(n, "p_id", "p_tag", "part").sortWithinPartitions("p_id", "p_tag", "part", "member")
    range_ = lambda *names: pa.list_(pa.struct([(x, pa.int32()) for x in names]))
    blocks = met.mapInArrow(_task_align([*who, ("cut", range_("first", "last", "after")), ("from_id", arrow)], min_words, passage_words), f"doc_id {kind}, tag long, cut array<struct<first:int,last:int,after:int>>, from_id {kind}")
    blocks = work.put(blocks, "blocks")
    # null ids drop out of a set, so they are wrapped
    grouped = blocks.groupBy("doc_id", "tag").agg(F.collect_set("cut").alias("cuts"), F.collect_set(F.struct("from_id")).alias("f")).select("doc_id", "tag", "cuts", F.col("f.from_id").alias("from_ids"))
    return grouped.mapInArrow(_task_merge([*who, ("cut", range_("first", "last")), ("from_ids", pa.list_(arrow))]), f"doc_id {kind}, tag long, cut array<struct<first:int,last:int>>, from_ids array<{kind}>")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bloom_bytes: int = 32 << 20, **how) -> DataFrame:
    """One row per input row: doc_id, text without the deleted blocks, n_lines, n_deleted, cut, from_ids."""
    work = Workspace(docs.sparkSession)
    cuts = work.put(common_blocks(docs, doc_id, text, bloom_bytes=bloom_bytes, work=work, **how), "cuts")
    work.clear("cuts")
    sent = docs.sparkSession.sparkContext.broadcast(bloom.build(cuts.select("tag"), bloom_bytes, mix))

    def may_be_cut(tags: pa.Array) -> pa.Array:
        return pa.array(bloom.may_hold(sent.value, mix(tags.to_numpy().view(np.uint64))))

    cuts = cuts.withColumnsRenamed({"doc_id": "_id", "tag": "_tag"})
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text).cast("string")).alias("tag"), F.col(text).cast("string").alias("text"))
    hit = F.arrow_udf(may_be_cut, "boolean")(F.col("tag"))
    on = [F.col("tag") == F.col("_tag"), F.col("doc_id").eqNullSafe(F.col("_id"))]
    # a filter of bounded size lets documents without a cut pass by the join, which is a sort-merge join at every size
    whole = slim.where(hit).join(cuts.hint("merge"), on, "left").unionByName(slim.where(~hit), allowMissingColumns=True)
    whole = whole.withColumn("mine", F.col("cut").isNotNull())
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.exists("cut", lambda c: i.between(c["first"], c["last"])))
    deleted = F.aggregate("cut", F.lit(0), lambda n, c: n + c["last"] - c["first"] + 1)
    return whole.select(
        "doc_id",
        F.when(F.col("mine"), F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("mine"), deleted).otherwise(0).cast("long").alias("n_deleted"),
        F.when(F.col("mine"), F.col("cut")).alias("cut"),
        F.when(F.col("mine"), F.col("from_ids")).alias("from_ids"),
    )
