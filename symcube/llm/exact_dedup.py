"""Exact dedup with a heavy-hitter split.

Texts are equal when they are identical after white space is deleted.  Every row is reduced to a
slim record (row number, id, length, SHA-256 of the normalised text), written once.  A Misra-Gries
style frequent-items sketch (Spark's ``approx_top_k``) over the digests names every digest that holds
more than a fixed share of the rows; their exact counts and winners are computed with map-side
partial aggregation, and the at most ``heavy`` winners are broadcast, so rows of large groups are
decided without a shuffle.  All other rows are shuffled in slim form: winners again by partial aggregation, and a
join with the digests that occur repeatedly, whose large partitions adaptive execution can split.  No group is
ever gathered in one task, however frequent a digest is that the sketch did not name.

Defined results
---------------
* null text counts as empty; all empty (or white-space-only) texts are one group;
* of equal texts the row with the most code points stays, then the smallest id (null ids last),
  then the first stored row; repeated rows are members like any other, exactly one stays;
* an empty table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm.common import WHITE, materialize, text_or_empty

#: Bound on the broadcast winners, and counters of the sketch.
HEAVY, TRACKED = 1024, 8192


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.char_length(body).cast("long").alias("chars"),
        F.unhex(F.sha2(F.translate(body, WHITE, "").cast("binary"), 256)).alias("digest"),
    )


def _winners(slim: DataFrame) -> DataFrame:
    """digest, win_row, keep_id, size of every digest."""
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), "doc_id", "row"))
    groups = slim.groupBy("digest").agg(best.alias("best"), F.count("*").alias("size"))
    return groups.select("digest", F.col("best.row").alias("win_row"), F.col("best.doc_id").alias("keep_id"), "size")


def heavy_digests(slim: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Winner and exact size of each frequent digest; never more than ``heavy`` rows.

    The sketch keeps ``tracked`` counters, so it cannot miss a digest with more than
    rows / (0.75 * tracked) occurrences.
    """
    spark = slim.sparkSession
    found = slim.select(F.expr(f"approx_top_k(xxhash64(digest), {heavy}, {tracked})").alias("top")).first()["top"]
    hashes = [x["item"] for x in found or [] if x["count"] >= 8]
    if not hashes:
        return spark.createDataFrame([], f"digest binary, win_row long, keep_id {slim.schema['doc_id'].dataType.simpleString()}, size long")
    # the sketch's hashes are verified here: exact digests, exact counts
    picked = slim.where(F.xxhash64("digest").isin(hashes))
    return _winners(picked).orderBy(F.desc("size"), "digest").limit(heavy)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = materialize(_slim(docs, doc_id, text), "digests")
    winners = materialize(heavy_digests(slim, heavy, tracked), "winners")  # at most `heavy` rows
    large = slim.join(F.broadcast(winners), "digest").select("doc_id", "row", "digest", "win_row", "keep_id", "size")
    rest = slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    repeated = _winners(rest).where("size > 1").withColumnsRenamed({"digest": "_digest", "keep_id": "_keep_id"})
    single = F.col("size").isNull()
    small = rest.join(repeated, rest["digest"] == repeated["_digest"], "left").select(
        "doc_id",
        "row",
        "digest",
        F.coalesce("win_row", "row").alias("win_row"),
        F.when(single, F.col("doc_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("size"),
    )
    return large.unionByName(small).select(
        "doc_id",
        "keep_id",
        F.col("size").cast("long").alias("group_size"),
        (F.col("row") == F.col("win_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Dropped rows are matched by (id, digest).  Their list is broadcast up to ``broadcast_rows`` rows; beyond, an
    ordinary join gives the same rows.  Where the winner's own id and text occur in several rows, those are
    reduced to the longest text, then the smallest text, by partial aggregation.
    """
    names = [f"`{c}`" for c in docs.columns]
    verdict = exact_dedup(docs, doc_id, text)
    per = verdict.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("NOT kept OR n > 1")
    per = materialize(per, "dropped").select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"), F.col("kept").alias("again"))
    few = per.count() <= broadcast_rows
    # the input's columns travel as one struct, so their names cannot clash
    tagged = docs.select(
        F.struct(*names).alias("whole"), F.col(doc_id).alias("id"), text_or_empty(text).alias("body"), F.sha2(F.translate(text_or_empty(text), WHITE, "").cast("binary"), 256).alias("sha")
    )
    on = lambda gone: [gone["gone_id"].eqNullSafe(tagged["id"]), gone["gone_sha"] == tagged["sha"]]
    once = tagged.join(F.broadcast(per) if few else per, on(per), "left_anti").select("whole.*")
    repeated = per.where("again")
    if repeated.isEmpty():
        return once
    again = tagged.join(F.broadcast(repeated) if few else repeated, on(repeated), "left_semi")
    longest = F.min_by("whole", F.struct((-F.char_length("body")).alias("n"), "body"))
    return once.unionByName(again.groupBy("id", "sha").agg(longest.alias("whole")).select("whole.*"))
