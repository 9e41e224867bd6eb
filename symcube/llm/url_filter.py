"""URL filter: a blocked Bloom filter of listed keys, then an exact hash join.

Two lists are looked up by the same way.  A rule (host, path, verdict) is listed under ``host#path`` (neither
part can hold a ``#``) and fits its host, all subdomains and every path that starts with its own; a listed canonical URL is
listed under itself and fits pages with that canonical URL.  A page therefore has a bounded set of
lookup keys: each suffix of its host at a dot, with each prefix of its path whose length occurs among
the rules, plus its canonical URL.  The Bloom filter (blocks of 256 bits, eight probes in one block) is
broadcast; its size is at most ``bloom_bytes`` whatever the lists' size, so it may become less
selective but never larger.  Possible hits go to an exact hash join with the lists, which removes the false
positives: their keys are counted by partial aggregation and joined with the lists, one row per key.  Listed keys that
hold at least a 1/``hot`` share of all hits (so at most ``hot`` keys) are broadcast to their pages, which are not
shuffled; the others' hits are joined by a shuffled hash join.

The longest fitting rule decides; without one, a listed canonical URL is blocked and others allowed.

Defined results
---------------
* the host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from
  there to ``?``, ``#`` or the end; null urls and urls without ``://`` have both empty, fit nothing and
  are allowed;
* the canonical URL is the host without a leading ``www.`` and the path without trailing slashes;
* listed rules with equal host and path: the verdict that sorts last ('block') counts; rules with a null
  host, path or verdict are ignored;
* ids are integers, decimals, strings or dates (others: TypeError before any job);
* every input row gives a row, null ids and repeated rows included; empty lists allow everything, an empty
  table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symcube.llm import bloom
from symcube.llm.common import bound_batches, id_type, materialize

def host_path(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a url column, as the module's docstring defines them."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.regexp_extract(u, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def canonical(host: Column, path: Column) -> Column:
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def build_bloom(keys: DataFrame, bloom_bytes: int = 32 << 20) -> np.ndarray:
    """The filter of the column ``key``."""
    return bloom.build(keys.select(F.xxhash64("key")), bloom_bytes)


def may_hold(bits: np.ndarray, keys: list[str]) -> np.ndarray:
    return bloom.may_hold(bits, np.array([xxhash.xxh64_intdigest(k.encode(), 42) for k in keys], np.uint64))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", bloom_bytes: int = 32 << 20, hot: int = 1024) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed.

    ``rules`` has host, path and verdict; ``listed`` has the column url, in any spelling.
    """
    bound_batches(pages.sparkSession)
    rule = F.concat("host", "path")
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").groupBy("host", "path")
    known = known.agg(F.max("verdict").alias("verdict")).select(F.concat(F.lit("R "), "host", F.lit("#"), "path").alias("key"), rule.alias("rule"), "verdict", F.char_length("path").alias("n"))
    h, p = host_path("url")
    exact = listed.select(canonical(h, p).alias("u")).where("u != ''").distinct().select(F.concat(F.lit("U "), F.col("u")).alias("key"))
    table = materialize(known.unionByName(exact, allowMissingColumns=True), "listed")
    lengths = [r.n for r in table.where("n IS NOT NULL").select("n").distinct().orderBy("n").collect()]  # path lengths: few and bounded
    sent = pages.sparkSession.sparkContext.broadcast(build_bloom(table.select("key"), bloom_bytes))
    h, p = host_path(url)
    rows = pages.select(F.col(page_id).alias("page_id"), F.monotonically_increasing_id().alias("row"), h.alias("host"), p.alias("path"))
    rows = rows.withColumn("own", canonical(F.col("host"), F.col("path")))
    kind, arrow = id_type(rows, "page_id")

    def task(batches):
        for batch in batches:
            keys, ends = [], []
            for host, path, own in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                at = 0 if host else -1
                while at >= 0:
                    keys += [f"R {host[at:]}#{path[:n]}" for n in lengths if n <= len(path)]
                    at = host.find(".", at) + 1 or -1
                if own:
                    keys.append(f"U {own}")
                ends.append(len(keys))
            hit = np.flatnonzero(may_hold(sent.value, keys)) if keys else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.searchsorted(hit, ends)]).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(offsets), pa.array([keys[i] for i in hit], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow), *batch.columns[1:4], hits], names=["page_id", "row", "host", "path", "hits"])

    probed = materialize(rows.mapInArrow(task, f"page_id {kind}, row long, host string, path string, hits array<string>"), "probed")
    hits = probed.where(F.size("hits") > 0).select("row", F.explode("hits").alias("key"))
    counts = hits.groupBy("key").agg(F.count("*").alias("hits"))
    verified = materialize(table.join(counts.hint("shuffle_hash"), "key").select("key", "rule", "verdict", "hits"), "verified")
    total = verified.agg(F.sum("hits").alias("n")).first()["n"] or 0
    frequent = verified.where(F.col("hits") * hot >= total)  # at most `hot` rows
    fits = hits.join(F.broadcast(frequent), "key")
    others = hits.join(F.broadcast(frequent.select("key")), "key", "left_anti")
    fits = fits.unionByName(others.join(verified.where(F.col("hits") * hot < total).hint("shuffle_hash"), "key"))
    best = fits.groupBy("row").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.char_length("rule").alias("n"), "rule", "verdict"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"),
    )
    found = probed.where(F.size("hits") > 0).join(best, "row", "left").select("page_id", "host", "path", "best", "listed")
    none = probed.where(F.size("hits") == 0).select("page_id", "host", "path")
    return found.unionByName(none, allowMissingColumns=True).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )
