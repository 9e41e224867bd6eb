"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Per document three base patterns are matched (leftmost, non-overlapping, each kind by itself), and one
generic pattern for long mixed tokens.  Match positions come from one trick: extracting all matches of
``(gap)(?:pattern|end)`` yields the gap before each match, so running sums of lengths are offsets in
code points, and the scan stays linear because the last match always succeeds at the end of the text.
Only texts that pass a cheap test for a kind's fixed parts run that kind's pattern.

Every candidate's SHA-256 is then aggregated over the corpus: the number of distinct repositories and
owners that hold it.  A candidate held by ``example_owners`` or more owners, or in ``example_repos`` or more
repositories, is a widely copied example, otherwise a live-looking credential.  Base spans always stay; a generic
token becomes an added span of kind ``owned`` only if it overlaps no base span, one single owner holds it, and
it is live-looking.  Owner and repository are columns or expressions; a table that names only the owner may
derive its repositories from it and another column.

Defined results
---------------
* null text counts as empty; a document without spans has zero counts, the SHA-256 of the empty
  string and an empty ``spans``;
* ids may be of any type; every input row gives one row, repeated rows and null ids included (rows are told apart by an
  internal row number, not by id);
* a null repository counts as one repository of its own, and so does a null owner;
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from symcube.llm.common import materialize, text_or_empty

# The base patterns (kind, pattern, group that is the secret, least code points of it).
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
#: Added by the method: a maximal run of token characters with a digit, tested for its mix afterwards.
OWNED = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])([A-Za-z0-9+/_-]{20,})"

#: kind, pattern, least length of the secret, cheap necessary test
KINDS = [
    ("assign", ASSIGN, 6, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
    ("access", ACCESS, 20, r"AKIA[A-Z0-9]{16}"),
    ("hex", HEX, 24, r"[0-9a-f]{24}"),
    ("owned", OWNED, 20, OWNED.replace("{20,}", "{20}")),
]
BASE = 3


def _matches(text: Column, rank: int) -> Column:
    """array<struct<kind, i, gap, size, secret>> of all matches of one kind, failing ones included."""
    _, pattern, least, test = KINDS[rank]
    # a hex run shorter than the least length can be neither kept nor part of a longer run
    pattern = pattern.replace("+)", "{%d,})" % least) if KINDS[rank][0] == "hex" else pattern
    full = f"(?s)(.*?)(?:{pattern}|\\z)"
    part = lambda g: F.regexp_extract_all(text, F.lit(full), F.lit(g))
    rows = F.transform(
        F.arrays_zip(part(1).alias("gap"), part(0).alias("all"), part(2).alias("secret")),
        lambda x, i: F.struct(
            F.lit(rank).alias("kind"),
            i.alias("i"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["all"]).alias("size"),
            x["secret"].alias("secret"),
        ),
    )
    rows = F.filter(rows, lambda x: x["size"] > x["gap"])  # the match at the end is empty
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,secret:string>>")
    return F.when(text.rlike(test), rows).otherwise(empty)


def candidates(docs: DataFrame, doc_id: str, text: str, repo: str | Column, owner: str | Column) -> DataFrame:
    """One row per document with its raw matches; the only pass over the texts."""
    body = text_or_empty(text)
    named = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        named(repo).alias("repo"),
        named(owner).alias("owner"),
        F.concat(*[_matches(body, k) for k in range(len(KINDS))]).alias("found"),
    )


def _spans(scanned: DataFrame) -> DataFrame:
    """One row per kept candidate: row, kind, start, end, hash."""
    each = scanned.where(F.size("found") > 0).select("row", "repo", "owner", F.explode("found").alias("m"))
    each = each.select("row", "repo", "owner", "m.*")
    before = W.partitionBy("row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    each = each.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
    least = F.element_at(F.array(*[F.lit(k[2]) for k in KINDS]), F.col("kind") + 1)
    # the secret's casing matters, the keyword's doesn't; generic tokens must mix digits and both cases
    mixed = F.col("secret").rlike("[0-9]") & F.col("secret").rlike("[a-z]") & F.col("secret").rlike("[A-Z]")
    return each.where((F.char_length("secret") >= least) & ((F.col("kind") < BASE) | mixed)).select(
        "row",
        "repo",
        "owner",
        "kind",
        (F.col("base") + F.col("gap")).alias("start"),
        (F.col("base") + F.col("size")).alias("end"),
        F.unhex(F.sha2(F.col("secret").cast("binary"), 256)).alias("hash"),
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Distinct repositories and owners per candidate hash.

    Two levels of grouping, so a credential that a third of all rows hold is reduced to its distinct
    (repository, owner) pairs before anything meets in one task.
    """
    pairs = spans.groupBy("hash", "repo", "owner").agg(F.count("*").alias("n"))
    return pairs.groupBy("hash").agg(
        F.sum("n").alias("n_spans"), F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners")
    )


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repo: str | Column = "source",
    owner: str | Column = "source",
    example_owners: int = 3,
    example_repos: int = 4,
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live, n_example, findings.

    ``findings`` lists every span with its kind, offsets, secret hash, repositories, owners and verdict.
    """
    scanned = materialize(candidates(docs, doc_id, text, repo, owner), "scanned")
    spans = materialize(_spans(scanned), "spans")
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    known = spans.drop("repo", "owner").join(ownership(spans), "hash")
    item = F.struct(
        "start",
        F.col("kind").alias("rank"),
        kind.alias("kind"),
        "end",
        F.lower(F.hex("hash")).alias("secret_sha256"),
        "n_repos",
        "n_owners",
        F.when((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos), "example").otherwise("live").alias("verdict"),
    )
    per_doc = known.groupBy("row").agg(F.sort_array(F.collect_list(item)).alias("all"))
    base = F.filter("all", lambda x: x["rank"] < BASE)
    per_doc = per_doc.withColumn("base", base)
    clash = lambda x: F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    per_doc = per_doc.withColumn("findings", F.filter("all", lambda x: (x["rank"] < BASE) | ((x["n_owners"] == 1) & (x["verdict"] == "live") & ~clash(x))))
    listed = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda c, test: F.size(F.filter(c, test)).cast("long")
    of_rank = lambda r: lambda x: x["rank"] == r
    per_doc = per_doc.select(
        "row",
        *[count("base", of_rank(r)).alias(f"n_{KINDS[r][0]}") for r in range(BASE)],
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        listed("findings").alias("spans"),
        count("findings", of_rank(BASE)).alias("n_owned"),
        count("findings", lambda x: x["verdict"] == "live").alias("n_live"),
        count("findings", lambda x: x["verdict"] == "example").alias("n_example"),
        "findings",
    )
    shape = per_doc.schema["findings"].dataType
    with_match = scanned.where(F.size("found") > 0).select("doc_id", "row").join(per_doc, "row", "left").drop("row")
    without = scanned.where(F.size("found") == 0).select("doc_id")
    whole = with_match.unionByName(without, allowMissingColumns=True)
    zero = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    more = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_owned", "n_live", "n_example")]
    return whole.select(
        "doc_id",
        *zero,
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        *more,
        F.coalesce("findings", F.array().cast(shape)).alias("findings"),
    )
