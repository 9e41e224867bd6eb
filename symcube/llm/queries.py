"""Queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symcube.llm import decontaminate, exact_dedup, langid, line_dedup, ngram_join, packing, quality, secrets, sstable, url_filter
from symcube.llm.common import read


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sstable_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = sstable.write_shards(read(spark, sf_dir, "documents"), tokenizer(), end_id=2)
    return sstable.read_shards(manifest)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(read(spark, sf_dir, "documents"), words=3, link=(90, 100))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An owner is a source of the documents, a repository its documents of one language."""
    docs = read(spark, sf_dir, "documents")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang")]
    return secrets.scan_secrets(docs, owner="source", repo=F.concat_ws("/", *parts)).drop("findings")


# The contract's rules (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no list of URLs: every url with a tracking parameter stands in for a listed one."""
    pages = read(spark, sf_dir, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(pages, rules, pages.where("url LIKE '%utm_source=%'").select("url"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer(), length=2048, end_id=1, keep_ids=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deleted lines are told as text: ``first-last`` line numbers, comma-joined."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    told = F.array_join(F.transform("cut", lambda c: F.concat_ws("-", c["first"].cast("string"), c["last"].cast("string"))), ",")
    return out.select("doc_id", "text", "n_lines", "n_deleted", told.alias("cut"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sstable_shards": op1_sstable_shards,
    "op2_ngram_join": op2_ngram_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_secret_scan": op5_secret_scan,
    "op6_url_filter": op6_url_filter,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
}

# What Python's str.split takes for white space.
_BLANK = r"\x09-\x0D\x1C-\x20\x{85}\p{Z}"

ORACLES: dict[str, str] = {
    "op10_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS raw
            FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
        w AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS c
            FROM (SELECT doc_id, i, regexp_replace(raw, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g') AS line,
                         len(regexp_extract_all(raw, '[^{_BLANK}]+')) AS n FROM l) WHERE n > 0),
        docs AS (SELECT doc_id, list(line ORDER BY i) AS lines FROM w GROUP BY doc_id),
        x AS (
            SELECT a.doc_id, a.p AS a, b.p AS b, b.c - a.c + a.n AS words, array_to_string(list_slice(d.lines, a.p, b.p), chr(10)) AS body
            FROM w a JOIN w b ON b.doc_id = a.doc_id AND b.p BETWEEN a.p AND a.p + 20 JOIN docs d ON d.doc_id = a.doc_id
            WHERE (b.c - a.c + a.n >= 10 AND b.c - a.c + a.n - b.n < 20) OR (b.c - a.c + a.n >= 20 AND b.c - a.c < 20)),
        h AS (SELECT body, min(doc_id) AS holder FROM x GROUP BY body),
        rare AS (SELECT line FROM w GROUP BY line HAVING count(DISTINCT doc_id) <= 64),
        near AS (SELECT w.doc_id, w.p FROM w JOIN rare ON rare.line = w.line),
        q AS (
            SELECT x.doc_id, x.a, x.b FROM x JOIN h ON h.body = x.body AND h.holder < x.doc_id
            WHERE x.words >= 20 OR EXISTS (SELECT 1 FROM near WHERE near.doc_id = x.doc_id AND near.p BETWEEN x.a AND x.b)),
        gone AS (SELECT DISTINCT w.doc_id, w.p, w.i FROM w JOIN q ON q.doc_id = w.doc_id AND w.p BETWEEN q.a AND q.b),
        span AS (SELECT g.doc_id, g.i AS low, coalesce(k.i - 1, g.i) AS high FROM gone g LEFT JOIN gone k ON k.doc_id = g.doc_id AND k.p = g.p + 1),
        m AS (SELECT l.*, EXISTS (SELECT 1 FROM span WHERE span.doc_id = l.doc_id AND l.i BETWEEN low AND high) AS gone FROM l),
        r AS (
            SELECT doc_id, min(i) || '-' || max(i) AS said, min(i) AS low
            FROM (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m WHERE gone) GROUP BY doc_id, run),
        t AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
                   coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM m GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN t.n_deleted > 0 THEN t.text ELSE d.text END AS text, coalesce(t.n_lines, 0) AS n_lines,
               coalesce(t.n_deleted, 0) AS n_deleted, (SELECT string_agg(said, ',' ORDER BY low) FROM r WHERE r.doc_id = d.doc_id) AS cut
        FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op2_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, g, g + 2), ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS g FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n, bit_xor(hash(g)) AS h FROM s GROUP BY doc_id),
        r AS (SELECT min(doc_id) AS rep, n, h FROM n GROUP BY n, h),
        t AS (SELECT s.doc_id, s.g FROM s JOIN r ON s.doc_id = r.rep),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * k >= 90 * (x.n + y.n - k)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        walk AS (SELECT rep AS node, rep AS low FROM r UNION SELECT e.b, walk.low FROM walk JOIN e ON e.a = walk.node WHERE walk.low < e.b),
        m AS (SELECT node, min(low) AS low FROM walk GROUP BY node)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN d.doc_id ELSE m.low END AS component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.n = n.n AND r.h = n.h LEFT JOIN m ON m.node = r.rep""",
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS body,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept,
               h AS text_sha256
        FROM t WINDOW w AS (PARTITION BY h ORDER BY length(body) DESC, doc_id)""",
    "op5_secret_scan": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                   coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
        k AS (
            SELECT * FROM (VALUES
                (0, 'assign', 6, '(?s)(.*?)(?:(?i:(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))|\z)'),
                (1, 'access', 20, '(?s)(.*?)(?:(AKIA[A-Z0-9]+)|\z)'),
                (2, 'hex', 24, '(?s)(.*?)(?:([0-9a-f]+)|\z)'),
                (3, 'owned', 20, '(?s)(.*?)(?:([A-Za-z0-9+/_-]{20,})|\z)')) AS v(k, kind, least, pattern)),
        f AS (
            SELECT r, 0 AS k, regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 0), 0) AS a, regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 0), 1) AS g,
                   regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 0), 2) AS s FROM d
            UNION ALL SELECT r, 1, regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 1), 0), regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 1), 1),
                   regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 1), 2) FROM d
            UNION ALL SELECT r, 2, regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 2), 0), regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 2), 1),
                   regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 2), 2) FROM d
            UNION ALL SELECT r, 3, regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 3), 0), regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 3), 1),
                   regexp_extract_all(t, (SELECT pattern FROM k WHERE k = 3), 2) FROM d),
        u AS (SELECT r, k, unnest(range(len(a))) AS i, unnest(a) AS a, unnest(g) AS g, unnest(s) AS s FROM f),
        p AS (SELECT *, sum(length(a)) OVER (PARTITION BY r, k ORDER BY i) - length(a) AS base FROM u),
        c AS (
            SELECT p.r, p.k, k.kind, CAST(base + length(g) AS BIGINT) AS a, CAST(base + length(p.a) AS BIGINT) AS b, sha256(s) AS h FROM p JOIN k ON k.k = p.k
            WHERE length(p.a) > length(g) AND length(s) >= least
              AND (p.k < 3 OR regexp_matches(s, '[0-9]') AND regexp_matches(s, '[a-z]') AND regexp_matches(s, '[A-Z]'))),
        o AS (SELECT h, count(DISTINCT repo) AS n_repos, count(DISTINCT owner) AS n_owners FROM c JOIN d ON d.r = c.r GROUP BY h),
        x AS (
            SELECT c.*, n_owners >= 3 OR n_repos >= 4 AS example,
                   c.k < 3 OR (n_owners = 1 AND n_repos < 4 AND NOT EXISTS (SELECT 1 FROM c AS y WHERE y.r = c.r AND y.k < 3 AND y.a < c.b AND c.a < y.b)) AS stays
            FROM c JOIN o ON o.h = c.h),
        n AS (
            SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
                   sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256,
                   string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans, count(*) FILTER (k = 3) AS n_owned,
                   count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_example
            FROM x WHERE stays GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
               coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
        FROM d LEFT JOIN n ON n.r = d.r""",
    "op6_url_filter": r"""
        WITH r AS (
            SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://(.*)$', 1, 's') ELSE '' END AS rest FROM pages),
        p AS (
            SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS own FROM p),
        j AS (
            SELECT page_id, host, path,
                   CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
                   own <> '' AND own IN (SELECT own FROM c WHERE url LIKE '%utm_source=%') AS listed
            FROM c)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
                    WHEN rule IS NOT NULL THEN 'allow'
                    WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
               listed FROM j""",
    "op7_decontaminate": r"""
        WITH words AS (
            SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+') AS w FROM documents
            UNION ALL
            SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+') FROM benchmark),
        items AS (SELECT id, least(5, len(w)) AS k, w FROM words WHERE kind = 1 AND len(w) > 0),
        ishing AS (SELECT DISTINCT id, k, array_to_string(list_slice(w, g, g + k - 1), ' ') AS s
                   FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS g FROM items)),
        dshing AS (SELECT DISTINCT id, k, array_to_string(list_slice(w, g, g + k - 1), ' ') AS s
                   FROM (SELECT d.id, x.k, d.w, unnest(generate_series(1, len(d.w) - x.k + 1)) AS g
                         FROM words d, (SELECT DISTINCT k FROM items) x WHERE d.kind = 0 AND len(d.w) >= x.k)),
        n AS (SELECT id, count(*) AS n FROM ishing GROUP BY id),
        f AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS f FROM ishing i JOIN dshing d USING (k, s) GROUP BY 1, 2)
        SELECT doc_id, item_id, n AS n_shingles, f AS n_found, f / n AS containment
        FROM f JOIN n ON n.id = f.item_id WHERE f >= 0.8 * n""",
}
