import random

import pytest
import xxhash

from symcube.llm import url_filter as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PAGES = "page_id long, url string, host string, row string, key int"


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[n:]
    m = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return rest[:n].translate({c: c + 32 for c in range(65, 91)}), path[:m]


def canonical(url):
    host, path = host_path(url)
    return host.removeprefix("www.") + path.rstrip("/")


def brute(url, rules, listed):
    host, path = host_path(url)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    own = canonical(url)
    hit = own != "" and own in {canonical(x) for x in listed}
    if fit:
        _, rule, verdict = max(fit)
        return host, path, rule, verdict, hit
    return host, path, None, "block" if hit else "allow", hit


def urls():
    rng = random.Random(2)
    hosts = ["a.example.org", "example.org", "EXAMPLE.org", "notexample.org", "x.com", "com", "www.shop.net", "shop.net", "m.x.co", "é.org", "", "org", "a.b.c.d.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/123/", "/fr/a", "/de/", "/DE/", "/de/b//", "?x=/de/", "#/de/", "/fr/?u=http://q.org/es/"]
    out = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    return [*out, None, "", "no scheme", "http:/half", "://", "a://b://c/de/", "http://x.com/de/\nnew line", "http://" + "a." * 3000 + "com/de/"]


def run(spark, pages, rules, listed, **how):
    frame = spark.createDataFrame([(i, u, "h", "r", 1) for i, u in pages], PAGES).repartition(3)
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    listed = spark.createDataFrame([(u,) for u in listed], "url string")
    out = U.filter_urls(frame, rules, listed, **how).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in out), key=str)


def test_matches_brute_force(spark):
    pages = list(enumerate(urls()))
    pages += [(None, "http://x.com/de/1"), (3, "http://x.com/de/1"), (3, "http://x.com/de/1")]
    listed = ["http://www.shop.net/es", "https://SHOP.net", "http://notexample.org/de/b", None, "", "bad"]
    want = sorted(((i, *brute(u, RULES, listed)) for i, u in pages), key=str)
    assert run(spark, pages, RULES, listed) == want
    assert run(spark, pages, RULES, listed, bloom_bytes=1, hot=1) == want
    assert run(spark, pages, RULES, listed, hot=10**9) == want
    glued = [*RULES, ("shop.n", "et", "block"), ("net", "et/x", "block")]  # a path that does not begin with a slash fits nothing
    assert run(spark, pages, glued, listed) == want
    odd = [*RULES, ("com", "/de/", "allow"), (None, "/", "block"), ("net", None, "block"), ("net", "", "block")]
    want = sorted(((i, *brute(u, [*RULES, ("net", "", "block")], [])) for i, u in pages), key=str)
    assert run(spark, pages, odd, []) == want


def test_empty(spark):
    assert run(spark, [], RULES, ["http://a.org"]) == []
    assert [r[4] for r in run(spark, [(1, "http://a.org/"), (2, None)], [], [])] == ["allow", "allow"]


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F

    keys = ["", "a", "R com/de/", "é" * 50]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k")).collect()]
    assert [g % (1 << 64) for g in got] == [xxhash.xxh64_intdigest(k.encode(), 42) for k in keys]


def test_bloom_has_no_false_negatives(spark):
    keys = [f"U host{i}.example/{i}" for i in range(5000)]
    bloom = U.build_bloom(spark.createDataFrame([(k,) for k in keys], "key string"))
    assert U.may_hold(bloom, keys).all()
    assert U.may_hold(bloom, [f"U other{i}" for i in range(5000)]).mean() < 0.05


def test_hot_urls_and_rules(spark):
    pages = [(i, "http://Hot.net/a/" if i % 3 else f"http://s{i}.com/de/{i}") for i in range(900)] + [(900 + i, f"http://cold{i % 40}.net/") for i in range(200)]
    listed = ["http://hot.net/a", *(f"http://cold{i}.net" for i in range(0, 40, 2)), *(f"http://none{i}.net" for i in range(50))]
    want = sorted(((i, *brute(u, RULES, listed)) for i, u in pages), key=str)
    for hot in (1, 4, 1024):
        assert run(spark, pages, RULES, listed, hot=hot) == want


def test_other_types_of_ids_are_refused(spark):
    with pytest.raises(TypeError):
        U.filter_urls(spark.createDataFrame([(1.5, "a")], "page_id double, url string"), spark.createDataFrame([], "host string, path string, verdict string"), spark.createDataFrame([], "url string"))
