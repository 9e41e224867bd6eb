import functools
import math
import os
import random
import re

import numpy as np
import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from symcube.llm import quality, queries  # noqa: E402
from symcube.llm.decontaminate import words_of  # noqa: E402

#: The columns of documents, and some with names that the stages might use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tag string, stays int, `__gone_id` string, whole int, score double, sid string, row long"
EXTRA = ("t", 1, "g", 2, 0.5, "s", 7)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(900)]
    bench = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 30])))) for i in range(8)]
    docs = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randrange(20, 150))]
        docs.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(rng.choice([" ", "  ", "\n"]).join(copy))
        if rng.random() < 0.2:
            docs.append(" ".join(base[:20] + [rng.choice(bench)[1]] + base[20:]))
    junk = ["### &&& %%% " * rng.randrange(5, 30) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(docs + junk)]
    rng.shuffle(rows)
    labels = [(i, int(i < len(docs)), 0) for i, _ in rows if i % 2]
    rows += [(None, docs[0]), (None, "a null id " + docs[1]), (9000, None), (9001, ""), rows[0], rows[0]]
    rows += [(9002, " ".join(rng.choice(words) for _ in range(40_000))), (9003, "word5 " * 60_000), (9004, "word7" * 70_000)]
    return rows, labels, bench


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, labels, bench = corpus(3)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, None, "s", len(t or ""), *EXTRA) for i, t in rows], DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path, rows, bench


def squeeze(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def grams(words, k):
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def components(sets, link):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and link(a, sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


@functools.cache
def _bucket(ngram, salt, bits):
    mask, h = (1 << 64) - 1, 0
    for c in ngram:
        h = (h * 0x100000001B3 + ord(c)) & mask
    h = (h + salt) * 0x9E3779B97F4A7C15 & mask
    return ((h ^ h >> 29) * 0x9E3779B97F4A7C15 & mask) >> 64 - bits


@functools.cache
def _word(word, low, high, bits):
    """Features of one word: its n-grams, and itself as a whole."""
    marked, mask = f"<{word}>", (1 << 64) - 1
    h = (sum(ord(c) * pow(0x100000001B3, i + 1, 1 << 64) for i, c in enumerate(marked)) + 99) * 0x9E3779B97F4A7C15 & mask
    whole = ((h ^ h >> 29) * 0x9E3779B97F4A7C15 & mask) >> 64 - bits
    return [_bucket(marked[i : i + n], n, bits) for n in range(low, high + 1) for i in range(len(marked) - n + 1)] + [whole]


def quality_score(model, text):
    """The softmax of the average of a text's vectors, feature by feature."""
    words = (text or "").split()
    found = [b for w in words for b in _word(w, quality.LOW, quality.HIGH, quality.BITS)]
    found += [quality.REPEAT] * sum(a == b for a, b in zip(words, words[1:], strict=False))
    return 1 / (1 + math.exp(-(sum(float(model.table[b]) for b in found) / max(len(found), 1) + model.bias)))


def test_each_stage_against_brute_force(spark, tables):
    path, rows, bench = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(pipeline.STAGES)

    good = stages["quality_classifier"](spark, docs, path)
    assert good.columns == docs.columns
    kept = pairs(good)
    assert all("###" not in (t or "") for _, t in kept)
    assert {i for i, t in kept} >= {i for i, t in rows if t and "###" not in t and (i or 0) < 9002}
    model = quality.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    scored = {t: quality_score(model, t) for _, t in rows}
    assert kept == sorted(((i, t) for i, t in rows if scored[t] >= 0.7), key=str)
    assert all(tuple(r)[5:] == EXTRA for r in good.collect())

    once = stages["exact_dedup"](spark, good, path)
    assert once.columns == docs.columns
    groups = {}
    for i, t in kept:
        groups.setdefault(squeeze(t), []).append((-len(t or ""), i is None, i or 0, i, t))
    want = sorted(((min(v)[3], min(v)[4]) for v in groups.values()), key=str)
    assert pairs(once) == want

    near = stages["ngram_join"](spark, once, path)
    assert near.columns == docs.columns
    sets = [grams((t or "").lower().split(), 5) for _, t in want]
    label = components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    first = {}
    for (i, t), c in zip(want, label, strict=True):
        first[c] = min(first.get(c, (True, 0, None, None)), (i is None, i or 0, i, t), key=lambda x: x[:2])
    want = sorted(((i, t) for _, _, i, t in first.values()), key=str)
    assert pairs(near) == want and len(want) < len(sets)

    clean = stages["decontamination"](spark, near, path)
    assert clean.columns == docs.columns
    items = [(min(5, len(words_of(t))), grams(words_of(t), min(5, len(words_of(t))))) for _, t in bench]
    leaks = lambda t: any(len(s & grams(words_of(t), k)) >= 0.8 * len(s) for k, s in items)
    kept = [(i, t) for i, t in want if not leaks(t)]
    assert pairs(clean) == kept and len(kept) < len(want)

    packed = stages["packing"](spark, clean, path).collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert sum(r.start == 0 for r in packed) == len(kept)
    places = sorted((r.sequence_id, r.offset, r.length) for r in packed)
    assert all(a * 2048 + b + c == d * 2048 + e for (a, b, c), (d, e, _) in zip(places, places[1:], strict=False))


def test_run_and_empty_tables(spark, tables, tmp_path):
    path, _, _ = tables
    assert pipeline.run(spark, path).count() > 0
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are absent")
def test_query_contracts(spark):
    data = "/root/testdata/sf0.001"
    ids = {r.doc_id for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id").collect()}
    columns = {
        "op1": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op2": ["doc_id", "n_shingles", "component_id"],
        "op3": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
        "op4": ["doc_id", "held_out", "score", "predicted"],
        "op5": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        "op6": ["page_id", "host", "path", "rule", "verdict"],
        "op8": ["doc_id", "held_out", "lang_pred", "score"],
        "op9": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op10": ["doc_id", "text", "n_lines", "n_deleted"],
    }
    for name, query in queries.QUERIES.items():
        out = query(spark, data)
        want = columns.get(name.split("_")[0], [])
        assert out.columns[: len(want)] == want, name
        if want and want[0] == "doc_id":
            assert {r.doc_id for r in out.select("doc_id").collect()} == ids, name
    starts = sorted((r.start, r.n_tokens) for r in queries.QUERIES["op1_sstable_shards"](spark, data).collect())
    assert np.array_equal([s for s, _ in starts], np.cumsum([0, *(n for _, n in starts)])[:-1])
