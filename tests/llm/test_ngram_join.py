import decimal
import random
import re

import numpy as np
import pytest

from symcube.llm import bloom
from symcube.llm import ngram_join as J
from symcube.llm.graph import connected_components

SCHEMA = "doc_id long, text string, sid string, n_shingles int, root int"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def linked(a, b):
    return 100 * len(a & b) >= 90 * len(a | b)


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and linked(a, sets[j]):
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))), key=str)


def corpus(seed, n=160, length=(1, 120), vocab=400, common=8):
    """Documents with near copies of very different distances, common passages and odd cases."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["É", "A", "a"]
    text = lambda k: [rng.choice(words) for _ in range(k)]
    passage = [text(12) for _ in range(common)]
    out = []
    while len(out) < n:
        base = text(rng.randint(*length))
        for _ in range(rng.choice([0, 0, 1, 2])):
            base[rng.randrange(len(base)) : 0] = rng.choice(passage)
        out.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(copy)
    texts = [rng.choice([" ", "  ", "\n", "\t "]).join(x) for x in out[:n]]
    return [t.upper() if rng.random() < 0.1 else t for t in texts] + [None, "", " \n", "one", "ONE", "one two", "one  two "]


def run(spark, rows, **how):
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    out = J.similarity_classes(frame.repartition(3), **how).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


def filled(tokens):
    bits = np.zeros(8 * 4096, np.uint8)
    if len(tokens):
        bits[np.unique(bloom.probes(J.mix(tokens), 4096 // 32)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def test_signatures_and_forest_lose_no_link():
    rng = random.Random(0)
    for seed in range(12):
        texts = corpus(seed, n=220, length=(6, 400) if seed % 2 else (6, 40))
        sets = J.token_sets(texts)
        assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
        all_tokens, df = np.unique(np.concatenate(sets), return_counts=True)
        for frequent, counted in ((3, 2), (2, 2), (10**9, 2), (3, 1), (1, 1)):
            known = J.Tokens(filled(all_tokens[df >= counted]), filled(all_tokens[df >= frequent][:: rng.choice([1, 2])]))
            signed = [set(J.signatures(s, known).tolist()) if len(s) else set() for s in sets]
            for i, a in enumerate(sets):
                for j in range(i):
                    b = sets[j]
                    both = len(np.intersect1d(a, b))
                    if len(a) and len(b) and not np.array_equal(a, b) and 100 * both >= 90 * (len(a) + len(b) - both):
                        assert signed[i] & signed[j], (seed, len(a), len(b))
        full = [s for s in sets if len(s)]
        label = J.forest(full)
        want = {i: None for i in range(len(full))}
        rows = [(i, t) for i, t in enumerate(t for t in texts if shingle_set(t))]
        want = {i: c for i, _, c in brute(rows)}
        assert [want[i] for i in range(len(full))] == label.tolist()


def test_signatures_stay_in_proportion():
    tokens = np.unique(np.random.default_rng(0).integers(0, 1 << 62, 60_000).astype(np.uint64) * np.uint64(4))
    known = J.Tokens(np.full(4096, 255, np.uint8), np.full(4096, 255, np.uint8))
    assert len(J.signatures(tokens, known)) < len(tokens)


@pytest.mark.parametrize("how", [{}, {"frequent": 2}, {"frequent": 2, "block_tokens": 300, "portion": 2}, {"frequent": 2, "bloom_bytes": 1}, {"frequent": 10**6}])
def test_matches_brute_force(spark, how):
    rows = [((i * 37) % 1009, t) for i, t in enumerate(corpus(99))]
    rows += [(None, rows[0][1]), (None, "null id alone in its class here"), (rows[3][0], rows[3][1]), (rows[3][0], rows[9][1])]
    assert run(spark, rows, **how) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def near_copies(n, words=120, seed=5):
    """A chain of near copies: each differs from the one before by a few words, so its ends differ much."""
    rng = random.Random(seed)
    text = [f"c{i}" for i in range(words)]
    out = []
    for _ in range(n):
        text = list(text)
        text[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("how", [{}, {"portion": 2, "block_tokens": 400}])
def test_a_large_cluster_that_one_pivot_does_not_link(spark, how):
    rows = [(i, t) for i, t in enumerate(near_copies(60) + near_copies(25, seed=6) + corpus(3, n=40))]
    assert run(spark, rows, **how) == brute(rows)


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_keep_first_of_class_on_both_sides_of_the_broadcast(spark, broadcast_rows):
    rows = [(i, t) for i, t in enumerate(near_copies(30) + corpus(7, n=60))] + [(0, None), (None, "one two three four")]
    frame = spark.createDataFrame([(i, t, 1, "g") for i, t in rows], "doc_id long, text string, tag int, doc_id_ string").withColumnRenamed("doc_id_", "stays")
    out = J.keep_first_of_class(frame.repartition(3), broadcast_rows=broadcast_rows)
    assert out.columns == ["doc_id", "text", "tag", "stays"]
    first = {i: c for i, _, c in brute(rows) if i is not None and i != c}
    want = [(i, t) for i, t in rows if i not in first]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_very_long_texts(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(30_000)}" for _ in range(60_000)]
    other = list(long)
    for i in range(0, 60_000, 60):
        other[i] = "changed"
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, "x" * 2_500_000), (4, "x" * 2_500_000 + "\n"), (5, "a " * 400_000)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize(("kind", "ids"), [("decimal(20,0)", [decimal.Decimal(3), decimal.Decimal(7)]), ("string", ["a", "b"])])
def test_types_of_ids(spark, kind, ids):
    got = J.similarity_classes(spark.createDataFrame([(i, "one two three") for i in reversed(ids)], f"doc_id {kind}, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == [(ids[0], 1, ids[0]), (ids[1], 1, ids[0])]
    with pytest.raises(TypeError):
        J.similarity_classes(spark.createDataFrame([(1.5, "a")], "doc_id double, text string"))


def test_connected_components(spark):
    rng = random.Random(2)
    names = rng.sample(range(10**6), 400)
    edges = [(names[i], names[i + 1]) for i in range(120)]  # a path
    edges += [(names[150], n) for n in names[151:220]] + [(n, names[150]) for n in names[160:170]]  # a star, with edges back
    edges += [(names[230], names[230]), (None, names[3]), (names[231], names[232]), (names[231], names[232])]
    edges += [(rng.choice(names[240:]), rng.choice(names[240:])) for _ in range(140)]
    root = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        if a in root and b in root and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: find(n) for n in root} and len(got) == len(root)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
