import datetime
import random

import pytest

from symcube.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string, item_id string, n_found int", "item_id long, text string, doc_id int"


def grams(words, k):
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(docs, items, threshold=0.8):
    out = []
    for item, text in items:
        words = D.words_of(text)
        if words:
            k = min(5, len(words))
            want = grams(words, k)
            for doc, body in docs:
                found = len(want & grams(D.words_of(body), k))
                if found and found >= threshold * len(want):
                    out.append((doc, item, len(want), found, found / len(want)))
    return sorted(out, key=str)


def data(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([1, 2, 4, 5, 6, 12, 30, 70, 300])))) for i in range(40)]
    docs = []
    for i in range(80):
        body = text(rng.choice([0, 3, 50, 400, 8000]))
        for _ in range(rng.choice([0, 1, 2])):
            piece = rng.choice(items)[1].split(" ")
            if rng.random() < 0.3:  # damaged or cut: on either side of the threshold
                piece = piece[: rng.randrange(len(piece)) + 1] + text(1) + piece[rng.randrange(len(piece)) :]
            at = rng.randrange(len(body) + 1)
            body[at:at] = piece
        docs.append((i, " ".join(body)))
    docs = [(i, t.upper().replace(" ", ", ") if i % 9 == 0 else t) for i, t in docs]
    return [*docs, docs[5], (None, docs[6][1]), (500, None), (501, "")], [*items, items[0], (77, None), (78, ""), (79, "?!")]


def run(spark, docs, items, **how):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    out = D.find_leaks(docs, items, **how).collect()
    clean = sorted(((r.doc_id, r.text) for r in D.drop_leaks(docs, items, **{k: v for k, v in how.items()}).collect()), key=str)
    return sorted(map(tuple, out), key=str), clean


@pytest.mark.parametrize("how", [{}, {"index_shingles": 200}])
def test_matches_brute_force(spark, how):
    docs, items = data(4)
    got, clean = run(spark, docs, items, **how)
    want = brute(docs, items)
    assert got == want and len(want) > 30
    leaked = {(d, t) for d, t in docs for w in want if w[0] == d and brute([(d, t)], items)}
    assert clean == sorted(((d, t) for d, t in docs if (d, t) not in leaked), key=str)


def test_empty(spark):
    docs, items = data(5)
    assert run(spark, [], items) == ([], [])
    assert run(spark, docs[:3], []) == ([], sorted(docs[:3], key=str))


def test_several_portions_and_types_of_ids(spark):
    items = spark.createDataFrame([(str(i), f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i} eta{i}") for i in range(30)] * 3, "item_id string, text string")
    docs = spark.createDataFrame([(datetime.date(2020, 1, 1 + i), f"start alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i} eta{i} end", "a", i) for i in range(28)] + [(None, "clean", "b", 1)], "doc_id date, text string, item_id string, `n.found` int")
    for limit in (1, 7, 10**6):
        got = D.find_leaks(docs, items, index_shingles=limit).collect()
        assert sorted((r.doc_id.day - 1, r.item_id) for r in got) == sorted((i, str(i)) for i in range(28) for _ in range(3))
    left = D.drop_leaks(docs, items, index_shingles=20)
    assert left.columns == docs.columns and [r.text for r in left.collect()] == ["clean"]
    with pytest.raises(TypeError):
        D.find_leaks(docs.selectExpr("1.5D AS doc_id", "text"), items)
