import datetime
import decimal
import hashlib
import random

import pytest

from symcube.llm.exact_dedup import exact_dedup, keep_first

SCHEMA = "doc_id long, text string, row string, digest int, size int"


def norm(t):
    return (t or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def check(spark, rows, **more):
    got = exact_dedup(frame(spark, rows), **more).collect()
    want = brute(rows)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == by_hash[r.text_sha256]
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in kept)
    return got


def test_mixed(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (0, "a  b"), (4, None), (5, ""), (6, " \n"), (None, "q"), (7, "q"), (8, " "), (9, "z" * 100_000)]
    rows += [(20, "same"), (20, "same"), (20, "same")]
    check(spark, rows)


def test_hot_group_takes_the_broadcast_way(spark):
    rng = random.Random(1)
    rows = [(i, "hot" + " " * rng.randrange(4) if i % 3 == 0 else f"t{rng.randrange(300)}") for i in range(3000)]
    check(spark, rows)
    check(spark, rows, heavy=2, tracked=16)


def test_empty(spark):
    assert exact_dedup(frame(spark, [])).collect() == []
    assert keep_first(frame(spark, [])).collect() == []


def test_keep_first_keeps_columns_and_one_row(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "c"), (None, "c"), (3, None), (4, ""), (3, None)]
    out = keep_first(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "row", "digest", "size"]
    got = sorted((r.doc_id or -1, r.text) for r in out.collect())
    assert [i for i, _ in got] == [-1, 1, 3]


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_keep_first_with_clashing_names_on_both_sides_of_the_broadcast(spark, broadcast_rows):
    names = ["doc_id", "text", "__digest", "whole", "sha", "gone_id", "a.b"]
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "c"), (None, "c"), (3, None), (4, ""), (3, None), (5, "d" * 300_000)]
    frame = spark.createDataFrame([(i, t, "mine", 1, "s", n, "x") for n, (i, t) in enumerate(rows)], ", ".join(f"`{n}` {'long' if n in ('doc_id', 'whole', 'gone_id') else 'string'}" for n in names))
    out = keep_first(frame.repartition(3), broadcast_rows=broadcast_rows)
    assert out.columns == names
    got = out.collect()
    assert sorted((str(r.doc_id), len(r.text or "")) for r in got) == [("1", 3), ("3", 0), ("5", 300_000), ("None", 1)]
    assert all(r["__digest"] == "mine" and r["a.b"] == "x" for r in got)


def test_frequent_digests_that_the_sketch_does_not_name(spark):
    rows = [(i, f"t{i % 40}" + " " * (i % 7)) for i in range(1200)]
    check(spark, rows, heavy=1, tracked=4)


@pytest.mark.parametrize("kind", ["decimal(20,0)", "tinyint", "string", "date"])
def test_types_of_ids(spark, kind):
    value = {"decimal(20,0)": decimal.Decimal(3), "tinyint": 3, "string": "three", "date": datetime.date(2020, 1, 3)}[kind]
    frame = spark.createDataFrame([(value, "abc"), (None, "a bc")], f"doc_id {kind}, text string")
    assert {r.keep_id for r in exact_dedup(frame).collect()} == {None} and keep_first(frame).collect() == [(None, "a bc")]
