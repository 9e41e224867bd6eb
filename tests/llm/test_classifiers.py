import decimal
import math
import os
import zlib

import numpy as np
import pytest

from symcube.llm import langid, quality
from symcube.llm.features import document_sums, word_features

DATA = "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are absent")


def fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_slices_do_not_change_sums(monkeypatch):
    import symcube.llm.features as f

    texts = ["ab cd  ab", None, "", " \n", "word " * 3000, "x" * 700 + " tail", "é日本 \U0001f600"]
    table = np.random.default_rng(0).normal(size=(1 << 10, 2))
    whole = document_sums(texts, table, 2, 3, 10, True)
    real = f.slices
    monkeypatch.setattr(f, "slices", lambda t: real(t, 777))
    parts = document_sums(texts, table, 2, 3, 10, True)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()
    assert whole[1][1] == whole[1][2] == whole[1][3] == 0


def test_word_features_do_not_depend_on_neighbours():
    one, _ = word_features(["cat"], 3, 4, 12, True)
    both, owner = word_features(["dog", "cat"], 3, 4, 12, True)
    assert sorted(one) == sorted(both[owner == 1])


def test_codewords():
    assert langid.codewords(4).shape == (4, 7)
    code = langid.codewords(12)
    gaps = (code.shape[1] - code @ code.T) / 2 + np.eye(12) * 99
    assert gaps.min() >= 8
    assert langid.codewords(1).shape == (1, 1)


@needs_data
def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == fold(r.doc_id) for r in got)
    seen = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in seen]) > 0.97
    assert np.mean([b for a, b in seen if a]) > 0.99


@needs_data
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.predict(docs, langid.fit(docs)).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == fold(r.doc_id) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert np.mean([r.ambiguous for r in held]) < 0.05


SCHEMA = "doc_id long, text string, lang string, score double, held_out int"


def rows():
    out = [(i, "the cat and the dog ran " * 5, "en", 0.0, 1) for i in range(30)]
    out += [(i, "der Hund und die Katze " * 5, "de", None, None) for i in range(30, 60)]
    return out + [(None, "the dog", "en", 0.0, 1), (100, None, "en", 0.0, 1), (101, "", None, 0.0, 1), (102, "12 !? 3", "de", 0.0, 1), (0, "the cat", "en", 0.0, 1)]


def test_language_edges(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = {}
    for r in langid.predict(docs, langid.fit(docs)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {got[i][0].lang_pred for i in (100, 101, 102)} == {"und"}
    assert got[40][0].lang_pred == "de" and got[None][0].lang_pred == "en" and len(got[0]) == 2
    none = spark.createDataFrame([(1, "abc", None, 0.0, 1)], SCHEMA)
    assert langid.predict(none, langid.fit(none)).first().lang_pred == "und"
    one = spark.createDataFrame([(1, "abc", "en", 0.0, 1), (3, "x", "en", 0.0, 1)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.predict(one, langid.fit(one)).collect()] == [("en", 1.0)] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.predict(empty, langid.fit(empty)).collect() == []


def test_quality_edges(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(60)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r.score for r in got}
    assert by[1] > 0.7 > 0.3 > by[40] and by[100] == by[101]
    none = quality.fit(docs, labels.where("quality > 5"))
    assert all(abs(r.score - 0.5) < 1e-9 for r in quality.score(docs, none).collect())
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(30))
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.score(empty, quality.fit(empty, labels.limit(0))).collect() == []


def bucket(text, salt, bits):
    """The bucket of one n-gram, from the definition of the hash."""
    mask, h = (1 << 64) - 1, 0
    for c in text:
        h = (h * 0x100000001B3 + ord(c)) & mask
    h = (h + salt) * 0x9E3779B97F4A7C15 & mask
    h ^= h >> 29
    return (h * 0x9E3779B97F4A7C15 & mask) >> 64 - bits


def whole_bucket(word, bits):
    mask = (1 << 64) - 1
    h = sum(ord(c) * pow(0x100000001B3, i + 1, 1 << 64) for i, c in enumerate(word)) & mask
    h = (h + 99) * 0x9E3779B97F4A7C15 & mask
    h ^= h >> 29
    return (h * 0x9E3779B97F4A7C15 & mask) >> 64 - bits


def buckets(text, low, high, bits, whole):
    """All features of a text, one after the other."""
    out = []
    for word in (text or "").split():
        marked = f"<{word}>"
        for n in range(low, high + 1):
            out += [bucket(marked[i : i + n], n, bits) for i in range(len(marked) - n + 1)]
        out += [whole_bucket(marked, bits)] * whole
    return out


def repeated(text):
    words = (text or "").split()
    return sum(a == b for a, b in zip(words, words[1:], strict=False))


def test_quality_scores_match_brute_force(spark):
    docs = spark.createDataFrame(rows() + [(200, "word " * 30 + "the cat é日本 \U0001f600", "en", 0.0, 1)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    texts = {(i, t) for i, t, *_ in docs.collect()}
    for r in got:
        scores = set()
        for t in (t for i, t in texts if i == r.doc_id):
            found = buckets(t, quality.LOW, quality.HIGH, quality.BITS, True) + [quality.REPEAT] * repeated(t)
            z = sum(float(model.table[b]) for b in found) / max(len(found), 1) + model.bias
            scores.add(round(1 / (1 + math.exp(-z)), 9))
        assert round(r.score, 9) in scores and r.predicted == (r.score >= 0.7)


def test_language_decoding_matches_brute_force(spark):
    docs = spark.createDataFrame(rows() + [(300 + i, "le chien et le chat " * 3, "fr", 0.0, 1) for i in range(20)], SCHEMA)
    model = langid.fit(docs)
    assert model.names == ["de", "en", "fr"]
    texts = {(i, t) for i, t, *_ in docs.collect()}
    for r in langid.predict(docs, model).collect():
        answers = []
        for t in (t for i, t in texts if i == r.doc_id):
            if t is None or not any(c.isalpha() for c in t):
                answers.append(("und", 0.0, True))
                continue
            found = buckets(t.lower(), langid.LOW, langid.HIGH, langid.BITS, False)
            margins = [sum(float(model.table[b][k]) for b in found) / max(len(found), 1) + float(model.bias[k]) for k in range(model.code.shape[1])]
            loss = [sum(w * math.log1p(math.exp(-m * c)) for m, c, w in zip(margins, model.code[y], model.weight[y], strict=True)) for y in range(3)]
            share = [math.exp(4 * (min(loss) - x)) for x in loss]
            share = [x / sum(share) for x in share]
            best = max(range(3), key=lambda y: share[y])
            answers.append((model.names[best], round(share[best], 6), share[best] - sorted(share)[-2] < 0.2))
        assert (r.lang_pred, round(r.score, 6), r.ambiguous) in answers


@pytest.mark.parametrize("size", [65_535, 1_000_000])
def test_one_long_training_word_does_no_harm(spark, size):
    ids = [i for i in range(200) if not fold(i)]
    en = [(i, "the cat and the dog ran " * 5, "en", 0.0, 1) for i in ids[:40]]
    de = [(i, "der Hund und die Katze " * 5, "de", 0.0, 1) for i in ids[40:80]]
    docs = spark.createDataFrame([*en, *de, (ids[80], "x" * size, "de", 0.0, 1), (ids[81], "y " * size, "en", 0.0, 1)], SCHEMA)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert all(got[i].lang_pred == "en" for i in ids[:40]) and all(got[i].lang_pred == "de" for i in ids[40:80])
    assert all(0 <= r.score <= 1 for r in got.values())
    labels = spark.createDataFrame([(i, int(n < 40 or n == 81), 0) for n, i in enumerate(ids[:82])], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert min(scores[i] for i in ids[:40]) > 0.7 > 0.3 > max(scores[i] for i in ids[40:80]) and all(0 <= x <= 1 for x in scores.values())


def test_counts_cover_whole_texts_in_slices(monkeypatch):
    import symcube.llm.features as f

    text = "ab cd ab " + "word " * 3000 + "x" * 5000
    real = f.slices
    found, n = f.feature_counts(text, 2, 3, 16, True)
    monkeypatch.setattr(f, "slices", lambda t: real(t, 6000))
    again = f.feature_counts(text, 2, 3, 16, True)
    assert (found == again[0]).all() and (n == again[1]).all() and n.dtype == np.int32
    want = np.bincount(buckets(text, 2, 3, 16, True), minlength=1 << 16)
    assert (np.flatnonzero(want) == found).all() and (want[found] == n).all()
    assert all(len(x) == 0 for x in f.feature_counts(None, 2, 3, 16, True))


def test_hot_and_null_ids_stay_bounded(spark):
    many = [(None, "the same words", "en", 0.0, 1)] * 300 + [(7, "der Hund", "de", 0.0, 1)] * 300
    docs = spark.createDataFrame(many, SCHEMA)
    got = langid.predict(docs, langid.fit(docs, per_language=5)).collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("kind", ["decimal(20,0)", "string"])
def test_types_of_ids(spark, kind):
    value = {"decimal(20,0)": decimal.Decimal(3), "string": "three"}[kind]
    docs = spark.createDataFrame([(value, "abc", "en")], f"doc_id {kind}, text string, lang string")
    labels = spark.createDataFrame([(value, 1)], f"doc_id {kind}, quality int")
    assert langid.predict(docs, langid.fit(docs)).first().doc_id == value
    assert quality.score(docs, quality.fit(docs, labels)).first().doc_id == value
    with pytest.raises(TypeError):
        quality.score(docs.select(docs["doc_id"].cast("string").cast("double").alias("doc_id"), "text"), quality.train([]))


def test_keep_good_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "q"), (2, None, 2, None)], "doc_id long, text string, score int, `a.b` string")
    kept = quality.keep_good(docs, quality.train([]), threshold=0.5)
    assert kept.columns == docs.columns and sorted(kept.collect()) == sorted(docs.collect())
    assert quality.keep_good(docs, quality.train([]), threshold=0.51).collect() == []
