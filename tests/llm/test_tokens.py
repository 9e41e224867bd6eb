import datetime
import decimal
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from symcube.llm import packing, sstable
from symcube.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, ids int, part string"
PARTS = ["a", "Hello", " ", "  ", "\n", "\r\n", "\t", " ", " ", "\x85", "\x1c", "don't", "'s", "12", "ß", "日本", "\U0001f600", "!?", "<|endoftext|>", "x\n", "\0", "\0a", "a\nb", "\na", "Zebrafinch,", "schön.", "éclair", "end.\nBegin", "x.\n\ny", "ſ", "ªb", "Ⅷ"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice(["", " ", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_encoder_is_exact(plain):
    enc = Encoder(PATH, cache_words=50)
    for seed in range(5):
        batch = texts(400, seed)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(batch)] == [plain(t) for t in batch]


def rows():
    out = [(i * 7 % 101 - 20, t) for i, t in enumerate(texts(100, 9))]
    return out + [(None, "none first"), (500, None), (501, ""), (502, "long text " * 6000), (600, "again"), (600, "again"), (600, "other")]


def frame(spark, data):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in data], SCHEMA)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_round_trip(spark, plain):
    data = rows()
    manifest = sstable.write_shards(frame(spark, data).repartition(3), PATH, 2)
    got = sorted(sstable.read_shards(manifest, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got][:2] == [False, True]
    assert [r.doc_id for r in got[1:]] == sorted(i for i, _ in data if i is not None)
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and r.ids_crc32 == crc(ids)
        assert ids in [[*plain(t), 2] for i, t in data if i == r.doc_id]
        at += len(ids)
    found = sstable.lookup(manifest, [502, 600, None, 12345])
    assert found[502][0].tolist() == [*plain("long text " * 6000), 2]
    assert len(found[600]) == 3 and len(found[None]) == 1 and found[12345] == []


def test_shard_file(tmp_path):
    path = f"file://{tmp_path}/a/b.sst"
    w = sstable.Writer(path, 2, block_bytes=200)
    keys = sorted(sstable.encode_key(k) for k in [None, -5, 0, 3, 3, 3, 2**62, *range(1000, 1200), "a", "ab", "abc"])
    for n, k in enumerate(keys):
        w.add(k, np.full(n % 90, n, "<u2").tobytes())
    w.close()
    r = sstable.Reader(path)
    assert [k for k, _ in r] == keys and r.docs == len(keys) and len(r.where) > 20
    assert len(r.get(3)) == 3 and len(r.get("ab")) == 1 and len(r.get(None)) == 1 and r.get(7) == []
    assert sum(r.may_hold(sstable.encode_key(i)) for i in range(10_000, 20_000)) < 500
    with open(f"{tmp_path}/a/b.sst", "r+b") as f:
        f.truncate(100)
    with pytest.raises(ValueError):
        sstable.Reader(path)


@pytest.mark.parametrize("by_id", [False, True])
def test_packing(spark, plain, by_id):
    data = rows()
    got = packing.pack(frame(spark, data).repartition(3), PATH, 64, 1, by_id=by_id).collect()
    if by_id:
        order = [r.doc_id for r in sorted(got, key=lambda r: (r.sequence_id, r.offset))]
        assert order[0] is None and [i for i in order if i is not None] == sorted(i for i in order if i is not None)
    whole = {}
    for r in got:
        assert 0 < r.length <= 64 and r.offset + r.length <= 64
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        whole.setdefault((r.sequence_id, r.offset), r)
    assert len(whole) == len(got)
    at = 0
    stream = []
    for (seq, off), r in sorted(whole.items()):
        assert seq * 64 + off == at
        at += r.length
        stream += np.frombuffer(r.ids, "<u4").tolist()
        assert r.continued == (r.start > 0) and r.continues == (r.start + r.length < r.doc_tokens)
    assert at == sum(len(plain(t)) + 1 for _, t in data)
    docs, now = [], []
    for i in stream:
        now.append(i)
        if i == 1:
            docs.append(tuple(now))
            now = []
    assert sorted(docs) == sorted((*plain(t), 1) for _, t in data)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert packing.pack(empty, PATH).collect() == []
    manifest = sstable.write_shards(empty, PATH)
    assert sstable.read_shards(manifest).collect() == []


@pytest.mark.parametrize("kind", ["tinyint", "string", "decimal(20,0)", "date"])
def test_types_of_ids(spark, plain, kind):
    value = {"decimal(20,0)": decimal.Decimal(3), "tinyint": 3, "string": "three", "date": datetime.date(2020, 1, 3)}[kind]
    docs = spark.createDataFrame([(value, "a b"), (None, "c")], f"doc_id {kind}, text string")
    got = packing.pack(docs, PATH, keep_ids=False)
    assert got.schema["doc_id"].dataType.simpleString() == kind and {r.doc_id for r in got.collect()} == {value, None}
    if kind in ("tinyint", "string"):
        out = sstable.read_shards(sstable.write_shards(docs, PATH))
        assert out.schema["doc_id"].dataType.simpleString() == kind
        assert [(r.doc_id, r.start, r.n_tokens) for r in out.orderBy("start").collect()] == [(None, 0, len(plain("c")) + 1), (value, len(plain("c")) + 1, len(plain("a b")) + 1)]
    else:
        with pytest.raises(TypeError):
            sstable.write_shards(docs, PATH)


def test_special_tokens_are_taken_as_the_tokenizer_does(spark, plain):
    text = "a<|endoftext|>b and more words"
    assert 50256 in plain(text) and len(plain("a<|endoftext|>b")) == 3
    assert np.frombuffer(Encoder(PATH).encode([text])[0], Encoder(PATH).dtype).tolist() == plain(text)
    got = sstable.read_shards(sstable.write_shards(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH)).first()
    assert got.ids_crc32 == crc([*plain(text), 2])
