"""Exact, cached encoding of whole texts with a public tokenizer, and the range-sorted encode pass."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from symcube.llm.common import CACHES, sliced

#: Byte-level BPE writes printable Latin-1 bytes as themselves and the n-th other byte as chr(256 + n).
_OTHER = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTE_ALPHABET = {b: chr(256 + n) for n, b in enumerate(_OTHER)}
_SPACE = _BYTE_ALPHABET[ord(" ")]
#: Letters of the scripts before this one are letters in every version of Unicode in use.
_SURE = "\u0530"
#: Letters (or what may be), then punctuation without the apostrophe of contractions.
_MARKED = re.compile(r"(\0?[^\W\d_]+)([^\w\s']+)")
_ENCODERS: dict[tuple[str, int], Encoder] = {}


#: Words that each of an encoder's two cache generations holds.
CACHE_WORDS = 420_000


class _Whole(Exception):
    """A piece that can't be encoded apart from its text."""


class Encoder(dict):
    """Encodes texts to little-endian id bytes; ids of repeated words come from a bounded cache.

    A single space between two non-space characters always begins a new pre-token of byte-level BPE, so
    a text whose spaces are all of that kind may be encoded word by word; others are encoded whole.
    A word of letters is one pre-token and goes straight to the merges; punctuation after it, and a
    single line break between non-space characters, are pre-tokens of their own.  Other words take the
    tokenizer's whole way.  The cache is this dict: a word as it stands after a space, or "\\0" and a
    word that begins a text or line -> ids.  It has two generations of at most ``cache_words`` words.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        #: text that the tokenizer takes out before anything else; a text with one of these is encoded whole
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        self.model = self.tok.model
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.limit = cache_words
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.line = self._plain(["\n"])[0]
        split = self.tok.pre_tokenizer
        #: whether the facts about pre-tokens that this class relies on hold for this tokenizer
        self.bytewise = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
        self.bytewise = bool(self.bytewise and self.tok.normalizer is None and isinstance(self.model, models.BPE))

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            return self._new(word)
        self[word] = out
        return out

    def _new(self, word: str) -> bytes:
        first = word[:1] == "\0"
        bare = word[1:] if first else word
        if bare.isalpha():
            if bare.isascii():
                out = array(self.code, [t.id for t in self.model.tokenize(bare if first else _SPACE + bare)]).tobytes()
            elif max(bare) < _SURE:
                mapped = bare.encode().decode("latin-1").translate(_BYTE_ALPHABET)
                out = array(self.code, [t.id for t in self.model.tokenize(mapped if first else _SPACE + mapped)]).tobytes()
            else:
                out = self._plain([bare if first else " " + bare])[0]
            self[word] = out
            return out
        if (m := _MARKED.fullmatch(word)) and m[1].lstrip("\0").isalpha():
            mark = self.marks.get(m[2])
            if mark is None:
                mark = self._plain([m[2]])[0]
                if len(self.marks) < 50_000:
                    self.marks[m[2]] = mark
            stem = self.get(m[1])
            if stem is None:  # a word seen for the first time hardly comes with the same mark again
                return self[m[1]] + mark
            out = self[word] = stem + mark
            return out
        if not bare:
            if first:
                return b""
            raise _Whole
        if bare[0].isspace() or bare[-1].isspace() or "\0" in bare:
            raise _Whole
        if "\n" in bare:
            parts = bare.split()
            n = bare.count("\n")
            if len(parts) == n + 1 and sum(map(len, parts)) + n == len(bare):
                return self.line.join([self[word[0] + parts[0] if first else parts[0]], *(self["\0" + x] for x in parts[1:])])
        out = self[word] = self._plain([bare if first else " " + bare])[0]
        return out

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.bytewise:
            return self._plain(texts)
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        get, out = self.__getitem__, []
        for t in texts:
            if "\0" in t or any(x in t for x in self.added):
                out += self._plain([t])
                continue
            pieces = t.split(" ")
            pieces[0] = "\0" + pieces[0]
            try:
                out.append(b"".join(map(get, pieces)))
            except _Whole:
                out += self._plain([t])
        return out


def encoder(path: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder of this vocabulary; Python workers are reused, and so is its cache."""
    key = (path, cache_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, cache_words)
        CACHES.append(_ENCODERS[key].forget)
    return _ENCODERS[key]


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, chunk_bytes: int = 2_000_000, cache_words: int = CACHE_WORDS) -> Iterator[tuple[list, list[bytes]]]:
    """(ids column, id bytes with the end id) of batches of (doc_id, text), a bounded number of bytes or one text at a time."""
    enc = encoder(path, cache_words)
    end = np.array([end_id], enc.dtype).tobytes()
    for part in sliced(batches, 1, chunk_bytes, keep_caches=True):
        yield part.column(0).to_pylist(), [x + end for x in enc.encode([t or "" for t in part.column(1).to_pylist()])]


def in_order(docs, doc_id: str, text: str):
    """(doc_id, text) range-partitioned and sorted by id; equal ids by their text.

    The number of ranges follows the input's size; a hash of the text splits a hot id over ranges.
    """
    from pyspark.sql import functions as F

    from symcube.llm.common import partitions_for, text_or_empty

    slim = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text"))
    n = partitions_for(slim, 64 << 20)
    return slim.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
