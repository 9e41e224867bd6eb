"""Hashed word and character n-gram features of whole texts, computed in bounded slices with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


def _bucket(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * _MUL
    h ^= h >> np.uint64(29)
    return ((h * _MUL) >> np.uint64(64 - bits)).astype(np.int32)


def word_features(words: list[str], low: int, high: int, bits: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of the character n-grams of ``<word>``, and of each word as a whole."""
    points = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    buckets, owners = [], []
    h = np.zeros(len(points) + 1, np.uint64)
    for n in range(1, high + 1):
        h = h[:-1] * _STEP + points[n - 1 :]
        if n >= low:
            inside = owner[: len(h)] == owner[n - 1 :]
            buckets.append(_bucket(h[inside], n, bits))
            owners.append(owner[: len(h)][inside])
    if whole:
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(points)) - np.repeat(starts, sizes)
        powers = np.cumprod(np.full(int(sizes.max()), _STEP, np.uint64))
        buckets.append(_bucket(np.add.reduceat(points * powers[place], starts), 99, bits))
        owners.append(np.arange(len(words), dtype=np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


def slices(texts: list[str | None], max_chars: int = 400_000) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(distinct words, word numbers of all words, document numbers of all words) of bounded slices.

    A document longer than a slice is continued in the next one, so memory does not grow with a text; a word
    longer than a whole slice is cut.
    """
    vocab: dict[str, int] = {}
    index: list[int] = []
    docs: list[np.ndarray] = []
    size = 0
    for d, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text):
            to = min(len(text), at + max_chars - size)
            while to < len(text) and not text[to].isspace() and to - at < 2 * max_chars:
                to += 1
            before = len(index)
            index += [vocab.setdefault(w, len(vocab)) for w in text[at:to].split()]
            docs.append(np.full(len(index) - before, d, np.int32))
            size += to - at
            at = to
            if size >= max_chars:
                if index:
                    yield list(vocab), np.array(index, np.int32), np.concatenate(docs)
                vocab, index, docs, size = {}, [], [], 0
    if index:
        yield list(vocab), np.array(index, np.int32), np.concatenate(docs)


def repeats(index: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Document numbers of words that repeat the word before them."""
    return docs[1:][(index[1:] == index[:-1]) & (docs[1:] == docs[:-1])]


def document_sums(
    texts: list[str | None], table: np.ndarray, low: int, high: int, bits: int, whole: bool, extra: Callable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per text: sums of the table's rows over all its features (texts x columns), and feature counts."""
    columns = table.shape[1]
    sums, counts = np.zeros((len(texts), columns)), np.zeros(len(texts))
    for words, index, docs in slices(texts):
        buckets, owners = word_features(words, low, high, bits, whole)
        each = np.bincount(owners, minlength=len(words)).astype(np.float64)
        counts += np.bincount(docs, each[index], len(texts))
        for c in range(columns):
            per_word = np.bincount(owners, table[buckets, c], len(words))
            sums[:, c] += np.bincount(docs, per_word[index], len(texts))
        if extra is not None:
            bucket, numbers = extra(index, docs)
            n = np.bincount(numbers, minlength=len(texts))
            counts += n
            sums += n[:, None] * table[bucket]
    return sums, counts


def feature_counts(text: str | None, low: int, high: int, bits: int, whole: bool, extra: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, counts) of all features of a whole training text, slice by slice.

    Counts are 32 bits wide, more than a text of Spark's largest size can fill; there are at most 2^bits of them.
    """
    total: np.ndarray | None = None
    for words, index, docs in slices([text]):
        if total is None:
            total = np.zeros(1 << bits, np.int64)
        buckets, owners = word_features(words, low, high, bits, whole)
        total += np.bincount(buckets, np.bincount(index, minlength=len(words))[owners], 1 << bits).astype(np.int64)
        if extra is not None:
            bucket, numbers = extra(index, docs)
            total[bucket] += len(numbers)
    if total is None:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    found = np.flatnonzero(total)
    return found.astype(np.int32), total[found].astype(np.int32)
