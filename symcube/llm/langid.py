"""Language identification with error-correcting output codes.

Each language gets a codeword; for every bit a logistic classifier over hashed character n-grams
of the lower-cased text (counts divided by their number) is trained by numpy stochastic gradient descent on a bounded sample.
A text's bit margins are decoded with loss weighting: each language's loss is the weighted sum of the
logistic losses of its codeword's bits, bits weighing by their accuracy on that language's training
texts.  The language of least loss wins; its score is the softmax of the negative losses, and it is
ambiguous if the runner-up's score is within ``margin``.  Scoring reads whole texts, without a shuffle.

Defined results
---------------
* ``und`` with score 0 for null texts and texts without a Unicode letter, or if no language was learned;
* null languages teach nothing; with a single learned language every text with a letter gets it, score 1;
* every input row gets a result, null ids (never held out) and repeated rows included;
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm.common import bound_batches, held_out, id_type, release_memory, sliced
from symcube.llm.features import document_sums, feature_counts

LOW, HIGH, BITS = 1, 3, 16
_LETTER = regex.compile(r"\p{L}")


def codewords(classes: int, seed: int = 5) -> np.ndarray:
    """classes x bits of +1 and -1: all distinct two-way splits up to 6 classes, else the widest of random codes."""
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = np.arange(1, 1 << (classes - 1))
        return np.where((splits >> np.arange(classes)[:, None]) & 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(classes)))
    best, width = None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (classes, bits))
        gaps = (bits - code @ code.T) / 2 + np.eye(classes) * bits
        if gaps.min() > width and (abs(code.sum(0)) < classes).all():
            best, width = code, gaps.min()
    return best


@dataclass
class Model:
    names: list[str]
    code: np.ndarray  # languages x bits
    table: np.ndarray  # buckets x bits
    bias: np.ndarray
    weight: np.ndarray  # languages x bits, rows sum to 1

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Texts x languages: softmax of the negative weighted losses."""
        loss = np.stack([np.logaddexp(0, -margins * c) @ w for c, w in zip(self.code, self.weight, strict=True)], 1)
        loss = np.exp(4 * (loss.min(1, keepdims=True) - loss))
        return loss / loss.sum(1, keepdims=True)

    def predict(self, texts: list[str | None], margin: float = 0.2) -> list[tuple[str, float, bool]]:
        if not self.names:
            return [("und", 0.0, True)] * len(texts)
        sums, counts = document_sums([t and t.lower() for t in texts], self.table, LOW, HIGH, BITS, False)
        share = self.decode(sums / np.maximum(counts, 1)[:, None] + self.bias)
        order = np.sort(share, 1)
        second = order[:, -2] if len(self.names) > 1 else np.zeros(len(texts))
        best = share.argmax(1)
        return [
            (self.names[b], float(top), bool(top - next_ < margin)) if t and _LETTER.search(t) else ("und", 0.0, True)
            for t, b, top, next_ in zip(texts, best, order[:, -1], second, strict=True)
        ]


def train(names: list[str], examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, rate: float = 40.0, seed: int = 3) -> Model:
    """All bits' classifiers together: one gradient step updates the row of each n-gram for every bit."""
    code = codewords(len(names))
    examples = [e for e in examples if len(e[0])]
    table, bias = np.zeros((1 << BITS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    uniform = np.full(code.shape, 1 / code.shape[1])
    if len(names) < 2 or not examples:
        return Model(names, code, table, bias, uniform)
    rng = np.random.default_rng(seed)
    parts = [(u, (n / n.sum()).astype(np.float32), y) for u, n, y in examples]
    steps, at = epochs * len(parts), 0
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            u, share, y = parts[k]
            z = share @ table[u] + bias
            pull = (code[y] / (1 + np.exp(code[y] * z))).astype(np.float32) * (1 - at / steps)
            table[u] += rate * share[:, None] * pull
            bias += 0.05 * pull
            at += 1
    right, seen = np.zeros(code.shape), np.zeros(len(names))
    for u, share, y in parts:
        right[y] += (share @ table[u] + bias) * code[y] > 0
        seen[y] += 1
    if not (np.isfinite(table).all() and np.isfinite(bias).all()):
        raise FloatingPointError("the training diverged")
    weight = (right + 1) / (seen[:, None] + 2)
    return Model(names, code, table, bias, weight / weight.sum(1, keepdims=True))


def fit(docs: DataFrame, per_language: int = 1500, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Train on about ``per_language`` documents of each language outside the held-out fold, on their whole texts."""
    bound_batches(docs.sparkSession)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id))
    known = known.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("y"))
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row per language
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(per_language / n)).otherwise(share)
    # a hash of id and text below the language's sampling share; the limit only meets rows that repeat thousands of times
    picked = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share * (1 << 30))

    def task(batches):
        for batch in sliced(batches, 1):
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            found = [feature_counts(t.lower(), LOW, HIGH, BITS, False) for _, t, _ in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array([str(r[0]) for r in rows], pa.string()),
                    "y": pa.array([r[2] for r in rows], pa.string()),
                    "u": pa.array([u.tobytes() for u, _ in found], pa.binary()),
                    "n": pa.array([n.tobytes() for _, n in found], pa.binary()),
                }
            )

    table = picked.mapInArrow(task, "id string, y string, u binary, n binary").limit(2 * per_language * max(len(sizes), 1)).toArrow()
    rows = sorted(zip(*(table[c].to_pylist() for c in ("id", "y", "u", "n")), strict=True))
    names = sorted(sizes)
    del table
    model = train(names, [(np.frombuffer(u, np.int32), np.frombuffer(n, np.int32), names.index(y)) for _, y, u, n in rows])
    del rows
    release_memory()  # of the driver
    return model


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", margin: float = 0.2) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, ambiguous."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size per language
    slim = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind, arrow = id_type(slim, "doc_id")

    def task(batches):
        for batch in sliced(batches, 2):
            found = sent.value.predict(batch.column(2).to_pylist(), margin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(arrow),
                    batch.column(1),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return slim.mapInArrow(task, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
