"""Quality classifier on supervised subword embeddings.

Every word, and every character n-gram of ``<word>``, owns a learned vector in a hashed table; a
document is the average of its vectors, followed by a softmax.  A word that repeats the word before
it adds one more learned vector.  Training is numpy stochastic gradient descent on the driver, over a
bounded sample of labelled rows (``per_class`` expected documents of each label, whose whole texts are read).
Scoring reads whole texts: the softmax of an average is linear in the
vectors, so each vector is folded to one number beforehand and documents are scored in one pass
without a shuffle.

Defined results
---------------
* null, empty and white-space-only texts get the score of a document without words;
* every input row is scored, null ids (never held out) and repeated rows included;
* of several labels of one document the lowest counts, null labels do not count;
* without labelled rows of both classes the score is the share of label 1 (0.5 without any label);
* an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm.common import bound_batches, held_out, id_type, release_memory, sliced
from symcube.llm.features import document_sums, feature_counts, repeats

LOW, HIGH, BITS = 3, 4, 18
REPEAT = 0  # the bucket of the repeated-word vector


def _extra(index, docs):
    return REPEAT, repeats(index, docs)


@dataclass
class Model:
    """One number per bucket (its vector times the difference of the softmax rows), and the bias."""

    table: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        sums, counts = document_sums(texts, self.table[:, None], LOW, HIGH, BITS, True, _extra)
        z = sums[:, 0] / np.maximum(counts, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 12, epochs: int = 5, rate: float = 0.2, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, counts, label); both classes weigh the same."""
    examples = [e for e in examples if len(e[0])]
    ones = sum(y for *_, y in examples)
    if not 0 < ones < len(examples):
        share = (ones + 0.5) / (len(examples) + 1)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    weight = (len(examples) / 2 / (len(examples) - ones), len(examples) / 2 / ones)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    out, bias = rng.normal(0, 0.5, (2, dim)).astype(np.float32), np.zeros(2, np.float32)
    steps, at = epochs * len(examples), 0
    parts = [(u, (n / n.sum()).astype(np.float32), y) for u, n, y in examples]
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            u, share, y = parts[k]
            rows = vectors[u]
            mean = share @ rows
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= rate * weight[y] * (1 - at / steps)
            at += 1
            # a feature's own share of the average is tiny, so vectors move by its square root
            vectors[u] = rows - np.sqrt(share)[:, None] * (p @ out)
            out -= p[:, None] * mean
            bias -= p
    model = Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))
    if not (np.isfinite(model.table).all() and np.isfinite(model.bias)):
        raise FloatingPointError("the training diverged")
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Train on a sample of about ``per_class`` labelled documents of each class outside the held-out fold, on their whole texts."""
    bound_batches(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & ~held_out(doc_id)).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("y"))
    known = known.where("y IN (0, 1) AND id IS NOT NULL")
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(per_class / n)).otherwise(share)
    # a uniform hash of the id below the class's sampling share: about per_class rows of each class
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(picked), "id").select("id", "text", "y")

    def task(batches):
        for batch in sliced(batches, 1):
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            found = [feature_counts(t, LOW, HIGH, BITS, True, _extra) for _, t, _ in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array([str(r[0]) for r in rows], pa.string()),
                    "y": pa.array([r[2] for r in rows], pa.int32()),
                    "u": pa.array([u.tobytes() for u, _ in found], pa.binary()),
                    "n": pa.array([n.tobytes() for _, n in found], pa.binary()),
                }
            )

    table = texts.mapInArrow(task, "id string, y int, u binary, n binary").limit(4 * per_class).toArrow()  # more only if ids repeat
    rows = sorted(zip(*(table[c].to_pylist() for c in ("id", "y", "u", "n")), strict=True))
    del table
    model = train([(np.frombuffer(u, np.int32), np.frombuffer(n, np.int32), y) for _, y, u, n in rows])
    del rows
    release_memory()  # of the driver
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed-size table
    slim = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind, arrow = id_type(slim, "doc_id")

    def task(batches):
        for batch in sliced(batches, 2):
            found = sent.value.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow), batch.column(1), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return slim.mapInArrow(task, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def good(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_memory()
        for column in columns:
            parts = sliced([pa.RecordBatch.from_arrays([column], names=["text"])], 0, keep_caches=True)
            found = [sent.value.score(part.column(0).to_pylist()) for part in parts]
            yield pa.array(np.concatenate(found) >= threshold if found else np.zeros(0, bool))

    # only the texts go to Python; the rows stay where they are
    return docs.where(F.arrow_udf(good, "boolean")(F.col(text).cast("string")))
