"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Features are the hashed one- and two-word n-grams of a text, over its lower-cased
words and over the shapes of its words (runs of capitals, small letters, digits
and each mark), as term frequencies of unit length.  Neither labels, language,
source nor ids are features.

The fit uses a bounded, hash-chosen sample of the labelled rows (``SAMPLE``
rows, a parameter).  Shards of it are trained in parallel by FTRL; their
weights are averaged.  The model has ``2 ** BITS`` weights at most, whatever the
corpus; that bound makes its broadcast safe.  Every whole text is scored as a
sparse dot product.

Defined results: a null or empty text has no features and is scored by the bias
alone; repeated rows are scored one by one; without labelled rows all scores are
0.5; labels that are null or refer to no document are ignored.
Very long texts are scored whole; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import written

BITS = 18
SAMPLE = 20_000
SHARDS = 8
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.005, 0.02

#: classes of bytes: capitals, small letters (and all of non-ASCII), digits, spaces; other marks stand for themselves
_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[65:91] = 65
_CLASSES[97:123] = 97
_CLASSES[128:] = 97
_CLASSES[48:58] = 48
_CLASSES[ar.SPACES] = 32


def shape_hashes(words: ar.Words) -> np.ndarray:
    """Fingerprints of the words' shapes, a run of one class counting once."""
    classes = _CLASSES[words.data]
    fresh = np.concatenate(([True], classes[1:] != classes[:-1]))
    fresh[words.start] = True
    rank = np.concatenate(([0], np.cumsum(fresh)))
    sums = ar.prefix_sums(classes[fresh].astype(np.uint64))
    return ar.span_hash(sums, rank[words.start], rank[words.end] - rank[words.start])


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text, values of unit length."""
    cased, lower = ar.Words(texts), ar.Words(texts, lower=True)
    word, shape = lower.hashes(), shape_hashes(cased)
    out = []
    for first, last in zip(cased.first[:-1], cased.first[1:], strict=True):
        w, s = word[first:last], shape[first:last]
        grams = np.concatenate([
            w, ar.mix(w[:-1] * ar.BASE + w[1:]), ar.mix(s + np.uint64(1)), ar.mix(s[:-1] * ar.BASE + s[1:] + np.uint64(2)),
        ])
        slots, counts = np.unique(grams >> np.uint64(64 - BITS), return_counts=True)
        values = np.sqrt(counts)
        out.append((slots.astype(np.int64), values / max(np.linalg.norm(values), 1e-9)))
    return out


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2; slot ``2 ** BITS`` is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        g = (sigmoid(w @ values) - label) * values
        sigma = (np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])) / ALPHA
        self.z[slots] += g - sigma * w
        self.n[slots] += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def with_bias(slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(slots, 1 << BITS), np.append(values, 1.0)


def train(examples: DataFrame) -> DataFrame:
    """slot, weight: the average over the shards of (doc_id, text, label)."""

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("doc_id")
        model, labels = Ftrl(), shard["label"].to_numpy()
        texts = [t.encode() for t in shard["text"].fillna("")]
        rows = [with_bias(*f) for low, high in ar.blocks(texts) for f in features(texts[low:high])]
        order = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in order.permutation(len(rows)):
                model.update(*rows[i], labels[i])
        w = model.weights(slice(None))
        slots = np.flatnonzero(w)
        return pd.DataFrame({"slot": slots, "weight": w[slots] / SHARDS})

    shards = examples.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    fitted = shards.groupBy("shard").applyInPandas(fit, "slot long, weight double")
    return fitted.groupBy("slot").agg(F.sum("weight").alias("weight"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, label of at most about ``sample`` labelled rows, chosen by a hash of the id."""
    marked = (
        labels.where("doc_id is not null and quality is not null").where(usable)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    )
    total = marked.count()
    share = min(1.0, sample / max(total, 1))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    # bounded by the parameter, so the broadcast is safe
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, score of every document."""
    weights = np.zeros((1 << BITS) + 1, np.float32)
    for row in model.toLocalIterator():  # at most 2 ** BITS + 1 rows
        weights[row["slot"]] = row["weight"]
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            texts = ar.text_bytes(batch.column("text"))
            out = [sigmoid(w[slots] @ values + w[-1])
                   for low, high in ar.blocks(texts) for slots, values in features(texts[low:high])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(dot, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; held-out labels are never learnt from."""
    model = written(train(examples(docs, labels, ~held_out(), sample)), "weights")
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
