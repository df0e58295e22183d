"""Toxicity by logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features of a text are the words, pairs of neighbours and pairs with one word between, each
hashed to one of 2^20 coordinates and counted once per text. Every coordinate has its own
learning rate; the L1 term leaves exact zeros, so the trained weights are a short list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablesmith.llm.labelled import remainder, sample
from tablesmith.llm.storage import small_batches
from tablesmith.llm.words import GOLDEN, MIX_1, WordHashes, mix, plain_words

BITS = 20


def features(hashes: np.ndarray) -> np.ndarray:
    """Coordinates of all words, bigrams and skip-grams, in text order and with repeats."""
    parts = [mix(hashes)]
    if len(hashes) > 1:
        parts.append(mix(hashes[:-1] * GOLDEN + hashes[1:]))
    if len(hashes) > 2:
        parts.append(mix(hashes[:-2] * MIX_1 + hashes[2:]))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass(frozen=True)
class Weights:
    """Sparse weights: sorted coordinates, their values, and the intercept."""

    coordinates: np.ndarray
    values: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.coordinates] = self.values
        return table


class Ftrl:
    """Per-coordinate FTRL-proximal learner; coordinate 2^BITS is the intercept, without L1."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrink = np.where(at == 1 << BITS, 0.0, self.l1)
        w = -(z - np.sign(z) * shrink) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= shrink, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient ** 2) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient ** 2


def train(docs: DataFrame, labels: DataFrame, max_documents: int = 12_000, shards: int = 1, epochs: int = 4,
          alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.0) -> Weights:
    """Fit on at most about ``max_documents`` labelled training documents (a hash sample).

    The sample is dealt to ``shards`` by a hash of the id; each shard is one group of bounded
    size, trained in the order of a second hash, and the shards' weights are averaged. All of
    it is a function of the rows, whatever the partitioning. Without labels all weights are 0.
    """
    rows = sample(docs, labels, "toxic", remainder(F.col("doc_id"), 5) != 0, max_documents, 10)
    rows = rows.select(F.pmod(F.xxhash64("key", F.lit(11)), F.lit(shards)).alias("shard"),
                       F.xxhash64("key", F.lit(12)).alias("turn"), "text", "label")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        group = group.sort_values(["turn", "text"])
        ready = [(np.append(np.unique(features(hashes.of(plain_words(t)))), 1 << BITS), y)
                 for t, y in zip(group["text"], group["label"])]
        learner = Ftrl(alpha, beta, l1, l2)
        for _ in range(epochs):
            for at, label in ready:
                learner.learn(at, label)
        used = np.append(np.flatnonzero(np.abs(learner.z[:-1]) > l1), 1 << BITS)
        return pd.DataFrame({"at": used, "w": learner.weights(used)})

    found = (rows.groupBy("shard").applyInPandas(fit, "at long, w double")
             .groupBy("at").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).toArrow())
    at, w = found.column("at").to_numpy(), found.column("w").to_numpy()
    used = int(found.column("n").to_numpy().max()) if len(at) else 1
    order = np.argsort(at)
    at, w = at[order], w[order] / used
    inner = at < 1 << BITS
    return Weights(at[inner].astype(np.int32), w[inner].astype(np.float32), float(w[~inner].sum()))


def score(docs: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text only.

    Null, empty and wordless texts get the score of the intercept. Repeated ids are scored
    row by row; a null id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes, base = shared.value.dense(), WordHashes(), shared.value.intercept
        for batch in batches:
            margins = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column("text")):
                at = features(hashes.of(plain_words(text.as_py() or "")))
                at = np.unique(at[table[at] != 0])
                margins[i] = base + table[at].sum(dtype=np.float64)
            sure = 1 / (1 + np.exp(-np.clip(margins, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(sure),
                 pa.array((sure >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return small_batches(docs).select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))
