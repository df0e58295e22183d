"""Quality by compression: a zstandard dictionary of good text against one of bad text.

A text is cut into pieces of at most ``PIECE`` bytes and every piece is compressed with both
dictionaries. The difference of the two total sizes per byte says which kind of text it
resembles; a logistic curve fitted on labelled rows that built no dictionary turns it into a
probability. A few bytes say little, so the log-odds of a text of n bytes move from the share
of good labels to the curve by n / (n + ``SHORT``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tablesmith.llm.labelled import remainder, sample
from tablesmith.llm.storage import saved, small_batches

PIECE = 1024
SHORT = 64


def pieces(text: str | None) -> list[bytes]:
    """Even cuts of the whole text, no piece above PIECE bytes."""
    data = (text or "").encode("utf-8", "surrogatepass")
    count = -(-len(data) // PIECE)
    cuts = [len(data) * i // count for i in range(count + 1)] if count else []
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Quality:
    """Two dictionaries (empty without labelled text of a kind) and the calibration curve."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float
    prior: float
    level: int

    def probability(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        weight = sizes / (sizes + SHORT)
        odds = self.prior + weight * (self.slope * x + self.intercept - self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


class Compressors:
    def __init__(self, good: bytes, bad: bytes, level: int):
        frame = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        parameters = zstandard.ZstdCompressionParameters.from_level(level, **frame)

        def packer(data: bytes) -> zstandard.ZstdCompressor:
            words = zstandard.ZstdCompressionDict(data) if data else None
            if words:
                words.precompute_compress(compression_params=parameters)
            return zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)

        self.good, self.bad = packer(good), packer(bad)

    def difference(self, text: str | None) -> tuple[float, int]:
        """((size with the bad dictionary - size with the good one) / bytes, bytes); 0, 0 for no text."""
        parts = pieces(text)
        if not parts:
            return 0.0, 0
        good, bad, size = self.good.compress, self.bad.compress, sum(map(len, parts))
        return sum(len(bad(p)) - len(good(p)) for p in parts) / size, size


def _dictionary(size: int, sample_bytes: int):
    """Trains the dictionary of one label from pieces of its (bounded) sample in hash order."""
    def train(group: pd.DataFrame) -> pd.DataFrame:
        parts, total = [], 0
        for text in group.sort_values(["turn", "text"])["text"]:
            for part in pieces(text):
                if total < sample_bytes:
                    parts.append(part)
                    total += len(part)
        try:
            data = zstandard.train_dictionary(min(size, max(256, total // 8)), parts).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too little text for the trainer: the text itself
            data = b"".join(parts)[:size]
        return pd.DataFrame({"label": [int(group["label"].iloc[0])], "data": [data]})

    return train


def _logistic(x: np.ndarray, y: np.ndarray, weight: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic curve by Newton steps with a slight penalty on the slope."""
    scale = float(x.std()) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], 1)
    beta, penalty = np.zeros(2), np.array([weight * max(1, len(x)), 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, max_documents: int = 12_000, dictionary_bytes: int = 65_536,
          sample_bytes: int = 8_000_000, level: int = 3) -> Quality:
    """Fit on at most about ``max_documents`` labelled training documents (a hash sample).

    Two thirds build the dictionaries, ``sample_bytes`` of text for each at most (both bounds
    are parameters); the other third, whole texts, fits the curve. With one kind of label only,
    or none, the curve is the share of good labels at every difference.
    """
    rows = sample(docs, labels, "quality", remainder(F.col("doc_id"), 4) != 2, max_documents, 6)
    rows = saved(rows.select("text", "label", F.xxhash64("key", F.lit(7)).alias("turn"),
                             (F.pmod(F.xxhash64("key", F.lit(8)), F.lit(3)) == 0).alias("curve")), "quality-sample")
    built = {r["label"]: bytes(r["data"]) for r in rows.where("not curve").groupBy("label").applyInPandas(
        _dictionary(dictionary_bytes, sample_bytes), "label int, data binary").collect()}
    good, bad = built.get(1, b""), built.get(0, b"")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = Compressors(good, bad, level)
        for batch in batches:
            x = [packers.difference(t.as_py())[0] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column("label")], ["x", "y"])

    points = small_batches(rows).where("curve").select("text", "label").mapInArrow(measure, "x double, y int").toArrow()
    x, y = points.column("x").to_numpy(), points.column("y").to_numpy().astype(float)
    if not len(x):
        return Quality(good, bad, 0.0, 0.0, 0.0, level)
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    if not (good and bad) or y.min() == y.max():
        return Quality(good, bad, 0.0, prior, prior, level)
    return Quality(good, bad, *_logistic(x, y), prior, level)


def score(docs: DataFrame, model: Quality, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text only.

    Null and empty texts get the share of good labels. Repeated ids are scored row by row; a
    null id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        packers = Compressors(m.good, m.bad, m.level)
        for batch in batches:
            found = np.array([packers.difference(t.as_py()) for t in batch.column("text")], float).reshape(-1, 2)
            sure = m.probability(found[:, 0], found[:, 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(sure),
                 pa.array((sure >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return small_batches(docs).select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Quality, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        packers = Compressors(m.good, m.bad, m.level)
        for batch in batches:
            found = np.array([packers.difference(t.as_py()) for t in batch.column("text")], float).reshape(-1, 2)
            yield batch.filter(pa.array(m.probability(found[:, 0], found[:, 1]) >= threshold))

    return small_batches(docs).mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))
