"""Language identification by prediction by partial matching.

One variable-order byte context tree is shared by all languages; every node holds, for
each language, the counts of the bytes that followed. Escape method C: a context seen N times
with q different successors gives c / (N + q) to a successor seen c times and q / (N + q) to
leaving it for the next shorter context. Statistics are frozen after training, so the cost in
bits of a byte in a node is a constant, and the code length of a text under every language is
a sum over its distinct runs of four bytes of count times cost, found in sorted tables. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.llm.storage import small_batches

UNKNOWN = "und"
ORDER = 3
PAD = b"\n" * ORDER
SLICE = 1 << 19
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Statistics:
    """Counts of a trained model: ``grams`` maps (order, language) to packed grams and counts."""

    langs: list[str]
    rows: np.ndarray  # columns: language, order, gram of order + 1 bytes, count


def in_training(key: Column) -> Column:
    """Rows whose crc32 of the key's text modulo 5 is not 0."""
    return F.crc32(key.cast("string").cast("binary")) % 5 != 0


def keep_rate(key: Column, rate: Column, salt: int) -> Column:
    """A hash sample of rows, the same in every run and partitioning."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1_000_000)) < rate * 1_000_000


def _packed(codes: np.ndarray, order: int) -> np.ndarray:
    """Every gram of order + 1 bytes that ends at a byte of the text, packed in one number."""
    out = np.zeros(len(codes) - ORDER, np.int64)
    for back in range(order, -1, -1):
        out = (out << 8) | codes[ORDER - back:len(codes) - back]
    return out


def _count_grams(langs: list[str]):
    index = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 128) for whole in batches for at in range(0, whole.num_rows, 128)):
            held: dict[tuple[int, int], list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = np.frombuffer(PAD + text.encode("utf-8", "surrogatepass"), np.uint8)
                for order in range(ORDER + 1):
                    held.setdefault((index[lang], order), []).append(_packed(data, order).astype(np.uint32))
            for (lang, order), parts in held.items():
                grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), lang, np.int32)), pa.array(np.full(len(grams), order, np.int32)),
                     pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    ["l", "o", "gram", "c"])

    return count


def train(docs: DataFrame, max_documents: int = 1500) -> Statistics:
    """Statistics from (lang, text) of the training rows.

    Per language about ``max_documents`` whole documents are used, drawn by a hash of the id
    (that is the documented bound of the sample; it also bounds what reaches the driver).
    """
    rows = docs.where(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & (F.col("lang") != UNKNOWN))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Statistics([], np.zeros((0, 4), np.int64))
    rates = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, max_documents / n)))])
    sample = rows.where(keep_rate(F.col("doc_id"), F.element_at(rates, F.col("lang")), 2)).select("lang", "text")
    grams = (small_batches(sample).mapInArrow(_count_grams(langs), "l int, o int, gram long, c long")
             .groupBy("l", "o", "gram").agg(F.sum("c").alias("c")).toArrow())
    columns = [grams.column(n).to_numpy() for n in ("l", "o", "gram", "c")]
    return Statistics(langs, np.stack(columns, 1).astype(np.int64))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted ``keys``, and where these are."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return there, at[there]


class Coder:
    """Cost tables of the frozen tree, with all contexts of the sample and all 256 bytes.

    For each order the sorted grams seen in any language with the cost of their last byte, and
    the sorted contexts with the cost of leaving them, one column per language. A language that
    lacks a context goes on to the shorter one for nothing; below order 0 a byte costs 8 bits.
    """

    def __init__(self, s: Statistics):
        self.n_langs = len(s.langs)
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for order in range(ORDER + 1):
            lang, _, gram, count = s.rows[s.rows[:, 1] == order].T
            grams, at = np.unique(gram.astype(np.uint32), return_inverse=True)
            seen = np.zeros((len(grams), self.n_langs), np.float32)
            seen[at, lang] = count
            contexts, start, size = np.unique(grams >> np.uint32(8), return_index=True, return_counts=True)
            total = np.add.reduceat(seen, start) if len(start) else seen
            kinds = np.add.reduceat(seen > 0, start, dtype=np.float32) if len(start) else seen
            whole = np.maximum(total + kinds, 1)
            escapes = -np.log2(np.maximum(kinds, 1) / whole)  # 0 where a language lacks the context
            costs = self.costs(grams, order - 1)
            costs += np.repeat(escapes, size, axis=0)
            known = seen > 0
            costs[known] = -np.log2(seen[known] / np.repeat(whole, size, axis=0)[known])
            self.tables.append((grams, costs, contexts, escapes))

    def costs(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Bits of the last byte of each gram after the ``order`` bytes before it, under every language."""
        if order < 0:
            return np.full((len(grams), self.n_langs), 8.0, np.float32)
        known, bits, contexts, escapes = self.tables[order]
        grams = grams & np.uint32((1 << (8 * order + 8)) - 1)
        there, at = _find(known, grams)
        out = np.empty((len(grams), self.n_langs), np.float32)
        out[there] = bits[at]
        if len(at) < len(grams):
            rest = grams[~there]
            below = self.costs(rest, order - 1)
            left, at = _find(contexts, rest >> np.uint32(8))
            below[left] += escapes[at]
            out[~there] = below
        return out

    def lengths(self, text: str) -> np.ndarray:
        """Exact code length in bits of the whole text under every language."""
        data = np.frombuffer(PAD + text.encode("utf-8", "surrogatepass"), np.uint8)
        total = np.zeros(self.n_langs)
        for at in range(0, len(data) - ORDER, SLICE):
            grams, count = np.unique(_packed(data[at:at + SLICE + ORDER], ORDER).astype(np.uint32), return_counts=True)
            total += count @ self.costs(grams, ORDER).astype(np.float64)
        return total


_CODERS: list[tuple[Statistics, Coder]] = []  # that of the running task; it holds the statistics it was made from


def _coder(shared) -> Coder | None:
    statistics = shared.value
    if not statistics.langs:
        return None
    if not _CODERS or _CODERS[0][0] is not statistics:
        _CODERS[:] = [(statistics, Coder(statistics))]
    return _CODERS[0][1]


def _verdicts(coder: Coder | None, langs: list[str], texts: pa.Array) -> tuple[list[str], list[float]]:
    best, sure = [], []
    for text in texts:
        text = text.as_py()
        if coder is None or text is None or not LETTER.search(text):
            best.append(UNKNOWN)
            sure.append(0.0)
            continue
        bits = coder.lengths(text)
        winner = int(bits.argmin())
        best.append(langs[winner])
        sure.append(float(1.0 / np.exp2(np.maximum(bits[winner] - bits, -1000.0)).sum()))
    return best, sure


def predict(docs: DataFrame, model: Statistics) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text decides.

    ``score`` is the share of the winner in 2^-bits over all languages. A null text, a text
    without a letter and an untrained model give ``und`` with score 0; equal code lengths go
    to the first language by name. Repeated ids are scored row by row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held_out = F.coalesce(~in_training(F.col("doc_id")), F.lit(False))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            best, sure = _verdicts(coder, shared.value.langs, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(sure, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
        _CODERS.clear()  # a worker goes on to other work after its task

    return small_batches(docs).select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the training rows of ``docs`` and predict all of them."""
    return predict(docs, train(docs.select("doc_id", "lang", "text"), **options))


def accepted(docs: DataFrame, model: Statistics, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not ``und``, score at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            best, sure = _verdicts(coder, shared.value.langs, batch.column("text"))
            yield batch.filter(pa.array([b != UNKNOWN and s >= least for b, s in zip(best, sure)], pa.bool_()))
        _CODERS.clear()

    return small_batches(docs).mapInArrow(run, docs.schema)
