"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are runs of ``n`` words that a document shares with a test item. How many documents hold
each of them is counted over all documents; an item is then looked up by its rare seeds:
those that are no more frequent than twice its median one (or ``RARE`` documents), and in any
``WINDOW`` seeds in a row the least frequent. A copied stretch of n + WINDOW - 1 words so always
holds one, however often the item was copied. The words around the seeds are aligned with the
item, so changed, missing and added words only lower the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tablesmith.llm.storage import beside_texts, saved, small_batches
from tablesmith.llm.words import GOLDEN, mix, plain_words

SEED_WORDS = 4
WINDOW = 4
RARE = 10
PASSAGE = 13  # words in a row that are a copy whatever share of the item they are
SLICE_BYTES = 16_000_000  # of benchmark text that is sent to the executors at once
MATCH, MISMATCH, GAP = 1, -1, -1


class Items:
    """Test items of one slice: words as numbers, and where every run of n words occurs."""

    def __init__(self, rows: list[tuple[int, str]], n: int):
        self.n, self.vocabulary, self.words, self.keys = n, {}, [], []
        for key, text in rows:
            words = plain_words(text)
            if len(words) >= n:
                self.keys.append(key)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64))
        grams = [run_hashes(w, n) for w in self.words]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.int64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else flat
        order = np.argsort(flat, kind="stable")
        self.grams, self.item, self.place = flat[order], item[order], place[order]
        self.chosen: list[set[int]] = []


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = mix(total * GOLDEN + words[i:len(words) - n + 1 + i].astype(np.uint64) + np.uint64(1))
    return total.view(np.int64)


def find_windows(words: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, list[int]]]:
    """(item, start, end, seeds) of the stretches of a document that hold seeds of an item."""
    n = items.n
    if len(words) < n:
        return
    known = words >= 0
    whole = np.flatnonzero(np.logical_and.reduce([known[i:len(words) - n + 1 + i] for i in range(n)]))
    if not len(whole):
        return
    runs = run_hashes(np.concatenate([words[p:p + n] for p in whole]), n)[::n] if len(whole) < len(words) // (2 * n) \
        else run_hashes(np.where(known, words, 0), n)[whole]
    low, high = np.searchsorted(items.grams, runs, "left"), np.searchsorted(items.grams, runs, "right")
    count = high - low
    if not count.any():
        return
    at = np.repeat(whole, count)
    entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item = items.item[entry]
    diagonal = at - items.place[entry]
    for i in np.unique(item):
        mine = item == i
        size = len(items.words[i])
        slack = size // 4 + n
        order = np.argsort(diagonal[mine], kind="stable")
        starts, seeds = diagonal[mine][order] - slack, items.grams[entry[mine]][order]
        new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + size + 2 * slack))
        for a, b in zip(new, np.append(new[1:], len(starts))):
            yield int(i), max(0, int(starts[a])), min(len(words), int(starts[b - 1]) + size + 2 * slack), \
                sorted(set(seeds[a:b].tolist()))


def _sweep(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local score and the last aligned positions (i, j)."""
    steps = np.arange(len(b) + 1) * -GAP
    row, best = np.zeros(len(b) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(a):
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(b == word, MATCH, MISMATCH), np.maximum(row[1:] + GAP, 0))
        row = np.maximum.accumulate(new + steps) - steps
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j - 1)
    return best


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int]:
    """Smith-Waterman of two word sequences: score, first and last position in ``a``, then in ``b``."""
    score, i, j = _sweep(a, b)
    if score == 0:
        return 0, 0, -1, 0, -1
    _, back_i, back_j = _sweep(a[i::-1], b[j::-1])
    return score, i - back_i, i, j - back_j, j


def _windows(docs: DataFrame, shared) -> DataFrame:
    """doc_id, item, start, seeds and words (as numbers) of every stretch with seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        number = items.vocabulary.get
        for whole in batches:
            for offset in range(0, whole.num_rows, 2048):
                batch, out = whole.slice(offset, 2048), []
                for row, text in enumerate(batch.column("text")):
                    listed = [number(w, -1) for w in plain_words(text.as_py() or "")]
                    words = np.array(listed, np.int64)
                    for item, start, end, seeds in find_windows(words, items):
                        out.append((row, item, start, seeds, words[start:end].astype(np.int32)))
                rows, item, start, seeds, words = zip(*out) if out else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(item, pa.int32()), pa.array(start, pa.int32()),
                     pa.array(seeds, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))],
                    ["doc_id", "item", "start", "seeds", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, item int, start int, seeds array<long>, words array<int>")


def rare_seeds(frequency: DataFrame, items: Items) -> list[set[int]]:
    """For each item the seeds by which it is looked up (a table of the size of the slice)."""
    spark = frequency.sparkSession
    table = spark.createDataFrame(
        pa.table({"item": pa.array(items.item, pa.int32()), "place": pa.array(items.place, pa.int32()),
                  "seed": pa.array(items.grams, pa.int64())}))
    by_item = Window.partitionBy("item").orderBy("place")
    known = table.join(frequency, "seed", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = F.min("n").over(by_item.rowsBetween(0, WINDOW - 1))
    chosen = (known.withColumn("least", least)
              .withColumn("reached", F.max("least").over(by_item.rowsBetween(1 - WINDOW, 0)))
              .withColumn("usual", F.percentile("n", F.lit(0.5)).over(Window.partitionBy("item")))
              .where("n = reached OR n <= greatest(" + str(RARE) + ", 2 * usual)").select("item", "seed"))
    out: list[set[int]] = [set() for _ in items.keys]
    for item, seed in chosen.distinct().collect():
        out[item].add(seed)
    return out


def _aligned(windows: DataFrame, shared, least: float, passage: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            out = []
            for row, (item, start, seeds, words) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("item", "start", "seeds", "words")])):
                rare = items.chosen[item].intersection(seeds)
                if rare:
                    score, a, b, c, d = align(items.words[item], np.array(words, np.int64))
                    if score >= MATCH * min(least * len(items.words[item]), passage):
                        out.append((row, items.keys[item], score / (MATCH * len(items.words[item])), a, b + 1,
                                    start + c, start + d + 1, len(rare)))
            rows, *columns = zip(*out) if out else [()] * 8
            kinds = [pa.int64(), pa.float64(), *[pa.int32()] * 5]
            names = ["item_id", "score", "item_start", "item_end", "doc_start", "doc_end", "n_seeds"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())),
                                              *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", *names])

    kind = windows.schema["doc_id"].dataType.simpleString()
    return windows.mapInArrow(run, f"doc_id {kind}, item_id long, score double, item_start int, item_end int, "
                                   "doc_start int, doc_end int, n_seeds int")


def overlaps(docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, least: float = 0.5,
             passage: int = PASSAGE) -> DataFrame:
    """The best alignment of each document with each test item that it holds.

    An alignment counts if it scores at least ``least`` of the whole item, or as much as ``passage``
    words in a row, so parts of long items are found too. Columns: doc_id, item_id, score
    (alignment score over that of the whole item, 0 to 1), item_start, item_end, doc_start, doc_end (word positions, end exclusive),
    n_seeds (rare seeds in that stretch). Items are numbered by item_id, equal ids are separate
    items of one id; items of fewer than ``n`` words, null texts and null item ids match nothing.
    The benchmark goes to the executors in slices of ``SLICE_BYTES`` of text, one pass each.
    """
    spark = docs.sparkSession
    tests = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = max(1, math.ceil(size / SLICE_BYTES))
    found = None
    for i in range(n_slices):
        rows = [tuple(r) for r in tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_slices)) == i).collect()]
        items = Items(sorted(rows), n)
        windows = saved(_windows(docs, spark.sparkContext.broadcast(items)), "windows")
        frequency = (windows.select("doc_id", F.explode("seeds").alias("seed")).distinct()
                     .groupBy("seed").agg(F.count(F.lit(1)).alias("n")))
        if items.keys:
            items.chosen = rare_seeds(frequency, items)
        part = _aligned(windows, spark.sparkContext.broadcast(items), least, passage)
        found = part if found is None else found.union(part)
    best = F.struct("score", F.col("n_seeds"), (-F.col("doc_start")).alias("_from"), "item_start", "item_end", "doc_start", "doc_end")
    return (found.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
            .select("doc_id", "item_id", "best.score", "best.item_start", "best.item_end", "best.doc_start", "best.doc_end",
                    "best.n_seeds"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item; rows with a null id stay."""
    leaked = overlaps(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(beside_texts(leaked), "doc_id", "left_anti").select(*docs.columns)
