"""Fill-in-middle transformation of whole texts; cuts are found in a compressed boundary set.

The places where a text may be cut are byte offsets, held like a Roaring bitmap: one container
per 2^16 offsets, each the smallest of a sorted array, a bitmap and a list of runs, next to the
number of boundaries before it. A cut after ``k`` units is the ``k``-th boundary: a binary
search over those cumulative cardinalities finds the container, a local select the offset.
ASCII text is one run per container, other scripts use arrays and bitmaps.

A text becomes one of three forms, decided by a hash of its id:

* ``plain``: the text as it is (empty text, text that holds a mark, or by chance),
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle,
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

Null texts are empty; a null id is hashed as the word ``null``; repeated ids are handled row
by row and get the same random numbers; an empty table gives an empty result. Only the id and
the text are read, so other columns cannot clash. Bytes that are no UTF-8 count as part of the
character before them. The work of a task is one narrow pass, bounded by one text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.llm.storage import small_batches

PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = b"<P>", b"<S>", b"<M>"
CONTAINER_BITS = 16
CONTAINER = 1 << CONTAINER_BITS


class ArrayContainer:
    """Few scattered values: a sorted array."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)
        self.cardinality = len(values)

    @staticmethod
    def size(values: np.ndarray, n_runs: int) -> int:
        return 2 * len(values)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """Many scattered values: one bit each, with the ones before every 64-bit word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(CONTAINER, np.uint8)
        bits[values] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.cardinality = int(self.before[-1])

    @staticmethod
    def size(values: np.ndarray, n_runs: int) -> int:
        return CONTAINER // 8

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # drop the lowest one
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """Consecutive values: first value of each run, with the values before it."""

    def __init__(self, values: np.ndarray):
        first = np.flatnonzero(np.diff(values, prepend=-2) != 1)
        self.starts = values[first].astype(np.uint16)
        self.before = np.append(first, len(values))
        self.cardinality = len(values)

    @staticmethod
    def size(values: np.ndarray, n_runs: int) -> int:
        return 4 * n_runs

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


KINDS = (RunContainer, ArrayContainer, BitmapContainer)


class BoundarySet:
    """An immutable set of offsets with rank order: ``select(k)`` is the k-th smallest."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` are distinct, ascending and not negative."""
        high = offsets >> CONTAINER_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first]
        self.containers = []
        for a, b in zip(first, [*first[1:], len(offsets)]):
            low = offsets[a:b] & (CONTAINER - 1)
            n_runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
            kind = min(KINDS, key=lambda c: c.size(low, n_runs))
            self.containers.append(kind(low))
        self.before = np.append(first, len(offsets))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << CONTAINER_BITS) + self.containers[at].select(k - int(self.before[at]))


def boundaries(data: np.ndarray, unit: str) -> BoundarySet:
    """Offsets where a unit starts, and the end of the text: ``n`` units give ``n + 1`` offsets.

    ``character``: every code point. ``word``: a run of ASCII white space belongs to the word
    before it. ``line``: up to and including a line feed.
    """
    if unit == "character":
        starts = (data & 0xC0) != 0x80
    else:
        ends = np.zeros(len(data), bool)
        if unit == "word":
            space = (data == 32) | ((data >= 9) & (data <= 13))
            ends[1:] = space[:-1] & ~space[1:]
        elif unit == "line":
            ends[1:] = data[:-1] == 10
        else:
            raise ValueError(f"unknown unit {unit}")
        starts = ends
    if len(starts):
        starts[0] = True
    return BoundarySet(np.append(np.flatnonzero(starts), len(data)))


def draws(key: str, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    text = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(text[8 * i:8 * i + 8], 16) for i in range(4)]


def characters(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def rearrange(data: bytes, key: str, unit: str, seed: int, rate: int, suffix_first: int) -> tuple:
    """(units, form, characters of the prefix, of the middle, output) of one text."""
    cuts = boundaries(np.frombuffer(data, np.uint8).copy(), unit)
    n = len(cuts) - 1
    h1, h2, h3, h4 = draws(key, seed)
    if n == 0 or h3 % 100 >= rate or any(mark in data for mark in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)):
        return n, "plain", None, None, data
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, end = cuts.select(low), cuts.select(high)
    prefix, middle, suffix = data[:start], data[start:end], data[end:]
    sizes = (low, high - low) if unit == "character" else (characters(prefix), characters(middle))
    if h4 % 100 < suffix_first:
        return n, "spm", *sizes, b"".join((SUFFIX_MARK, suffix, PREFIX_MARK, prefix, MIDDLE_MARK, middle))
    return n, "psm", *sizes, b"".join((PREFIX_MARK, prefix, SUFFIX_MARK, suffix, MIDDLE_MARK, middle))


def transform(docs: DataFrame, unit: str = "character", seed: int = 1, rate: int = 90,
              suffix_first: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every whole text.

    ``rate`` per cent of the texts are rearranged, ``suffix_first`` per cent of those with the
    suffix in front. ``n`` counts units; the two sizes are in code points, null for ``plain``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if unit not in ("character", "word", "line"):
        raise ValueError(f"unknown unit {unit}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [rearrange(text or b"", "null" if key is None else str(key), unit, seed, rate, suffix_first)
                     for key, text in zip(ids.to_pylist(), texts)]
            n, form, prefix, middle, output = zip(*found) if found else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The exact text behind an output; its parts hold no marks, so the first of each counts."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    prefix, suffix, middle = (m.decode() for m in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK))
    second = F.when(form == "psm", F.instr(output, suffix)).otherwise(F.instr(output, prefix))
    last = F.instr(output, middle)
    one = F.substring(output, F.lit(4), second - 4)
    two = F.substring(output, second + 3, last - second - 3)
    end = F.substring(output, last + 3, F.length(output))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(one, end, two))
            .otherwise(F.concat(two, end, one)))


def digests(rows: DataFrame) -> DataFrame:
    """Outputs replaced by their digest and that of the text restored from them."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))
