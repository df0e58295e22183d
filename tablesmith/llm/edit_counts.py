"""Token counts that follow edits: a segment tree of counts over the pre-tokens of each document.

A leaf is a run of whole pre-tokens of about ``LEAF`` characters; it ends where ASCII white
space follows a character that is no white space, and there no token of any text can cross.
Inner nodes are sums. An edit re-encodes the leaves that it touches, widened until both ends
are such places in the new text again, and only the sums above those leaves change.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablesmith.llm.byte_bpe import OTHER_SPACE, Codec, codec_of
from tablesmith.llm.storage import small_batches

LEAF = 512
ASCII_SPACE = " \t\n\r\x0b\x0c"
SAFE = re.compile(r"(?<![\s" + OTHER_SPACE.pattern[1:-1] + r"])[ \t\n\r\x0b\x0c]")

# What the redaction edits look for (own choice): mail addresses, long hex strings, long digit runs;
# first a pattern that every text with such a span holds and that is quick to look for.
REDACTIONS = [(re.compile("@"), re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<mail>"),
              (re.compile(r"[0-9a-f]{32}"), re.compile(r"\b[0-9a-f]{32,}\b"), "<secret>"),
              (re.compile(r"\d"), re.compile(r"\+?\d(?:[ ().-]{0,2}\d){6,}"), "<number>")]

TREE = "leaves array<int>, tree array<int>"
EDIT = "array<struct<at:int,size:int,text:string>>"


def is_safe(text: str, at: int) -> bool:
    """Whether no token can cross position ``at``."""
    return (at <= 0 or at >= len(text)
            or text[at] in ASCII_SPACE and not (text[at - 1].isspace() or OTHER_SPACE.match(text[at - 1])))


def cut(text: str) -> list[str]:
    """The text in leaves."""
    out, start = [], 0
    while start < len(text):
        found = SAFE.search(text, start + LEAF) if start + LEAF < len(text) else None
        end = found.start() if found else len(text)
        out.append(text[start:end])
        start = end
    return out


def sums(counts: list[int]) -> list[int]:
    """Heap-ordered tree: node i has children 2i and 2i + 1, the root is 1, leaves come last."""
    n = 1 << max(0, len(counts) - 1).bit_length()
    level = np.zeros(n, np.int64)
    level[:len(counts)] = counts
    levels = [level]
    while len(level) > 1:
        level = level.reshape(-1, 2).sum(1)
        levels.append(level)
    return [0, *np.concatenate(levels[::-1]).tolist()]


def update(text: str, leaves: list[int], tree: list[int], edits: list[dict], codec: Codec):
    """(new text, new leaves, new tree, characters encoded) after non-overlapping edits.

    An edit replaces ``size`` characters from ``at`` (positions in the old text) by ``text``.
    Edits beyond the text are clipped; one that overlaps an earlier one is ignored.
    """
    bounds = np.concatenate([[0], np.cumsum(leaves)]).astype(int)
    first_leaf = len(tree) // 2
    counts = tree[first_leaf:first_leaf + len(leaves)]
    pieces, regions, old, new = [], [], 0, 0
    for e in sorted(edits, key=lambda e: (e["at"], e["size"])):
        at = min(max(e["at"], 0), len(text))
        end = min(at + max(e["size"], 0), len(text))
        if at < old:
            continue
        inserted = e["text"] or ""
        pieces += [text[old:at], inserted]
        new += at - old
        regions.append([at, end, new, new + len(inserted)])
        new += len(inserted)
        old = end
    pieces.append(text[old:])
    result = "".join(pieces)
    if not regions:
        return text, leaves, tree, 0
    # ranges of old leaves to replace; their ends lie strictly outside all edits
    last, ends = len(leaves), np.array([end for _, end, _, _ in regions])
    moved = np.array([0, *[new_end - end for _, end, _, new_end in regions]])

    def place(leaf: int) -> int:
        """Where the start of an old leaf lies in the new text."""
        return int(bounds[leaf] + moved[np.searchsorted(ends, bounds[leaf], "left")])

    spans = [[max(0, int(np.searchsorted(bounds, at, "left")) - 1), min(last, int(np.searchsorted(bounds, end, "right")))]
             for at, end, _, _ in regions]
    widened = True
    while widened:
        merged = []
        for span in spans:
            if merged and span[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], span[1])
            else:
                merged.append(span)
        spans, widened = merged, False
        for span in spans:
            if span[0] > 0 and not is_safe(result, place(span[0])):
                span[0], widened = span[0] - 1, True
            if span[1] < last and not is_safe(result, place(span[1])):
                span[1], widened = span[1] + 1, True
    new_leaves, new_counts, at_leaf, encoded, replaced = [], [], 0, 0, []
    same = True
    for a, b in spans:
        new_leaves += leaves[at_leaf:a]
        new_counts += counts[at_leaf:a]
        region = result[place(a) if a else 0:place(b) if b < last else len(result)]
        parts = cut(region)
        same = same and len(parts) == b - a
        replaced += range(len(new_leaves), len(new_leaves) + len(parts))
        new_leaves += map(len, parts)
        new_counts += map(len, codec.encode(parts))
        encoded += len(region)
        at_leaf = b
    new_leaves += leaves[at_leaf:]
    new_counts += counts[at_leaf:]
    if not same:  # leaves came or went: sums anew, nothing else is encoded
        return result, new_leaves, sums(new_counts), encoded
    tree = list(tree)
    for i in replaced:
        node, change = first_leaf + i, new_counts[i] - tree[first_leaf + i]
        while change and node:
            tree[node] += change
            node //= 2
    return result, new_leaves, tree, encoded


def _map(rows: DataFrame, run, dropped: list[str], schema: str) -> DataFrame:
    added = [part.split()[0] for part in re.split(r", (?=\w+ )", schema)]
    rows = rows.select(*[c for c in rows.columns if c in dropped or c not in added])
    kept = [c for c in rows.columns if c not in added]
    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *run(batch)], [*kept, *added])

    return small_batches(rows).mapInArrow(batches, ", ".join([*fields, schema]))


def build(docs: DataFrame, spec: dict) -> DataFrame:
    """``docs`` with ``leaves`` (characters of each) and ``tree`` (sums; tree[1] is the count).

    Null and empty texts have no leaves and the tree [0, 0].
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = codec_of(shared)
        parts = [cut(t or "") for t in batch.column("text").to_pylist()]
        counts = iter(codec.encode([leaf for leaves in parts for leaf in leaves]))
        trees = [sums([len(next(counts)) for _ in leaves]) for leaves in parts]
        return [pa.array([list(map(len, p)) for p in parts], pa.list_(pa.int32())),
                pa.array(trees, pa.list_(pa.int32()))]

    return _map(docs, run, [], TREE)


def redactions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``edits`` that replace personal data and secrets in ``text``; never null."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("text", pa.string())]))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for text in batch.column("text").to_pylist():
            found = [(m.start(), m.end(), new) for sign, pattern, new in REDACTIONS if text and sign.search(text)
                     for m in pattern.finditer(text)]
            edits, end = [], 0
            for a, b, new in sorted(found):
                if a >= end:
                    edits.append({"at": a, "size": b - a, "text": new})
                    end = b
            out.append(edits)
        return [pa.array(out, kind)]

    return _map(rows, run, [], f"edits {EDIT}")


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Bring a table of edits (doc_id, at, size, text) to the documents; no edit gives a null list."""
    lists = (edits.where(F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.collect_list(F.struct(F.col("at").cast("int").alias("at"), F.col("size").cast("int").alias("size"),
                                                            "text")).alias("edits")))
    return trees.drop("edits").join(lists, "doc_id", "left")


def apply_edits(rows: DataFrame, spec: dict) -> DataFrame:
    """Apply ``edits`` to (text, leaves, tree); the three columns are replaced by the new state.

    Adds n_before, n_tokens, n_edits, chars (of the new text) and chars_encoded (what had to
    be encoded for it). A null text counts as empty, a null list of edits as none.
    """
    shared = rows.sparkSession.sparkContext.broadcast(spec)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = codec_of(shared)
        out = []
        for text, leaves, tree, edits in zip(*[batch.column(c).to_pylist() for c in ("text", "leaves", "tree", "edits")]):
            new = update(text or "", leaves, tree, edits or [], codec)
            out.append([*new[:3], tree[1], new[2][1], len(edits or []), len(new[0]), new[3]])
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 5]
        return [pa.array(c, k) for c, k in zip(columns, kinds)]

    return _map(rows, run, ["text", "leaves", "tree"],
                f"text string, {TREE}, n_before long, n_tokens long, n_edits long, chars long, chars_encoded long")
