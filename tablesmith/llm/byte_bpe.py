"""Byte-level BPE with the tokenizers library: encode, decode, offsets.

The rank file of a public tokenizer becomes a vocabulary over characters that stand for bytes
and a merge list; the library merges exactly as the ranks say. White space starts a new
pre-token, so a text falls into chunks (a run of ASCII white space and the run after it) that
are encoded independently. A task encodes each distinct chunk once and keeps the result.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from tablesmith.llm.storage import small_batches

CHUNK = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
# Unicode white space beyond ASCII can join a white-space run; such texts are not cut.
OTHER_SPACE = re.compile("[" + "".join(map(chr, [
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060,
    0x3000, 0xFEFF])) + "]")
GROUP_CHARS = 1 << 21


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself for visible Latin-1, else 256 + i."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in visible}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(visible))
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_tokenizer(ranks: dict[bytes, int]) -> Tokenizer:
    """A library tokenizer whose merges of one pre-token, spelled by ``byte_characters``, follow ``ranks``.

    Any two tokens whose bytes join to a third may merge, at the rank of the third, so every
    cut of every token into two tokens is a merge.
    """
    stand_in = byte_characters()
    spelled = {token: "".join(stand_in[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((spelled[token[:cut]], spelled[token[cut:]]))
    return Tokenizer(models.BPE(vocab={spelled[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True))


class Codec:
    """Encoder and decoder of one worker. Caches are emptied when they reach ``limit`` entries."""

    def __init__(self, spec: dict, limit: int = 300_000):
        self.tokenizer = Tokenizer.from_str(spec["tokenizer"])
        self.pattern = regex.compile(spec["pattern"])
        back = {c: b for b, c in enumerate(byte_characters())}
        self.stand_in = dict(enumerate(byte_characters()))
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for spelled, i in vocabulary.items():
            self.token_bytes[i] = bytes(back[c] for c in spelled)
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)
        self.limit, self.chunks, self.pieces = limit, {}, {}

    def _learn(self, chunks: set[str]) -> None:
        """Encode chunks not seen yet; the library sees each distinct pre-token once."""
        split = {chunk: self.pattern.findall(chunk) for chunk in chunks}
        fresh = [p for p in {p for parts in split.values() for p in parts} if p not in self.pieces]
        if len(self.pieces) + len(fresh) > self.limit:
            self.pieces.clear()
            fresh = list({p for parts in split.values() for p in parts})
        merge, stand_in = self.tokenizer.model.tokenize, self.stand_in
        for piece in fresh:
            ids = [t.id for t in merge(piece.encode("utf-8").decode("latin-1").translate(stand_in))]
            self.pieces[piece] = struct.pack(f"={len(ids)}i", *ids)
        pieces = self.pieces
        for chunk, parts in split.items():
            self.chunks[chunk] = b"".join([pieces[p] for p in parts])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; null counts as empty."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and size < GROUP_CHARS:
                text = texts[at] or ""
                size += len(text) + 1
                group.append([text] if text and OTHER_SPACE.search(text) else CHUNK.findall(text))
                at += 1
            known = self.chunks
            fresh = {c for chunks in group for c in chunks if c not in known}
            if fresh and len(known) + len(fresh) > self.limit:
                known.clear()
                fresh = {c for chunks in group for c in chunks}
            if fresh:
                self._learn(fresh)
            out += [np.frombuffer(b"".join([known[c] for c in chunks]), np.int32) for chunks in group]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes behind the ids."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end character of every token.

        Tokens that hold parts of one split character all cover that character.
        """
        data = np.frombuffer(self.decode(ids), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80)
        ends = np.cumsum(self.token_sizes[ids])
        starts = ends - self.token_sizes[ids]
        return (character[starts] - 1).astype(np.int32), character[ends - 1].astype(np.int32)


_CODECS: list[tuple[dict, Codec]] = []  # that of the running task; it holds the specification it was made from


def codec_of(shared) -> Codec:
    """The task's codec for a broadcast specification."""
    spec = shared.value
    if not _CODECS or _CODECS[0][0] is not spec:
        _CODECS[:] = [(spec, Codec(spec))]
    return _CODECS[0][1]


def specification(path: str, pattern: str) -> dict:
    """What workers need; its size is that of the vocabulary file, whatever the data."""
    return {"tokenizer": build_tokenizer(read_ranks(path)).to_str(), "pattern": pattern}


def _names(batch: pa.RecordBatch, without: str) -> list[str]:
    return [n for n in batch.schema.names if n != without]


def encode(docs: DataFrame, spec: dict, text: str = "text", offsets: bool = False) -> DataFrame:
    """Replace column ``text`` by ``ids`` (and ``starts``, ``ends`` in characters).

    Null and empty texts give an empty list. Other columns stay, except ones named like the
    new ones, which are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    added = ["ids", *(["starts", "ends"] if offsets else [])]
    rows = docs.select(*[c for c in docs.columns if c not in added or c == text])
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared)
        kind = pa.list_(pa.int32())
        for batch in batches:
            ids = codec.encode(batch.column(text).to_pylist())
            extra = [pa.array(ids, kind)]
            if offsets:
                pairs = [codec.offsets(i) if len(i) else (i, i) for i in ids]
                extra += [pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *extra], [*kept, *added])
        _CODECS.clear()  # a worker goes on to other work after its task

    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept],
                        *[f"{c} array<int>" for c in added]])
    return small_batches(rows).mapInArrow(run, schema)


def decode(rows: DataFrame, spec: dict) -> DataFrame:
    """Replace ``ids`` by ``data`` (the exact bytes) and ``text``.

    Bytes that are no whole character, as when a list starts inside one, become U+FFFD in
    ``text``. A null list gives nulls.
    """
    shared = rows.sparkSession.sparkContext.broadcast(spec)
    rows = rows.select(*[c for c in rows.columns if c not in ("data", "text")])
    kept = [c for c in rows.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared)
        for batch in batches:
            data = [None if ids.as_py() is None else codec.decode(ids.values.to_numpy(zero_copy_only=False))
                    for ids in batch.column("ids")]
            text = [None if d is None else d.decode("utf-8", "replace") for d in data]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(data, pa.binary()),
                                              pa.array(text, pa.string())], [*kept, "data", "text"])

    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept], "data binary, text string"])
    return small_batches(rows).mapInArrow(run, schema)


def round_trip(docs: DataFrame, spec: dict) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes, in one pass.

    Null and empty texts have no tokens and the digests of the empty string; repeated ids are
    handled row by row.
    """
    import hashlib
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared)
        decimal = list(map(str, range(len(codec.token_bytes))))
        step = 256
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                counts, id_sums, byte_sums = [], [], []
                for ids in codec.encode(batch.column("text").to_pylist()):
                    counts.append(len(ids))
                    id_sums.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                    byte_sums.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_sums), pa.array(byte_sums)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        _CODECS.clear()

    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
