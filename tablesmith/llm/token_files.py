"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames, one skippable frame with the first document of every
frame, and the seek table of the public seekable format: compressed size, size and checksum
(low 32 bits of XXH64) per frame, then frame count, descriptor and magic number. A frame holds
whole documents: their number, ids, lengths, and token ids as little-endian unsigned 32-bit
integers. A reader seeks to the end, then decompresses only frames that hold what it wants.
"""

from __future__ import annotations

import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, normalizers

from tablesmith.llm.byte_bpe import byte_characters
from tablesmith.llm.storage import new_folder, saved, small_batches

# Fixed values of the public seekable format.
SEEK_MAGIC = 0x8F92EAB1
TABLE_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
WITH_CHECKSUMS = 0x80

NULL_ID = -(1 << 63)  # stands for a null doc_id
FRAME_IDS = 1 << 17

# The pre-token pattern of the word vocabulary (fixed value).
WORD_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class FrameWriter:
    """Writes one file; documents go in ascending order."""

    def __init__(self, out, level: int = 3):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=level)
        self.table, self.first, self.documents, self.size = [], [], [], 0
        self.n_documents = self.n_ids = 0

    def add(self, doc_id: int, ids: bytes) -> None:
        self.documents.append((doc_id, ids))
        self.size += len(ids) // 4
        self.n_documents += 1
        self.n_ids += len(ids) // 4
        if self.size >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.documents:
            return
        keys = np.array([d for d, _ in self.documents], "<i8")
        sizes = np.array([len(ids) // 4 for _, ids in self.documents], "<u4")
        data = struct.pack("<I", len(keys)) + keys.tobytes() + sizes.tobytes() + b"".join(i for _, i in self.documents)
        frame = self.packer.compress(data)
        self.out.write(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.first.append(int(keys[0]))
        self.documents, self.size = [], 0

    def close(self) -> None:
        self.flush()
        index = np.array(self.first, "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", TABLE_FRAME, len(entries) + len(footer)) + entries + footer)


class FrameReader:
    """Random access to one file (a binary file object with seek)."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        source.seek(end - 9)
        count, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the file")
        table_at = end - 9 - 12 * count - 8
        source.seek(table_at + 8)
        self.table = np.frombuffer(source.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])]).astype(np.int64)
        source.seek(table_at - 8 * count)
        self.first = np.frombuffer(source.read(8 * count), "<i8")

    def frame(self, i: int) -> Iterator[tuple[int, bytes]]:
        """(doc_id, ids) of one frame, after its checksum has been compared."""
        self.source.seek(int(self.starts[i]))
        data = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.table[i, 0])), int(self.table[i, 1]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"checksum of frame {i} differs")
        (n,) = struct.unpack_from("<I", data)
        keys = np.frombuffer(data, "<i8", n, 4).tolist()
        sizes = np.frombuffer(data, "<u4", n, 4 + 8 * n).astype(np.int64)
        ends = (4 + 12 * n + 4 * np.cumsum(sizes)).tolist()
        starts = (np.array(ends) - 4 * sizes).astype(int).tolist() if n else []
        for key, start, end in zip(keys, starts, ends):
            yield key, data[start:end]

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """All documents, or those of ``wanted`` from the frames that can hold them."""
        if wanted is None:
            for i in range(len(self.table)):
                yield from self.frame(i)
            return
        wanted = set(wanted)
        frames = set()
        for key in wanted:
            last = int(np.searchsorted(self.first, key, "right")) - 1
            from_ = max(0, int(np.searchsorted(self.first, key, "left")) - 1)
            frames.update(range(from_, last + 1))
        for i in sorted(frames):
            yield from ((key, ids) for key, ids in self.frame(i) if key in wanted)


class WordEncoder:
    """Ids of texts by a word-level vocabulary that drops white space and case.

    White space never joins two words, so each distinct word is cut and its pieces are merged by
    the library's model once per worker. Texts that are not in Unicode normal form C, or that hold an added token in
    any case, go to the library as a whole, which cuts added tokens out first.
    """

    def __init__(self, tokenizer_json: str, limit: int = 800_000):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model, self.lower = self.tokenizer.model, normalizers.Lowercase().normalize_str
        added = {t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = regex.compile(b"|".join(regex.escape(c.encode("utf-8")) for c in sorted(added) if c) or b"(?!)")
        self.stand_in = dict(enumerate(byte_characters()))
        self.limit, self.words, self.pieces = limit, {}, {}

    def _learn(self, words: set[bytes]) -> None:
        split = {w: WORD_PIECE.findall(w.decode() if w.isascii() else self.lower(w.decode())) for w in words}
        fresh = [p for p in {p for parts in split.values() for p in parts} if p not in self.pieces]
        if len(self.pieces) + len(fresh) > self.limit:
            self.pieces.clear()
            fresh = list({p for parts in split.values() for p in parts})
        merge, stand_in = self.model.tokenize, self.stand_in
        for piece in fresh:
            ids = [t.id for t in merge(piece.encode("utf-8").decode("latin-1").translate(stand_in))]
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        pieces = self.pieces
        for word, parts in split.items():
            self.words[word] = b"".join([pieces[p] for p in parts])

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        raw = text.encode("utf-8").lower()
        if self.added.search(raw) or not text.isascii() and not (unicodedata.is_normalized("NFC", text)
                                       and unicodedata.is_normalized("NFC", raw.decode("utf-8"))):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words, known = raw.split(), self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        fresh = {w for w in words if w not in known}
        if len(known) + len(fresh) > self.limit:
            known.clear()
            fresh = set(words)
        self._learn(fresh)
        return b"".join([known[w] for w in words])


_ENCODERS: list[tuple[str, WordEncoder]] = []  # that of the running task; it holds the vocabulary it was made from


def _open(folder: str):
    return pyarrow.fs.FileSystem.from_uri(folder)


def write_files(docs: DataFrame, tokenizer_json: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; returns one row per file.

    Rows are ranged by doc_id (nulls first, repeated ids by text), so file after file holds
    ascending ids. Null texts are empty. Each file is written under a temporary name and
    moved into place, so a task that runs again replaces its own file.
    Columns: part, uri, n_documents, n_ids.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    shared = spark.sparkContext.broadcast(tokenizer_json)
    end = struct.pack("<I", end_id)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        if not _ENCODERS or _ENCODERS[0][0] is not vocabulary:
            _ENCODERS[:] = [(vocabulary, WordEncoder(vocabulary))]
        encoder, writer = _ENCODERS[0][1], None
        part = TaskContext.get().partitionId()
        files, base = _open(folder)
        scratch, final = f"{base}/.{part:07d}-{uuid.uuid4().hex}", f"{base}/{part:07d}.ids.zst"
        for batch in batches:
            if batch.num_rows and writer is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(scratch)
                writer = FrameWriter(out)
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                writer.add(NULL_ID if key is None else key, encoder.encode(text.as_py()) + end)
        if writer is not None:
            writer.close()
            out.close()
            files.move(scratch, final)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([f"{folder}/{part:07d}.ids.zst"]),
                 pa.array([writer.n_documents]), pa.array([writer.n_ids])],
                ["part", "uri", "n_documents", "n_ids"])

    return saved(small_batches(rows).mapInArrow(run, "part long, uri string, n_documents long, n_ids long"), "token-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids in all documents before) and ids of every document, file by file."""
    return _read(manifest, "ids binary", lambda ids: ids, pa.binary())


def read_digests(manifest: DataFrame) -> DataFrame:
    """As ``read_files`` with the crc32 of the ids in their place."""
    return _read(manifest, "ids_crc32 long", zlib.crc32, pa.int64())


def _read(manifest: DataFrame, column: str, value, kind: pa.DataType) -> DataFrame:
    # one row per file: a running total over these is all that has to be in one place
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("start", F.coalesce(before, F.lit(0))).select("part", "uri", "start")
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                folder, _, name = uri.rpartition("/")
                system, base = _open(folder)
                with system.open_input_file(f"{base}/{name}") as source:
                    reader = FrameReader(source)
                    for i in range(len(reader.table)):
                        keys, starts, counts, values = [], [], [], []
                        for key, ids in reader.frame(i):
                            keys.append(None if key == NULL_ID else key)
                            starts.append(start)
                            counts.append(len(ids) // 4)
                            values.append(value(ids))
                            start += len(ids) // 4
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
                             pa.array(values, kind)], ["doc_id", "start", "n_tokens", column.split()[0]])

    return files.repartition(n, "part").mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")
