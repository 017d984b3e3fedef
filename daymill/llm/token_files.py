"""Token ids in files of independent zstandard frames that are read by document.

A file holds, in this order,

* frames of token ids, little-endian unsigned 32-bit integers, each of one or
  more whole documents and compressed on its own;
* one frame with the index: for each document its id, whether it has one, its
  number of tokens, and its frame;
* a seek table in a skippable frame, laid out as zstandard's seekable format
  has it: for each frame its compressed size, its size, and the low 32 bits of
  the XXH64 of its content, then the number of frames, a descriptor and a magic
  number. Plain zstandard readers skip it.
"""

from __future__ import annotations

import os
import posixpath
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.pieces import ChunkCache
from daymill.llm.shared import only_holder, seldom_collected, whole_text
from daymill.session import scratch_path

# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER, HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")

FRAME_TOKENS, LEVEL, TEXTS_AT_ONCE = 1 << 16, 1, 500
# Bytes of encodings that a worker keeps, and chunks encoded as one text.
MOST_BYTES, CHUNKS_A_TEXT = 140_000_000, 2_000
# A lookup by id takes so many ids at most; beyond that all files are read and joined.
MOST_WANTED = 100_000
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_tokens", "<u4"), ("frame", "<u4")])


class CorruptFrame(ValueError):
    """A frame whose content does not match its checksum."""


class TokenWriter:
    """Appends documents to an open stream; ``close`` writes the index and the seek table.

    At most one frame is held in memory, or one document if that is longer.
    """

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS, level: int = LEVEL):
        self._out, self._frame_bytes = out, 4 * frame_tokens
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._table, self._index, self._open, self._held = [], [], [], 0
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self._open and self._held + len(ids) > self._frame_bytes:
            self._flush()
        self._index.append((doc_id or 0, doc_id is not None, len(ids) // 4, len(self._table)))
        self._open.append(ids)
        self._held += len(ids)
        self.n_tokens += len(ids) // 4

    def _flush(self) -> None:
        self._frame(b"".join(self._open))
        self._open, self._held = [], 0

    def _frame(self, content: bytes) -> None:
        packed = self._compress(content)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self._table.append((len(packed), len(content), checksum))
        self._out.write(packed)

    def close(self) -> int:
        """The number of documents written."""
        if self._open:
            self._flush()
        self._frame(np.array(self._index, INDEX).tobytes())
        entries = b"".join(ENTRY.pack(*e) for e in self._table)
        footer = FOOTER.pack(len(self._table), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self._out.write(HEADER.pack(SKIPPABLE_MAGIC, len(entries) + len(footer)))
        self._out.write(entries + footer)
        return len(self._index)


class TokenFile:
    """Reads documents by place or id; only their frames are read and decompressed."""

    def __init__(self, source):
        self._in = source
        size = source.size()
        source.seek(size - FOOTER.size)
        n, _, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise CorruptFrame("no seek table")
        source.seek(size - FOOTER.size - n * ENTRY.size)
        self._table = list(ENTRY.iter_unpack(source.read(n * ENTRY.size)))
        self._starts = np.concatenate([[0], np.cumsum([e[0] for e in self._table])])
        self.index = np.frombuffer(self.frame(n - 1), INDEX)
        ends = np.cumsum(self.index["n_tokens"].astype(np.int64))
        self.starts = ends - self.index["n_tokens"]
        self.n_tokens = int(ends[-1]) if len(ends) else 0

    def frame(self, number: int) -> bytes:
        packed, size, checksum = self._table[number]
        self._in.seek(int(self._starts[number]))
        content = zstandard.ZstdDecompressor().decompress(self._in.read(packed), max_output_size=size)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise CorruptFrame(f"frame {number}")
        return content

    def documents(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """Place and ids of all documents, or those at ``places`` in ascending order."""
        number, content, frame_start = -1, b"", 0
        for place in range(len(self.index)) if places is None else places:
            entry = self.index[place]
            if entry["frame"] != number:
                number = int(entry["frame"])
                content = self.frame(number)
                frame_start = int(self.starts[np.searchsorted(self.index["frame"], number)])
            at = 4 * (int(self.starts[place]) - frame_start)
            yield place, content[at : at + 4 * int(entry["n_tokens"])]

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every document with this id."""
        places = np.flatnonzero((self.index["doc_id"] == doc_id) & (self.index["has_id"] == 1))
        return [ids for _, ids in self.documents(places.tolist())]


def filesystem_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class LibraryEncoder:
    """Texts to ids by the tokenizers library, each followed by an end id.

    Chunks that the library encodes alike alone and in a text are encoded once
    and kept. Texts that may hold a special token go to the library whole.
    """

    def __init__(self, tokenizer_path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to share out
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(tokenizer_path)
        self._end = struct.pack("<I", end_id)
        added = self._library.get_added_tokens_decoder().values()
        self._special = [t.content for t in added]
        self._cache = ChunkCache(self._encode_chunks, MOST_BYTES)
        only = self._library.encode("\n", add_special_tokens=False).ids
        self._break = only[0] if len(only) == 1 else -1

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The encoding of each chunk; many at once, as lines of one text.

        A line break between words is a piece of its own, so what lies between
        two of its ids is a chunk. Chunks of white space are encoded by
        themselves, and so are all if the lines do not add up.
        """
        found = [b""] * len(chunks)
        joined = [i for i, c in enumerate(chunks) if "\n" not in c and not c.isspace()]
        alone = sorted(set(range(len(chunks))) - set(joined)) if len(joined) < len(chunks) else []
        for at in range(0, len(joined), CHUNKS_A_TEXT):
            some = joined[at : at + CHUNKS_A_TEXT]
            text = "\n".join([chunks[i] for i in some])
            ids = np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)
            breaks = np.flatnonzero(ids == self._break)
            if len(breaks) != len(some) - 1:
                alone += some
                continue
            raw, ends = ids.tobytes(), (4 * breaks).tolist()
            for i, start, end in zip(some, [0, *(e + 4 for e in ends)], [*ends, len(raw)]):
                found[i] = raw[start:end]
        for i, ids in zip(alone, self._encode([chunks[i] for i in alone])):
            found[i] = ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self._special)}
        plain = self._cache.encoded(["" if i in whole else t for i, t in enumerate(texts)])
        for i in whole:
            plain[i] = self._encode([texts[i]])[0]
        return [ids + self._end for ids in plain]


@lru_cache(maxsize=1)
def encoder_of(tokenizer_path: str, end_id: int) -> LibraryEncoder:
    """The encoder of a worker, which outlives its tasks."""
    return LibraryEncoder(tokenizer_path, end_id)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    end_id: int,
    frame_tokens: int = FRAME_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write ids in ascending document order; returns ``number``, ``file``, ``n_docs``, ``n_tokens``.

    Each task writes a file of its own and moves it into place when it is
    whole, so a repeated task replaces its file by an equal one. Null texts are
    empty; null ids come last; rows with equal ids are ordered by their text's
    hash, then text. An empty table gives no file. Other columns are not
    written. ``path`` is a folder or URI that every executor reaches.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_last(), tie)
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), tie, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("token_files", encoder_of.cache_clear)
        seldom_collected()
        encoder = encoder_of(tokenizer_path, end_id)
        context = TaskContext.get()
        number, store, at = context.partitionId(), *filesystem_of(path)
        name = f"{number:06d}.tokens"
        writer = None
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                if writer is None:
                    store.create_dir(at, recursive=True)
                    part = posixpath.join(at, f".{name}.{context.taskAttemptId()}")
                    stream = store.open_output_stream(part)
                    writer = TokenWriter(stream, frame_tokens)
                found = encoder.encode(batch.column(1).to_pylist())
                for key, ids in zip(batch.column(0).to_pylist(), found):
                    writer.add(key, ids)
        if writer is not None:
            n_docs = writer.close()
            stream.close()
            store.move(part, posixpath.join(at, name))
            row = {"number": [number], "file": [name], "n_docs": [n_docs], "n_tokens": [writer.n_tokens]}
            yield pa.RecordBatch.from_pydict(row)

    manifest = scratch_path(spark, "llm-token-files")
    schema = "number bigint, file string, n_docs bigint, n_tokens bigint"
    ordered.mapInArrow(write, schema).write.parquet(manifest)
    return spark.read.parquet(manifest)


def read_token_files(manifest: DataFrame, path: str, *, keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` from the files.

    With ``keep_ids`` also ``ids``, the little-endian integers. Every task
    reads files of its own, frame by frame, and a frame that does not match its
    checksum is an error.
    """
    order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("start"), "n_docs"
    ).repartition(max(1, manifest.count()), "file")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids binary" if keep_ids else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = filesystem_of(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(posixpath.join(at, row["file"])) as source:
                    yield from _rows(TokenFile(source), row["start"], keep_ids)

    return placed.mapInArrow(read, schema)


def _rows(tokens: TokenFile, start: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    step = TEXTS_AT_ONCE if keep_ids else 20_000
    for first in range(0, len(tokens.index), step):
        part = slice(first, first + step)
        entries = tokens.index[part]
        places = range(first, first + len(entries))
        kept, sums = [], []
        for _, ids in tokens.documents(places):
            sums.append(zlib.crc32(ids))
            if keep_ids:
                kept.append(ids)
        columns = [
            pa.array(entries["doc_id"], pa.int64(), mask=entries["has_id"] == 0),
            pa.array(tokens.starts[part] + start, pa.int64()),
            pa.array(entries["n_tokens"].astype(np.int64)),
            pa.array(sums, pa.int64()),
        ]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if keep_ids:
            columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "ids"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def find_documents(manifest: DataFrame, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents named in ``wanted``, from their frames alone.

    A file opens its index, and decompresses the frames that hold wanted
    documents; the files are shared out over the tasks.
    """
    keys = [r[0] for r in wanted.select("doc_id").distinct().limit(MOST_WANTED + 1).collect()]
    if len(keys) > MOST_WANTED:
        raise ValueError(f"more than {MOST_WANTED} documents; join read_token_files instead")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = filesystem_of(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(posixpath.join(at, name)) as source:
                    tokens = TokenFile(source)
                    hit = np.isin(tokens.index["doc_id"], keys) & (tokens.index["has_id"] == 1)
                    for place, ids in tokens.documents(np.flatnonzero(hit).tolist()):
                        found = {"doc_id": [int(tokens.index["doc_id"][place])], "ids": [ids]}
                        yield pa.RecordBatch.from_pydict(found)

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(read, "doc_id bigint, ids binary")

