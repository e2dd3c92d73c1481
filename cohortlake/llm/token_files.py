"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds the ids of consecutive documents in ascending doc_id order:

* frames, each an independent zstandard frame with the ids of whole documents
  as little-endian 32-bit integers, cut at FRAME_IDS ids;
* a skippable frame (magic 0x184D2A5D) with the document index: a count, then
  for each document its doc_id (64-bit, with the least value for null) and its
  number of ids (64-bit);
* a skippable frame (magic 0x184D2A5E) with the seek table: for each frame the
  compressed size, the decompressed size and the low 32 bits of the xxh64 of the
  decompressed bytes, then the number of frames, a descriptor byte with the
  checksum flag, and the magic 0x8F92EAB1. This is the seekable format that
  zstandard publishes, so that its readers decompress only the frames they need.

The documents are range-partitioned by doc_id, so that every file is written by
one task and the ids before a file are the sum over the files before it. A file
that a lost executor left half is never visible, as names appear only at the end,
and a rerun writes the same bytes under the same name.

Defined results: a null or empty text is the end id alone; rows with a null doc_id
come first; rows that repeat a doc_id are neighbours, ordered by a hash of the
text and the text. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_columns, in_chunks, materialize, new_path, open_file, small_batches, strings, write_file
from .encoding import CHUNK_CHARS, encoder

# Fixed values of the format.
INDEX_MAGIC = 0x184D2A5D
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
NO_ID = -(1 << 63)

FRAME_IDS = 1 << 18
FILE_IDS = 1 << 24
#: Cuts of one generation that a writer remembers: with two of them, some 90 MB a worker.
MOST_CUTS = 200_000
LEVEL = 1


class Writer:
    """The parts of one file, frame by frame."""

    def __init__(self):
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.size = self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[bytes]:
        self.index.append((NO_ID if doc_id is None else doc_id, len(ids) // 4))
        self.open.append(ids)
        self.size += len(ids)
        self.total += len(ids) // 4
        if self.size >= 4 * FRAME_IDS:
            yield self._frame()

    def _frame(self) -> bytes:
        raw = b"".join(self.open)
        frame = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.open, self.size = [], 0
        return frame

    def end(self) -> Iterator[bytes]:
        if self.open:
            yield self._frame()
        index = struct.pack("<Q", len(self.index)) + b"".join(struct.pack("<qq", *x) for x in self.index)
        yield struct.pack("<II", INDEX_MAGIC, len(index)) + index
        table = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, FOOTER_MAGIC)
        yield struct.pack("<II", SEEK_MAGIC, len(table)) + table


class Reader:
    """Random access to one file: `read(number)` decompresses only that document's frame."""

    def __init__(self, source: io.RawIOBase):
        self.source = source
        source.seek(-9, io.SEEK_END)
        frames, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        source.seek(-(9 + 12 * frames + 8), io.SEEK_END)
        at = source.tell()
        if struct.unpack("<II", source.read(8)) != (SEEK_MAGIC, 12 * frames + 9):
            raise ValueError("the seek table's frame is damaged")
        table = np.frombuffer(source.read(12 * frames), "<u4").reshape(frames, 3).astype(np.int64)
        self.sizes, self.raw_sizes, self.checksums = table.T
        self.offsets = np.cumsum(np.append(0, self.sizes))
        self.raw_offsets = np.cumsum(np.append(0, self.raw_sizes))
        source.seek(self.offsets[-1])
        magic, length = struct.unpack("<II", source.read(8))
        if magic != INDEX_MAGIC or self.offsets[-1] + 8 + length != at:
            raise ValueError("the document index is damaged")
        index = np.frombuffer(source.read(length)[8:], "<i8").reshape(-1, 2)
        self.doc_ids, self.lengths = index.T
        self.starts = np.cumsum(np.append(0, self.lengths))
        self._number, self._raw = -1, b""

    def frame(self, number: int) -> bytes:
        if number != self._number:
            self.source.seek(self.offsets[number])
            raw = zstandard.ZstdDecompressor().decompress(self.source.read(self.sizes[number]))
            if len(raw) != self.raw_sizes[number] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[number]:
                raise ValueError(f"frame {number} does not match its checksum")
            self._number, self._raw = number, raw
        return self._raw

    def read(self, number: int) -> bytes:
        begin, size = 4 * int(self.starts[number]), 4 * int(self.lengths[number])
        frame = int(np.searchsorted(self.raw_offsets, begin, "right")) - 1
        inside = begin - int(self.raw_offsets[frame])
        return self.frame(frame)[inside : inside + size]


def write_token_files(documents: DataFrame, vocabulary: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the documents' ids to files of the shared folder: path, part, number, documents, ids; in order of (part, number)."""
    spark = documents.sparkSession
    small_batches(spark)
    folder = folder or new_path(spark, "token-files")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, made = encoder(vocabulary, MOST_CUTS), []
        part, number, writer, parts = None, 0, Writer(), []

        def close():
            path = f"{folder}/part-{part:06d}-{number:06d}.tok.zst"
            write_file(path, [*parts, *writer.end()])
            made.append((path, part, number, len(writer.index), writer.total))

        for batch in in_chunks(batches, most=CHUNK_CHARS):
            part = int(batch["part"].iloc[0])
            for doc_id, none, ids in zip(batch["doc_id"].tolist(), batch["no_id"].tolist(), of.encode(list(batch["text"])), strict=True):
                parts += writer.add(None if none else doc_id, ids + end)
                if writer.total >= FILE_IDS:
                    close()
                    number, writer, parts = number + 1, Writer(), []
        if writer.index:
            close()
        yield pd.DataFrame(made, columns=["path", "part", "number", "documents", "ids"])

    # The text's hash is in the order so that a range can end inside the rows of one doc_id, or of null.
    order = [F.col("doc_id").cast("long"), F.xxhash64("text"), "text"]
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select(*id_columns(), "text", F.spark_partition_id().alias("part"))
    return materialize(ordered.mapInPandas(run, "path string, part int, number int, documents long, ids long"), "token-index")


def read_token_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document in the files, in any order of rows; ids as little-endian 32-bit bytes."""
    spark = files.sparkSession
    # Sums over the parts (one row for each partition of the writer), then inside each part.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = files.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(base, "part").select("path", (F.col("base") + F.col("inside")).alias("base"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"], strict=True):
                with open_file(path) as source:
                    reader = Reader(source)
                    for first in range(0, len(reader.lengths), 256):
                        here = slice(first, first + 256)
                        ids = [reader.read(i) for i in range(*here.indices(len(reader.lengths)))]
                        none = reader.doc_ids[here] == NO_ID
                        frame = pd.DataFrame({
                            "doc_id": pd.arrays.IntegerArray(np.where(none, 0, reader.doc_ids[here]), none), "start": base + reader.starts[:-1][here],
                            "n_tokens": reader.lengths[here].copy(), "ids_crc32": np.array([zlib.crc32(x) for x in ids], np.int64),
                        })
                        if with_ids:
                            frame["ids"] = strings(ids)
                        yield frame

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    # By range, as a hash of the names would deal several files to some tasks and none to others.
    return placed.repartitionByRange(max(1, files.count()), "path").mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def round_trip(documents: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    return read_token_files(write_token_files(documents, vocabulary, end_id), with_ids=False)
