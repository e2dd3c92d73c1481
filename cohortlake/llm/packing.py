"""Packing of documents into training sequences by multiway differencing.

A document's ids (with the end id) are cut into full sequences, then pieces of a
quarter of the capacity, and a rest. Pieces are dealt into groups of bounded size by a hash of
the task and the piece's number in it, written with the piece, so that no document, source,
null or repeated doc_id can overfill one. In each group the
Karmarkar-Karp method starts with one partial partition for each piece, merges
the two with the largest imbalance so that the heavy window of one meets the
light window of the other, and ends with near-equal windows. The window count
starts at the least that can hold the group and rises by one whenever a window
exceeds the capacity.

Sequence ids are the group's number and the window's in it; offsets are gapless.
A null or empty text is the end id alone. Every row of the input gives its
pieces, repeated rows too; a null doc_id stays null. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_columns, ids_of, in_chunks, materialize, small_batches, strings
from .encoding import CHUNK_CHARS, MOST_REMEMBERED, encoder

CAPACITY = 2048
END_ID = 1
#: Mean pieces of a group. The window count of a group is about a quarter of it.
GROUP = 120
#: Groups that one call of a task packs, one after the other.
TOGETHER = 16
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)]
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, lot long"


def difference(sizes: list[int], count: int) -> list[list[int]]:
    """Karmarkar-Karp: `count` lists of item numbers with near-equal sums of sizes."""
    if count == 1:
        return [list(range(len(sizes)))]
    # A partial partition: sums from heavy to light, less the lightest, and the items behind each;
    # windows that hold no item yet are left out, they are the lightest.
    heap = [(-size, i, [size], [[i]]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tag = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        alone_a, alone_b = count - len(b), count - len(a)  # heavy windows of each meet an empty one of the other
        if alone_b >= len(b):
            merged, items = a + b, in_a + in_b
        else:
            both = range(alone_a, len(a))
            merged = a[:alone_a] + [a[i] + b[count - 1 - i] for i in both] + b[:alone_b]
            items = in_a[:alone_a] + [in_a[i] + in_b[count - 1 - i] for i in both] + in_b[:alone_b]
        order = sorted(range(len(merged)), key=merged.__getitem__, reverse=True)
        low = merged[order[-1]] if len(merged) == count else 0
        sums = [merged[k] - low for k in order]
        heapq.heappush(heap, (-sums[0], tag, sums, [items[k] for k in order]))
        tag += 1
    return heap[0][3] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items in as few near-equal windows as the method fits into the capacity."""
    if not sizes:
        return []
    full = [[i] for i, size in enumerate(sizes) if size == capacity]
    rest = [i for i, size in enumerate(sizes) if size < capacity]
    own = [sizes[i] for i in rest]
    count = max(1, -(-sum(own) // capacity))
    while True:
        found = difference(own, count)
        if all(sum(own[i] for i in x) <= capacity for x in found):
            return full + [[rest[i] for i in x] for x in found if x]
        count += 1


def cut_pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, remembered: int = MOST_REMEMBERED) -> DataFrame:
    """Pieces of the encoded documents, with their ids in `ids` if asked for; a worker keeps at most two generations of `remembered` cuts."""
    small_batches(documents.sparkSession, "1m")
    quarter = max(1, capacity // 4)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = encoder(vocabulary, remembered)
        made, lot = 0, np.uint64(TaskContext.get().partitionId() + 1) * _MIX[0]
        for batch in in_chunks(batches, most=CHUNK_CHARS):
            at, rows, pieces = [], [], []
            for i, ids in enumerate(of.encode(list(batch["text"]))):
                ids += end
                total = len(ids) // 4
                whole = total // capacity * capacity
                for start in itertools.chain(range(0, whole, capacity), range(whole, total, quarter)):
                    piece = ids[4 * start : 4 * (start + (capacity if start < whole else quarter))]
                    at.append(i)
                    rows.append((start, len(piece) // 4, zlib.crc32(piece), total))
                    if with_ids:
                        pieces.append(piece)
            frame = pd.DataFrame(np.array(rows, np.int64).reshape(-1, 4), columns=["start", "length", "ids_crc32", "doc_tokens"])
            number = (lot ^ np.arange(made, made + len(frame), dtype=np.uint64)) * _MIX[1]
            made += len(frame)
            frame.insert(0, "doc_id", ids_of(batch)[at])
            frame["lot"] = ((number ^ (number >> np.uint64(29))) * _MIX[0] >> np.uint64(2)).astype(np.int64)
            if with_ids:
                frame["ids"] = strings(pieces)
            yield frame

    return documents.select(*id_columns(), F.col("text").cast("string")).mapInPandas(run, _PIECE + ", ids binary" * with_ids)


def pack(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, remembered: int = MOST_REMEMBERED) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids) of every piece."""
    spark = documents.sparkSession
    pieces = materialize(cut_pieces(documents, vocabulary, capacity, end_id, with_ids, remembered), "pieces")
    groups = max(1, -(-pieces.count() // GROUP))
    columns = [x.split(" ")[0] for x in _PIECE.split(", ")[:-1]] + ["ids"] * with_ids
    schema = _PIECE.replace(", lot long", ", sequence_id long, offset long") + ", ids binary" * with_ids

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["group", "length", "lot", "doc_id", "start", "ids_crc32"], ascending=[True, False, True, True, True, True], kind="stable").reset_index(drop=True)
        group, sizes = frame["group"].to_numpy(np.int64), frame["length"].to_numpy(np.int64)
        sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist()
        for first, end in zip(starts, [*starts[1:], len(frame)], strict=True):
            own = sizes[first:end].tolist()
            for number, items in enumerate(windows_of(own, capacity), int(group[first]) << 24):
                at = 0
                for i in sorted(items):
                    sequence[first + i], offset[first + i] = number, at
                    at += own[i]
        frame["sequence_id"], frame["offset"] = sequence, offset
        frame["doc_id"] = ids_of(frame)
        return frame[[*columns[:5], "sequence_id", "offset", *columns[5:]]]

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    rows = pieces.select(*id_columns(), *columns[1:5], "lot", *columns[5:], F.pmod("lot", F.lit(groups)).alias("group"))
    return rows.groupBy(F.expr(f"group div {TOGETHER}")).applyInPandas(run, schema)
