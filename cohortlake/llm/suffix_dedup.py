"""Removal of repeated byte strings, by distributed prefix doubling over a sample of the suffixes.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else
in the corpus, in the same text or in another one.

1. **Sampled suffixes.** Sorting every suffix of 100 TB is out of reach, so only
   anchors are ranked. Of a string of LENGTH bytes, the anchor is the first
   position whose SEED bytes have the least hash. Equal strings have it at the same
   place, so no repeat is lost. Neighbouring strings that share an anchor are a block;
   the blocks of a text tile its strings, about one for each 69 bytes.
2. **Prefix doubling.** The first rank of a block is that of its bytes up to the end
   of its anchor's seed. Spark sorts the blocks by pairs of ranks, those of a block
   and of the block `offset` further, and the pairs become the ranks of twice as many
   blocks; offsets are 1, 2, 4, ... . Blocks whose rank is unique drop out. A block
   whose rank is shared past the threshold, that is over all bytes of its strings,
   is covered whole. A rank is the least position that shares it, so it is exact up
   to the 128-bit hashes of the first ranks.
3. **Ends of repeats.** Blocks that drop out on the way may still hold some repeated
   strings, next to where a repeat begins or ends. They are compared, string by
   string, with one block of each rank with the same seed: in one task up to TOGETHER
   blocks of a seed, which is linear work, and by exploded strings and a grouped
   count for seeds with more.

A bit filter of the seeds found more than once spares blocks before they are
written; it has a fixed size, and a full one only lets more blocks pass.

Defined results: a null or empty text has no bytes and keeps none. Matches never
cross texts. Rows that repeat a doc_id, or have a null one, are texts like others,
and other columns are ignored. Equal texts of at least LENGTH bytes lose all bytes.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, id_columns, ids_of, in_chunks, materialize, remember_only, small_batches, strings

LENGTH = 200
#: Bytes of a seed, as a share of the length; the rest of a string is where its anchor may lie.
SEED_SHARE = 0.32
#: Least and most bits of the filter of repeated seeds.
FILTER_BITS = (1 << 16, 1 << 26)
#: Blocks of one seed that a task compares at once: their strings are hashed and sorted, some 4 KB for each block.
TOGETHER = 1 << 15
#: Blocks whose bytes are hashed at once.
SLICE = 2_048
#: Characters that a task hashes at once.
HASHED_CHARS = 400_000

_MUL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(x: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """64-bit hashes of every `width` bytes of x, built from those of halves."""
    power = np.random.default_rng(seed).integers(0, 1 << 63, 256, np.uint64)[x]
    out, begin, length = None, 0, 1
    rest = width
    while rest:
        if rest & 1:
            part = power[begin:]
            out = part if out is None else _mixed(out[: len(part)], part)
            begin += length
        rest >>= 1
        if rest:
            power = _mixed(power[: max(0, len(power) - length)], power[length:])
            length *= 2
    return out[: max(0, len(x) - width + 1)]


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x[: len(y)] * _MUL[0]
    z += y
    z ^= z >> np.uint64(31)
    z *= _MUL[1]
    z ^= z >> np.uint64(29)
    return z


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` neighbours."""
    span = 1
    while 2 * span <= width:
        h = np.minimum(h[: len(h) - span], h[span:])
        span *= 2
    return h if span == width else np.minimum(h[: len(h) - (width - span)], h[width - span :])


class Blocks:
    """Blocks of some texts: their text, first string `lo` and last `hi` (from the text's start), anchor, seed and number of blocks up to the threshold."""

    def __init__(self, texts: list[bytes], length: int, seed: int):
        self.raw = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(np.append(0, sizes))[:-1]
        x = np.frombuffer(self.raw, np.uint8)
        h = gram_hashes(x, seed)
        among = length - seed + 1
        least = window_least(h, among) if len(h) >= among else h[:0]
        inside = np.zeros(len(least) + 1, np.int64)  # strings inside a text
        long = sizes >= length
        np.add.at(inside, begin[long], 1)
        np.add.at(inside, (begin + sizes - length + 1)[long], -1)
        valid = np.cumsum(inside)[:-1] > 0
        last = np.ones(len(least), bool)  # the last string of its block
        last[:-1] = (least[1:] != least[:-1]) | ~valid[1:]
        last |= h[: len(least)] == least
        hi = np.flatnonzero(last & valid)
        self.text = np.searchsorted(begin, hi, "right") - 1
        # Of texts without bytes the last that begins there is found; it is the one with bytes.
        first = np.append(True, self.text[1:] != self.text[:-1])[: len(hi)]
        lo = np.append(0, hi[:-1] + 1)[: len(hi)]
        lo[first] = begin[self.text[first]]
        self.anchor = hi + (np.argmin(sliding_window_view(h, among)[hi], axis=1) if len(hi) else hi)
        end = self.anchor + seed
        final = np.append(first[1:], True)[: len(hi)]
        end[final] = (begin + sizes)[self.text[final]]
        self.lo, self.hi, self.end, self.begin = lo, hi, end, begin
        self.seed = h[self.anchor].view(np.int64)
        self.reach = np.searchsorted(end, hi + length) - np.arange(len(hi)) + 1
        self.top = np.zeros(len(hi), np.int64)  # rounds that need this block's rank
        level = 1
        while len(hi) and (far := self.reach >= 1 << level).any():
            needed = np.zeros(len(hi) + 1, np.int64)
            at = np.flatnonzero(far)
            np.add.at(needed, at, 1)
            np.add.at(needed, at + self.reach[at] - (1 << level) + 1, -1)
            self.top[np.cumsum(needed)[:-1] > 0] = level
            level += 1

    def name(self, i: int) -> tuple[int, int]:
        """128-bit hash of the block's bytes up to its end, with its number of strings."""
        lo = int(self.lo[i])
        x = xxhash.xxh3_128_intdigest(self.raw[lo : int(self.end[i])], seed=int(self.hi[i]) - lo)
        return (x >> 64) - (1 << 63), (x & ((1 << 64) - 1)) - (1 << 63)


def _utf8(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


class SeedFilter:
    """A bit filter on seeds, which are hashes already."""

    def __init__(self, seeds: DataFrame):
        least, most = FILTER_BITS
        self.size = min(most, max(least, 1 << (8 * seeds.count()).bit_length()))
        slot = F.col("seed").bitwiseAND(F.lit(self.size - 1))
        words = seeds.groupBy(F.shiftright(slot, 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(seed & 31L as int))")).alias("bits")).toPandas()
        bits = np.zeros(self.size // 32, np.uint32)
        bits[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
        self.shared = seeds.sparkSession.sparkContext.broadcast(bits)

    def reader(self):
        shared, mask = self.shared, self.size - 1

        def held(seeds: np.ndarray) -> np.ndarray:
            at = seeds & mask
            return (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1

        return held


def _seeds(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """Seeds that are the anchors of two blocks or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("suffixes")
        for batch in in_chunks(batches, most=HASHED_CHARS):
            found, times = np.unique(Blocks(_utf8(batch["text"]), length, seed).seed, return_counts=True)
            yield pd.DataFrame({"seed": found, "n": times})

    return docs.select("text").mapInPandas(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")


_BLOCK = "pos long, t1 long, t2 long, lo long, strings long, anchor long, reach long, top long, seed long, n1 long, n2 long"


def _blocks(docs: DataFrame, length: int, seed: int, passes: SeedFilter) -> DataFrame:
    """Blocks whose seed the filter passes; `pos` numbers all blocks of a text one by one."""
    held = passes.reader()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("suffixes")
        at = TaskContext.get().partitionId() << 40
        for batch in in_chunks(batches, most=HASHED_CHARS):
            of = Blocks(_utf8(batch["text"]), length, seed)
            here = np.flatnonzero(held(of.seed))
            names = np.array([of.name(i) for i in here.tolist()], np.int64).reshape(-1, 2)
            text, start = of.text[here], of.begin[of.text[here]]
            yield pd.DataFrame({
                "pos": at + here, "t1": batch["t1"].to_numpy()[text], "t2": batch["t2"].to_numpy()[text], "lo": of.lo[here] - start, "strings": (of.hi - of.lo + 1)[here],
                "anchor": of.anchor[here] - start, "reach": of.reach[here], "top": of.top[here], "seed": of.seed[here], "n1": names[:, 0], "n2": names[:, 1],
            })
            at += len(of.seed)

    return docs.select("t1", "t2", "text").mapInPandas(run, _BLOCK)


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that share their keys with another row, with the least pos of those that do as their rank."""
    shared = rows.groupBy(*keys).agg(F.min("pos").alias("rank"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Written first, so that the join's own shuffles can be split where one pair has a large share of the rows.
    shared = materialize(shared, "suffix-shared")
    return materialize(rows.join(shared, keys).drop(*(k for k in keys if k != "offset")), "suffix-ranks")


def _doubled(blocks: DataFrame) -> DataFrame:
    """pos and rank of the blocks whose strings, all of them, are repeated together elsewhere."""
    longest = blocks.agg(F.max("reach")).first()[0] or 0
    ranks = _ranked(blocks.select("pos", "reach", "top", "n1", "n2"), ["n1", "n2"])
    done, span = [], 1
    while span <= longest:
        # Where the threshold lies before twice the span, two ranks that overlap end at it; where ranks of twice the span are needed, two that adjoin make one.
        ends = ranks.where(f"reach >= {span} AND reach < {2 * span}").withColumn("offset", F.col("reach") - span)
        twice = ranks.where(f"top >= {(2 * span).bit_length() - 1}").withColumn("offset", F.lit(span).cast("long"))
        left = ends.unionByName(twice).withColumnRenamed("rank", "x").withColumn("next", F.col("pos") + F.col("offset"))
        pairs = left.join(ranks.select(F.col("pos").alias("next"), F.col("rank").alias("y")), "next").drop("next")
        found = _ranked(pairs, ["x", "y", "offset"])
        freed(blocks.sparkSession)
        done.append(found.where(f"offset < {span}").select("pos", "rank"))
        ranks = found.where(f"offset = {span}").drop("offset")
        span *= 2
    out = blocks.sparkSession.createDataFrame([], "pos long, rank long")
    for x in done:
        out = out.unionByName(x)
    return out


def _context(length: int):
    """Over texts with their open blocks: each block with the bytes of all its strings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches):
            rows, bytes_of = [], []
            for t1, t2, text, flat in zip(batch["t1"], batch["t2"], _utf8(batch["text"]), batch["open"], strict=True):
                for pos, seed, size, lo, count, anchor in np.asarray(flat, np.int64).reshape(-1, 6).tolist():
                    rows.append((pos, seed, size, t1, t2, lo, count, anchor))
                    bytes_of.append(text[lo : lo + count - 1 + length])
            frame = pd.DataFrame(np.array(rows, np.int64).reshape(-1, 8), columns=["pos", "seed", "size", "t1", "t2", "lo", "strings", "anchor"])
            yield frame.assign(bytes=strings(bytes_of))

    return run


_CONTEXT = "pos long, seed long, size long, t1 long, t2 long, lo long, strings long, anchor long, bytes binary"


def _string_hashes(frame: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every string of the blocks: the row of its block, its number there, and two hashes."""
    count = frame["strings"].to_numpy(np.int64)
    row = np.repeat(np.arange(len(frame), dtype=np.int32), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    raw, found = frame["bytes"].tolist(), ([], [])
    for begin in range(0, len(frame), SLICE):
        x = np.frombuffer(b"".join(raw[begin : begin + SLICE]), np.uint8)
        own = count[begin : begin + SLICE]
        start = np.cumsum(np.append(0, own + length - 1))[:-1]
        at = np.repeat(start - (np.cumsum(own) - own), own) + np.arange(own.sum())
        for hashes, seed in zip(found, (2, 3), strict=True):
            hashes.append(gram_hashes(x, length, seed)[at])
    return row, number, *(np.concatenate(x) if x else np.empty(0, np.uint64) for x in found)


def _compare(length: int):
    """Over open blocks sorted by seed: t1, t2, from, to of the bytes that repeated strings cover."""

    def covered(frame: pd.DataFrame) -> pd.DataFrame:
        row, number, h1, h2 = _string_hashes(frame, length)
        apart = (frame["anchor"] - frame["lo"]).to_numpy()[row] - number
        seed = frame["seed"].to_numpy()[row]
        by = np.lexsort((h2, h1, apart, seed))
        same = np.ones(len(by) + 1, bool)
        same[[0, -1]] = False
        for key in (seed, apart, h1, h2):
            same[1:-1] &= key[by[1:]] == key[by[:-1]]
        repeated = np.zeros(len(by), bool)
        repeated[by] = same[:-1] | same[1:]
        # Neighbouring repeated strings of a block are one run.
        at = np.flatnonzero(repeated)
        cut = np.append(True, (np.diff(at) > 1) | (np.diff(row[at]) > 0))[: len(at)]
        first, last = at[cut], at[np.append(np.flatnonzero(cut)[1:] - 1, len(at) - 1)] if len(at) else at
        lo = frame["lo"].to_numpy()[row[first]]
        return pd.DataFrame({"t1": frame["t1"].to_numpy()[row[first]], "t2": frame["t2"].to_numpy()[row[first]], "from": lo + number[first], "to": lo + number[last] + length})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            end = int(np.searchsorted(batch["seed"].to_numpy(), batch["seed"].iloc[-1]))
            if end:
                yield covered(batch.iloc[:end])
            rest = batch.iloc[end:]
        if rest is not None and len(rest):
            yield covered(rest)

    return run


def _compare_many(blocks: DataFrame, length: int) -> DataFrame:
    """As _compare, for seeds with any number of blocks: every string is a row, counts are combined before they are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, number, h1, h2 = _string_hashes(batch, length)
            of = batch[["t1", "t2", "lo", "anchor"]].to_numpy(np.int64)[row]
            yield pd.DataFrame({"t1": of[:, 0], "t2": of[:, 1], "from": of[:, 2] + number, "apart": of[:, 3] - of[:, 2] - number, "h1": h1.view(np.int64), "h2": h2.view(np.int64)})

    rows = materialize(blocks.mapInPandas(run, "t1 long, t2 long, from long, apart long, h1 long, h2 long"), "suffix-strings")
    keys = ["apart", "h1", "h2"]
    shared = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(shared, keys).select("t1", "t2", "from", (F.col("from") + length).alias("to"))


def repeated_ranges(docs: DataFrame, length: int, together: int = TOGETHER) -> DataFrame:
    """t1, t2, from, to: byte ranges of the texts (by their hashes t1 and t2) that repeated strings cover; ranges overlap and repeat."""
    seed = max(1, int(length * SEED_SHARE))
    docs = docs.where(f"octet_length(text) >= {length}")
    repeated = materialize(_seeds(docs, length, seed), "suffix-seeds")
    blocks = materialize(_blocks(docs, length, seed, SeedFilter(repeated)), "suffix-blocks")
    covered = _doubled(blocks)
    state = blocks.select("pos", "t1", "t2", "lo", "strings", "anchor", "seed").join(covered, "pos", "left")
    state = materialize(state, "suffix-state")
    freed(docs.sparkSession)
    whole = state.where("rank IS NOT NULL").select("t1", "t2", F.col("lo").alias("from"), (F.col("lo") + F.col("strings") - 1 + length).alias("to"))

    # Open blocks, and of the covered ones that of each rank.
    part = state.where("rank IS NULL OR rank = pos")
    open_seeds = part.groupBy("seed").agg(F.count("*").alias("size"), F.bool_or(F.col("rank").isNull()).alias("open")).where("size > 1 AND open").drop("open")
    part = part.join(open_seeds, "seed")
    flat = F.flatten(F.collect_list(F.array("pos", "seed", "size", "lo", "strings", "anchor"))).alias("open")
    # One of equal texts, chosen before the shuffle where copies meet.
    texts = docs.select("t1", "t2", "text").dropDuplicates(["t1", "t2"]).join(part.groupBy("t1", "t2").agg(flat), ["t1", "t2"])
    context = materialize(texts.mapInPandas(_context(length), _CONTEXT), "suffix-open")
    freed(docs.sparkSession)
    few = context.where(f"size <= {together}").repartition("seed").sortWithinPartitions("seed").mapInPandas(_compare(length), "t1 long, t2 long, from long, to long")
    return whole.unionByName(few).unionByName(_compare_many(context.where(f"size > {together}"), length))


def remove_repeats(documents: DataFrame, length: int = LENGTH, together: int = TOGETHER) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (begin and end of each removed run, in bytes, one after the other) and kept (the other bytes) of every document."""
    spark = documents.sparkSession
    small_batches(spark)
    text = F.col("text").cast("string")
    docs = documents.select(*id_columns(), text.alias("text"), F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2"))
    ranges = repeated_ranges(docs, length, together)
    flat = F.flatten(F.transform(F.sort_array(F.collect_set(F.struct("from", "to"))), lambda x: F.array(x["from"], x["to"])))
    # Copies of a text have equal ranges, which are combined before they are shuffled.
    of_text = materialize(ranges.groupBy("t1", "t2").agg(flat.alias("ranges")), "suffix-ranges")
    freed(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches):
            rows = []
            for raw, ranges in zip(_utf8(batch["text"]), batch["ranges"], strict=True):
                if ranges is None:
                    rows.append((len(raw), 0, 0, [], raw))
                    continue
                begin, end = np.asarray(ranges, np.int64).reshape(-1, 2).T
                end = np.maximum.accumulate(end)
                new = np.append(True, begin[1:] > end[:-1])
                begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                view = memoryview(raw)
                kept = b"".join(view[i:j] for i, j in zip([0, *end.tolist()], [*begin.tolist(), len(raw)], strict=True))
                rows.append((len(raw), int((end - begin).sum()), len(begin), np.stack([begin, end], 1).ravel(), kept))
            frame = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "spans", "kept"])
            frame.insert(0, "doc_id", ids_of(batch))
            yield frame

    joined = docs.join(of_text, ["t1", "t2"], "left").select("doc_id", "no_id", "text", "ranges")
    return joined.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary")
