"""Alignment of the tokens of two tokenizers, with corpus-wide counts of the pairs of ids that overlap.

Every text is cut into tokens by a byte-level vocabulary (side A, of a space and
the text) and by a piece model (side B, which adds the space). Byte offsets where
tokens of both sides end part the text into groups; a link is an A and a B token
whose byte ranges overlap. A pair of ids counts in how many documents it is linked.

Both sides end a token before a space that follows no white space, so texts are
parted there, and each distinct part is encoded and aligned once for the texts that
hold it. Where a part's bytes come back changed, its whole text is encoded instead.

The counts are found by external spill counting, in the shared folder:

1. A task gathers records (pair, document, links) until there are SPILL of them,
   radix-partitions them by the A id, sorts each partition by (A id, B id, document)
   and writes them as one run: a file of zstd frames. A partition has the pairs with
   their numbers of documents, and apart from these the documents and links.
2. For every partition tasks merge the pairs of the runs by k-way heaps of about
   half FAN_IN, until one heap is left, and add up their documents. Pairs come in order of their
   A ids, so the highest count of an A id is known when the next one begins; the
   count files have the pairs, counts and whether they are the highest.
3. A task for each run reads the count files beside the run's own pairs, both in the
   same order, and hands each document its counts. Nothing is shuffled: a document's
   records are all in one run. A pair that all documents hold is one entry of each run.

Memory is bounded by SPILL, FRAME and FAN_IN, whatever the number of documents or
distinct pairs. A rerun of a lost task writes the same files under the same names.

Defined results: null and empty texts, and those whose joined bytes of a side
differ from the space and the text, have no tokens and zeros. Each row is a document,
also where a doc_id repeats or is null. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_columns, in_chunks, materialize, new_path, open_file, remember_only, small_batches, strings, write_file
from .encoding import _WHITE, Encoder

#: Records of a run, pairs of a frame, runs merged at once, and partitions by A id.
SPILL = 1_000_000
FRAME = 1 << 16
FAN_IN = 64
RADIX = 32
#: Parts that a worker remembers, and characters that it cuts at once.
MOST_PARTS = 150_000
CHUNK_CHARS = 500_000

_PART = re.compile(f"(?<=[^{_WHITE}▁]) ")


def byte_values() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and what is known of parts: counts, links and groups."""

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece

        self.a = Encoder(vocabulary)
        self.a.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.added = None
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        value = byte_values()
        entries = self.a.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths = [np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes)]
        self.space = [self.b.piece_to_id("▁")]
        most = max(len(self.a_bytes), len(self.b_bytes))
        #: Every id with what may follow it: a further token of its side, the other side, the next group, the next part.
        self.put = np.array([[f"{i}{mark}" for i in range(most)] for mark in (",", "|", ";", "\n")], object)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.good = np.empty(0, bool)
        self.counts = np.empty((0, 3), np.int64)  # A tokens, B tokens, groups
        self.first = np.zeros(1, np.int64)  # of each part's links
        self.links = np.empty(0, np.int64)

    def keep(self, used: np.ndarray, most: int) -> None:
        """Forget all but the `most` parts with the most uses."""
        by = np.sort(np.argsort(-used, kind="stable")[:most])
        count = np.diff(self.first)
        at = np.repeat(self.first[by] - np.append(0, np.cumsum(count[by]))[:-1], count[by]) + np.arange(count[by].sum())
        names = list(self.number)
        self.number = {names[i]: k for k, i in enumerate(by.tolist())}
        self.groups = [self.groups[i] for i in by.tolist()]
        self.good, self.counts, self.links = self.good[by], self.counts[by], self.links[at]
        self.first = np.append(0, np.cumsum(count[by]))

    def learn(self, parts: list[str]) -> None:
        """Encode and align parts that are not known."""
        if not parts:
            return
        self.a.known, self.a.old = {}, {}
        self.a._learn(set(parts))
        a_raw = [self.a.known[p] for p in parts]
        self.a.known = {}
        b_ids = [x if p else self.space for x, p in zip(self.b.encode(parts, num_threads=1), parts, strict=True)]
        whole = [b" " + p.encode("utf-8", "surrogatepass") for p in parts]
        flat = [np.frombuffer(b"".join(a_raw), "<u4").astype(np.int64), np.fromiter(itertools.chain.from_iterable(b_ids), np.int64)]
        number = [np.array([len(x) // 4 for x in a_raw], np.int64), np.array([len(x) for x in b_ids], np.int64)]
        good = self._unchanged(whole, flat, number)
        if not good.all():
            flat = [ids[np.repeat(good, n)] for ids, n in zip(flat, number, strict=True)]
            number = [np.where(good, n, 0) for n in number]
        ends = [np.cumsum(lengths[ids]) for lengths, ids in zip(self.lengths, flat, strict=True)]
        # Each piece between neighbouring ends of either side is the overlap of one A and one B token.
        every = np.union1d(*ends)
        a_at, b_at = (np.searchsorted(e, every) for e in ends)
        links = flat[0][a_at] << 32 | flat[1][b_at]
        owner = np.repeat(np.arange(len(parts)), number[0])
        per_part = np.bincount(owner[a_at], minlength=len(parts))
        common = np.intersect1d(*ends, assume_unique=True)
        group_of = [np.searchsorted(common, e) for e in ends]
        groups = np.bincount(owner[np.searchsorted(ends[0], common)], minlength=len(parts))
        texts = iter(self._texts(flat, group_of, groups))
        self.number.update(zip(parts, range(len(self.groups), len(self.groups) + len(parts)), strict=True))
        self.groups += [next(texts) if n else "" for n in groups.tolist()]
        self.good = np.append(self.good, good)
        self.counts = np.concatenate([self.counts, np.stack([*number, groups], 1)])
        self.first = np.append(self.first, self.first[-1] + np.cumsum(per_part))
        self.links = np.append(self.links, links)

    def _unchanged(self, whole: list[bytes], flat: list[np.ndarray], number: list[np.ndarray]) -> np.ndarray:
        """Which parts' bytes both sides give back."""
        good = np.ones(len(whole), bool)
        size = np.array([len(x) for x in whole])
        joined = b"".join(whole)
        for names, lengths, ids, n in zip((self.a_bytes, self.b_bytes), self.lengths, flat, number, strict=True):
            total = np.append(0, np.cumsum(lengths[ids]))
            end = np.cumsum(n)
            same = total[end] - total[end - n] == size
            if not same.all() or b"".join(map(names.__getitem__, ids.tolist())) != joined:
                # Rare: part by part.
                tokens = ids.tolist()
                same &= [b"".join(map(names.__getitem__, tokens[j - k : j])) == x for x, j, k in zip(whole, end.tolist(), n.tolist(), strict=True)]
            good &= same
        return good

    def _texts(self, flat: list[np.ndarray], group_of: list[np.ndarray], groups: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2` of each part that has groups: every id is put down with what follows it, A before B in a group."""
        (a, b), (in_a, in_b), last_groups = flat, group_of, np.cumsum(groups)[groups > 0] - 1
        ends_part = np.zeros(int(groups.sum()), np.int64)
        ends_part[last_groups] = 1
        same_a, same_b = (np.append(x[1:] == x[:-1], False) for x in (in_a, in_b))
        n = len(ends_part)
        a_until, b_until = (np.cumsum(np.bincount(x, minlength=n)) for x in (in_a, in_b))
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.append(0, b_until)[in_a]] = self.put[np.where(same_a, 0, 1), a]
        out[np.arange(len(b)) + a_until[in_b] if len(b) else []] = self.put[np.where(same_b, 0, 2 + ends_part[in_b]), b]
        return "".join(out.tolist()).split("\n")

    def parts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's parts, none for a text without tokens."""
        cut = [_PART.split(t) if t else [] for t in texts]
        self.learn(list(set().union(*cut).difference(self.number)))
        find = self.number.__getitem__
        out = [np.fromiter(map(find, x), np.int64, len(x)) for x in cut]
        if self.good.all():
            return out
        changed = [i for i, x in enumerate(out) if not self.good[x].all()]
        self.learn(list({texts[i] for i in changed}.difference(self.number)))
        for i in changed:
            whole = self.number[texts[i]]
            out[i] = np.array([whole] if self.good[whole] else [], np.int64)
        return out


def _frames(path: str, offset: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs and their values, frame by frame, of a stretch of a file."""
    if not size:
        return
    with open_file(path) as source:
        source.seek(offset)
        end = offset + size
        while offset < end:
            length = int.from_bytes(source.read(8), "little")
            raw = zstandard.ZstdDecompressor().decompress(source.read(length))
            half = len(raw) // 2
            yield np.frombuffer(raw[:half], "<i8"), np.frombuffer(raw[half:], "<i8")
            offset += 8 + length


def _framed(pairs: np.ndarray, values: np.ndarray) -> Iterator[bytes]:
    for at in range(0, len(pairs), FRAME):
        raw = zstandard.ZstdCompressor(level=1).compress(pairs[at : at + FRAME].astype("<i8").tobytes() + values[at : at + FRAME].astype("<i8").tobytes())
        yield len(raw).to_bytes(8, "little") + raw


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in arrays))


class Run:
    """Records of documents until they are spilled."""

    def __init__(self):
        self.records: list[np.ndarray] = []
        self.documents: list[tuple] = []
        self.size = 0

    def add(self, aligner: Aligner, ids: list, none: list, parts: list[np.ndarray], with_groups: bool) -> np.ndarray:
        """Add documents; returns the numbers of all their parts."""
        base = len(self.documents)
        every = np.concatenate(parts) if parts else np.empty(0, np.int64)
        per_link = np.diff(aligner.first)
        for doc_id, no_id, x in zip(ids, none, parts, strict=True):
            text = ";".join([aligner.groups[i] for i in x.tolist()])
            sums = aligner.counts[x].sum(axis=0).tolist()
            digest = hashlib.sha256(text.encode()).digest() if len(x) else b""
            self.documents.append((doc_id, no_id, *sums, int(per_link[x].sum()), digest, text if with_groups else ""))
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        known = len(aligner.groups)
        code, times = np.unique(owner * known + every, return_counts=True)
        doc, part = code // max(1, known), code % max(1, known)
        count = per_link[part]
        at = np.repeat(aligner.first[part] - np.append(0, np.cumsum(count))[: len(part)], count) + np.arange(count.sum())
        self._gather(aligner.links[at], base + np.repeat(doc, count), np.repeat(times, count))
        return every

    def _gather(self, pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> None:
        by = np.lexsort((doc, pair))
        pair, doc, times = pair[by], doc[by], times[by]
        first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1]))[: len(pair)])
        if len(first):
            self.records.append(np.stack([pair[first], doc[first], np.add.reduceat(times, first)]))
            self.size += len(first)

    def spill(self, path: str, radix: int) -> tuple:
        """Write the run: path, ends of the partitions' pairs, ends of their documents, and end of the table of documents."""
        pair, doc, times = np.concatenate(self.records, axis=1) if self.records else np.empty((3, 0), np.int64)
        slot = (pair >> 32) & (radix - 1)
        by = np.lexsort((doc, pair, slot))
        pair, doc, times, slot = pair[by], doc[by], times[by], slot[by]
        bounds = np.searchsorted(slot, np.arange(radix + 1))
        new = np.append(True, pair[1:] != pair[:-1])[: len(pair)]
        out, pair_ends, doc_ends, size = [], [], [], 0
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            first = lo + np.flatnonzero(new[lo:hi])
            frames = list(_framed(pair[first], np.diff(np.append(first, hi))))
            size += sum(map(len, frames))
            pair_ends.append(size)
            body = _packed(doc[lo:hi].astype("<i4"), times[lo:hi].astype("<i4"))
            size += len(body)
            doc_ends.append(size)
            out += [*frames, body]
        table = pd.DataFrame(self.documents, columns=["doc_id", "no_id", "n_a", "n_b", "n_groups", "n_links", "digest", "groups"])
        body = zstandard.ZstdCompressor(level=1).compress(_table_bytes(table))
        write_file(path, [*out, body])
        return path, pair_ends, doc_ends, size + len(body)


def _table_bytes(table: pd.DataFrame) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(table, preserve_index=False)
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


_RUN = "path string, pair_ends array<long>, doc_ends array<long>, size long"


def spill_runs(documents: DataFrame, vocabulary: str, model: str, with_groups: bool = False, spill: int = SPILL, radix: int = RADIX) -> DataFrame:
    """Write the runs of the documents to files of the shared folder; a row for each."""
    small_batches(documents.sparkSession)
    folder = new_path(documents.sparkSession, "alignment-runs")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = remembered(vocabulary, model)
        part, number, now = TaskContext.get().partitionId(), 0, Run()
        made = []
        used = np.zeros(len(aligner.groups), np.int64)
        for batch in in_chunks(batches, most=CHUNK_CHARS):
            parts = aligner.parts(list(batch["text"]))
            every = now.add(aligner, batch["doc_id"].tolist(), batch["no_id"].tolist(), parts, with_groups)
            used = np.append(used, np.zeros(len(aligner.groups) - len(used), np.int64)) + np.bincount(every, minlength=len(aligner.groups))
            if len(used) > MOST_PARTS:
                aligner.keep(used, MOST_PARTS // 3)
                used = np.zeros(len(aligner.groups), np.int64)
            if now.size >= spill:
                made.append(now.spill(f"{folder}/part-{part:06d}-{number:06d}.run", radix))
                number, now = number + 1, Run()
        if now.documents:
            made.append(now.spill(f"{folder}/part-{part:06d}-{number:06d}.run", radix))
        yield pd.DataFrame(made, columns=["path", "pair_ends", "doc_ends", "size"])

    docs = documents.select(*id_columns(), F.col("text").cast("string"))
    return materialize(docs.mapInPandas(run, _RUN), "alignment-index")


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def remembered(vocabulary: str, model: str) -> Aligner:
    remember_only("aligner", _ALIGNERS.clear)
    key = vocabulary, model
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(vocabulary, model)
    return _ALIGNERS[key]


def _summed(streams: list) -> Iterator[tuple[int, int]]:
    """Pairs in order with the sums of their counts, by a heap over sorted streams."""
    now, total = None, 0
    for pair, count in heapq.merge(*streams):
        if pair != now:
            if now is not None:
                yield now, total
            now, total = pair, 0
        total += count
    if now is not None:
        yield now, total


def _highest(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Pairs with twice their count, and one more where it is the highest of the A id."""
    group: list[tuple[int, int]] = []
    for pair, count in pairs:
        if group and group[0][0] >> 32 != pair >> 32:
            most = max(n for _, n in group)
            yield from ((p, 2 * n + (n == most)) for p, n in group)
            group = []
        group.append((pair, count))
    if group:
        most = max(n for _, n in group)
        yield from ((p, 2 * n + (n == most)) for p, n in group)


def _blocks(pairs: Iterator[tuple[int, int]]) -> Iterator[bytes]:
    block: list[tuple[int, int]] = []
    for x in pairs:
        block.append(x)
        if len(block) == FRAME:
            yield from _framed(*np.array(block, np.int64).T)
            block = []
    if block:
        yield from _framed(*np.array(block, np.int64).T)


_STRETCH = "slot int, path string, offset long, size long"


def count_pairs(runs: DataFrame, radix: int = RADIX, fan_in: int = FAN_IN) -> DataFrame:
    """Merge the runs' pairs into count files: slot, path, offset, size; one row for each partition that has pairs."""
    spark = runs.sparkSession
    folder = new_path(spark, "alignment-counts")
    begins = F.expr("IF(k = 0, 0L, doc_ends[k - 1])")
    stretches = runs.select("path", "pair_ends", "doc_ends", F.posexplode("pair_ends").alias("k", "end")).select(
        F.col("k").alias("slot"), "path", begins.alias("offset"), (F.col("end") - begins).alias("size")
    ).where("size > 0")

    def merge(level: int, last: bool):
        def streams(rows):
            def pairs(path, offset, size):
                for keys, values in _frames(path, offset, size):
                    yield from zip(keys.tolist(), values.tolist(), strict=True)

            return [pairs(*x) for x in rows]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for slot, heap, paths, offsets, sizes in batch[["slot", "heap", "paths", "offsets", "sizes"]].itertuples(index=False):
                    found = _summed(streams(zip(paths, offsets, sizes, strict=True)))
                    path = f"{folder}/{level}-{slot:04d}-{heap:06d}.counts"
                    yield pd.DataFrame({"slot": [slot], "path": path, "offset": 0, "size": write_file(path, _blocks(_highest(found) if last else found))})

        return run

    level = 0
    while True:
        most = stretches.groupBy("slot").count().agg(F.max("count")).first()[0] or 0
        # A hash deals the streams to twice the heaps that would do, as some get more than their share.
        heaps = -(-2 * most // fan_in) if most > fan_in else 1
        numbered = stretches.withColumn("heap", F.pmod(F.xxhash64("path"), F.lit(max(1, heaps))).cast("int")) if heaps > 1 else stretches.withColumn("heap", F.lit(0))
        grouped = numbered.groupBy("slot", "heap").agg(
            *(F.expr(f"transform(array_sort(collect_list(struct(path, offset, size))), x -> x.{c})").alias(f"{c}s") for c in ("path", "offset", "size"))
        )
        stretches = materialize(grouped.repartition(max(1, radix * max(1, heaps)), "slot", "heap").mapInPandas(merge(level, heaps <= 1), _STRETCH), "alignment-merged")
        if heaps <= 1:
            return stretches
        level += 1


def pair_counts(counts: DataFrame) -> DataFrame:
    """a, b, documents and whether that is the highest count of a, for every linked pair, from the count files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, offset, size in batch[["path", "offset", "size"]].itertuples(index=False):
                for pairs, values in _frames(path, offset, size):
                    yield pd.DataFrame({"a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "documents": values >> 1, "highest": values & 1 == 1})

    return counts.mapInPandas(run, "a long, b long, documents long, highest boolean")


def contributions(runs: DataFrame, counts: DataFrame, radix: int = RADIX) -> DataFrame:
    """The documents of the runs with what the counts give them."""
    where = {r.slot: (r.path, r.offset, r.size) for r in counts.collect()}  # at most `radix` rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        for batch in batches:
            for path, pair_ends, doc_ends, size in batch[["path", "pair_ends", "doc_ends", "size"]].itertuples(index=False):
                with open_file(path) as source:
                    source.seek(doc_ends[-1])
                    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(source.read(size - doc_ends[-1]))).read_all().to_pandas()
                    best, total = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
                    for slot in range(radix):
                        begin, middle, end = doc_ends[slot - 1] if slot else 0, pair_ends[slot], doc_ends[slot]
                        own = list(_frames(path, begin, middle - begin))
                        if not own:
                            continue
                        pairs, times = map(np.concatenate, zip(*own, strict=True))
                        value = np.zeros(len(pairs), np.int64)
                        for keys, values in _frames(*where[slot]):
                            lo, hi = np.searchsorted(pairs, [keys[0], keys[-1] + 1])
                            value[lo:hi] = values[np.searchsorted(keys, pairs[lo:hi])]
                        source.seek(middle)
                        docs, links = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(end - middle)), "<i4").reshape(2, -1).astype(np.int64)
                        value = np.repeat(value, times)
                        np.add.at(best, docs, links * (value & 1))
                        np.add.at(total, docs, links * (value >> 1))
                for at in range(0, len(table), 2048):
                    part = table.iloc[at : at + 2048]
                    yield pd.DataFrame({
                        "doc_id": pd.arrays.IntegerArray(part["doc_id"].to_numpy(np.int64).copy(), part["no_id"].to_numpy(bool).copy()),
                        **{c: part[c].to_numpy() for c in ("n_a", "n_b", "n_groups", "n_links")}, "n_best": best[at : at + 2048], "count_sum": total[at : at + 2048],
                        "groups_sha256": strings(x.hex() for x in part["digest"]), "groups": strings(part["groups"]),
                    })

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    return runs.repartitionByRange(max(1, runs.count()), "path").mapInPandas(run, schema)


def align(documents: DataFrame, vocabulary: str, model: str, with_groups: bool = False, spill: int = SPILL, radix: int = RADIX, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked for, groups of every document.

    `groups` lists the ids of each group: `a1,a2|b1;a3|b2,b3`. n_best counts the links
    whose pair has the highest count of its A id, count_sum adds up the counts of all links.
    """
    runs = spill_runs(documents, vocabulary, model, with_groups, spill, radix)
    out = contributions(runs, count_pairs(runs, radix, fan_in), radix)
    return out if with_groups else out.drop("groups")
