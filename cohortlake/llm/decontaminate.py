"""Benchmark decontamination over a positional inverted index of the documents.

`build_index` cuts the documents into blocks. Each block is one row: its
documents with their word counts, its terms, and for each term its postings, the
ascending positions of its tokens in the block. The rows are stored in the shared
folder, once for all that is searched. `search` looks the windows of the test items up by
the term of each that is rarest in the whole corpus, so that a block only deals with
windows whose rarest term it holds. Each posting of that term, less the term's offset, is a
candidate for the window's start; it is intersected with the offset-adjusted postings
of the other terms, from the rarest in the block to the most frequent, until no candidate
or an exact phrase is left. For proximity matches all terms of a window must lie
within `span` positions of a token of its rarest term, in one document.

Only terms of the benchmark get postings, as no others are looked up, while the
distinct terms have at most MOST_ITEM_BYTES; beyond that all terms do. The windows
are sent to all tasks while their items' text is at most MOST_ITEM_BYTES; a larger
benchmark is searched in slices of that size in the same index, one after the other,
and the slices' spans are united. Blocks are bounded by characters, so that no
group of documents, however common its passages, meets in one task.

Words are runs of a-z, digits and non-ASCII characters after A-Z are lowered.

Defined results: null or empty texts have no words and no hits. Items without
words have no window and are never found. Every row of the documents gives one
row, repeated ones too; a null doc_id stays null. Items that repeat an item_id
count once; those with a null one mark hits, but are in no item list. No item:
item list empty, whose digest is that of no bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_columns, in_chunks, materialize, numbered, remember_only, small_batches

WINDOW = 13
#: Text of test items sent to every task at once.
MOST_ITEM_BYTES = 32 << 20
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_INDEX = "block string, row_ids array<long>, no_ids array<boolean>, row_numbers array<long>, lengths array<int>, terms array<binary>, counts array<int>, positions binary"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def build_index(documents: DataFrame, terms: frozenset[bytes] | None = None) -> DataFrame:
    """The stored index of documents with a column row; with `terms` only their postings are kept, which is all that a search for them reads."""
    spark = documents.sparkSession
    small_batches(spark, "1m")
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("decontamination")
        known = shared.value
        for batch in in_chunks(batches):
            ids: dict[bytes, int] = {} if known is None else {t: i for i, t in enumerate(sorted(known))}
            lengths, tokens = [], []
            for text in batch["text"]:
                words = words_of(text)
                lengths.append(len(words))
                if known is None:
                    tokens += [ids.setdefault(w, len(ids)) for w in words]
                else:
                    tokens += map(ids.get, words)
                tokens.append(None)  # no phrase crosses documents
            at = np.fromiter((-1 if t is None else t for t in tokens), np.int32, len(tokens))
            held = np.flatnonzero(at >= 0)
            held = held[np.argsort(at[held], kind="stable")]
            numbers, counts = np.unique(at[held], return_counts=True)
            names = list(ids)
            yield pd.DataFrame({
                "block": [""], "row_ids": [batch["doc_id"].to_numpy()], "no_ids": [batch["no_id"].to_numpy()], "row_numbers": [batch["row"].to_numpy()], "lengths": [np.array(lengths, np.int32)],
                "terms": [[names[i] for i in numbers]], "counts": [counts.astype(np.int32)], "positions": [held.astype("<u4").tobytes()],
            })

    rows = documents.select(*id_columns(), F.col("row"), F.col("text").cast("string")).mapInPandas(run, _INDEX)
    return materialize(rows, "positional-index")


class Windows:
    """Distinct windows of test items as rows of term numbers, -1 beyond a short item's end, found by one term each."""

    def __init__(self, items: list[tuple[int | None, str]], width: int):
        self.ids: list[int | None] = []
        found: dict[tuple, set[int]] = {}
        for item, text in items:
            words = words_of(text)
            if words:
                number = len(self.ids)
                self.ids.append(item)
                for i in range(max(1, len(words) - width + 1)):
                    found.setdefault(tuple(words[i : i + width]), set()).add(number)
        self.terms = sorted({w for x in found for w in x})
        number_of = {w: i for i, w in enumerate(self.terms)}
        self.items = [sorted(v) for v in found.values()]
        self.table = np.full((len(found), width), -1, np.int32)
        for row, words in zip(self.table, found, strict=True):
            row[: len(words)] = [number_of[w] for w in words]
        self.lengths = (self.table >= 0).sum(axis=1)
        self.look_up({})

    def look_up(self, totals: dict[bytes, int]) -> None:
        """Let each window be found by its term with the least total; terms without one are in no block."""
        count = np.array([totals.get(t, 0) for t in self.terms], np.int64)
        ranked = np.where(self.table >= 0, count[self.table] if len(count) else 0, np.iinfo(np.int64).max)
        by = np.argpartition(ranked, min(1, ranked.shape[1] - 1), axis=1)[:, :2] if len(ranked) else np.empty((0, 2), np.int64)
        by = np.take_along_axis(by, np.argsort(np.take_along_axis(ranked, by, axis=1), axis=1, kind="stable"), axis=1) if len(ranked) else by
        self.offset, self.second = by[:, 0], by[:, -1]
        key = self.table[np.arange(len(self.table)), self.offset] if len(ranked) else np.empty(0, np.int64)
        self.by_key = np.argsort(key, kind="stable")
        self.key_ends = np.searchsorted(key[self.by_key], np.arange(len(self.terms) + 1))


class Block:
    """One row of the index, with term numbers of the windows."""

    def __init__(self, row, terms: dict[bytes, int]):
        self.row_ids = pd.arrays.IntegerArray(np.array(row.row_ids, np.int64), np.array(row.no_ids, bool))
        self.row_numbers, self.lengths = row.row_numbers, np.asarray(row.lengths, np.int64)
        self.size = int((self.lengths + 1).sum()) + 1
        counts = np.asarray(row.counts, np.int64)
        number = np.fromiter((terms.get(t, -1) for t in row.terms), np.int64, len(row.terms))
        begins = np.cumsum(counts) - counts
        known = np.flatnonzero(number >= 0)
        known = known[np.argsort(number[known])]
        self.terms, self.counts = number[known], counts[known]
        at = np.repeat(begins[known] - (np.cumsum(self.counts) - self.counts), self.counts) + np.arange(self.counts.sum())
        # All postings in one ascending array of (term, position).
        self.postings = np.repeat(self.terms, self.counts) * self.size + np.frombuffer(row.positions, "<u4")[at]
        self.begins = np.cumsum(self.counts) - self.counts
        self.first = np.cumsum(np.append(0, self.lengths + 1))[:-1]  # of each document

    def count_of(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(terms.shape, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.counts[at], 0)

    def candidates(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Each posting of the terms that windows are found by: window and position."""
        first, last = windows.key_ends[self.terms], windows.key_ends[self.terms + 1]
        per_term = last - first
        here = np.repeat(np.arange(len(self.terms)), per_term)
        window = windows.by_key[np.repeat(first - (np.cumsum(per_term) - per_term), per_term) + np.arange(per_term.sum())]
        times = self.counts[here]
        posting = np.repeat(self.begins[here] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        return np.repeat(window, times), self.postings[posting] % self.size

    def in_order(self, windows: Windows, window: np.ndarray) -> np.ndarray:
        """Offsets of the windows' terms from rare to frequent in this block."""
        table = windows.table[window]
        return np.argsort(np.where(table >= 0, self.count_of(table), np.iinfo(np.int64).max), axis=1, kind="stable")

    def held(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term has a posting from low to high."""
        return np.searchsorted(self.postings, terms * self.size + low) < np.searchsorted(self.postings, terms * self.size + high, "right")

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Exact occurrences: window and first position."""
        window, position = self.candidates(windows)
        start = position - windows.offset[window]
        ok = (start >= 0) & (start + windows.lengths[window] < self.size)
        window, start = window[ok], start[ok]

        def meets(at: np.ndarray) -> np.ndarray:
            wanted = windows.table[window, at].astype(np.int64)
            return (wanted < 0) | self.held(np.maximum(wanted, 0), start + at, start + at)

        # The corpus' second rarest term leaves few candidates, whose terms are then put in order.
        hit = meets(windows.second[window])
        window, start = window[hit], start[hit]
        order = self.in_order(windows, window)
        for k in range(order.shape[1]):
            hit = meets(order[:, k])
            window, start, order = window[hit], start[hit], order[hit]
        return window, start

    def near(self, windows: Windows, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the term that a window is found by with all other terms of the window within `span` positions, in the document."""
        window, position = self.candidates(windows)

        def meets(at: np.ndarray) -> np.ndarray:
            wanted = windows.table[window, at].astype(np.int64)
            doc = self.document(position)
            low, high = np.maximum(position - span, self.first[doc]), np.minimum(position + span, self.first[doc] + self.lengths[doc])
            return (wanted < 0) | self.held(np.maximum(wanted, 0), low, high)

        hit = meets(windows.second[window])
        window, position = window[hit], position[hit]
        order = self.in_order(windows, window)
        for k in range(order.shape[1]):
            hit = meets(order[:, k])
            window, position, order = window[hit], position[hit], order[hit]
        return window, position

    def document(self, position):
        return np.searchsorted(self.first, position, "right") - 1


def distinct_terms(benchmark: DataFrame, most: int) -> frozenset[bytes] | None:
    """All terms of the test items, or None where they have more than `most` bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches):
            yield pd.DataFrame({"term": list({w for text in batch["text"] for w in words_of(text)})}, dtype=object)

    found = materialize(benchmark.select(F.col("text").cast("string")).mapInPandas(run, "term binary").distinct(), "benchmark-terms")
    if (found.agg(F.sum(F.octet_length("term"))).first()[0] or 0) > most:
        return None
    return frozenset(bytes(r["term"]) for r in found.toLocalIterator())


def _slices(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int | None, str]]]:
    """Test items in slices of bounded text, each small enough to be sent to every task."""
    items, size = [], 0
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id")
    for row in rows.toLocalIterator():
        here = len(row["text"] or "") * 4
        if items and size + here > most:
            yield items
            items, size = [], 0
        items.append((row["item_id"], row["text"]))
        size += here
    yield items


def find_spans(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, near_span: int | None = None, most: int = MOST_ITEM_BYTES) -> DataFrame:
    """One row per document (doc_id, row, text) and slice of the benchmark: doc_id, row, n_words,
    starts and ends of the hit word spans, items found exactly, items found near (with near_span)."""
    spark = documents.sparkSession
    index = build_index(documents, distinct_terms(benchmark, most))
    totals = materialize(index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("n")), "index-totals")
    out = None
    for items in _slices(benchmark, most):
        windows = Windows(items, width)
        # As bounded as the slice; an Arrow table, as rows of Python would start further workers in the executors, which stay there.
        asked = spark.createDataFrame(pa.table({"term": pa.array(windows.terms, pa.binary())}))
        windows.look_up({bytes(r["term"]): r["n"] for r in totals.join(F.broadcast(asked), "term").collect()})
        shared = spark.sparkContext.broadcast(windows)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            windows = shared.value
            terms = {t: i for i, t in enumerate(windows.terms)}
            for batch in batches:
                for row in batch.itertuples(index=False):
                    block = Block(row, terms)
                    window, start = block.phrases(windows)
                    doc = block.document(start)
                    spans: dict[int, list] = {}
                    for d, w, s in zip(doc.tolist(), window.tolist(), (start - block.first[doc]).tolist(), strict=True):
                        spans.setdefault(d, []).append((w, s))
                    close: dict[int, set] = {}
                    if near_span is not None:
                        w_near, at = block.near(windows, near_span)
                        for d, w in zip(block.document(at).tolist(), w_near.tolist(), strict=True):
                            close.setdefault(d, set()).update(windows.items[w])
                    rows = []
                    for d, (number, length) in enumerate(zip(block.row_numbers, block.lengths, strict=True)):
                        hits = spans.get(d, [])
                        found = {i for w, _ in hits for i in windows.items[w]}
                        rows.append((
                            int(number), int(length), [s for _, s in hits], [s + int(windows.lengths[w]) for w, s in hits],
                            sorted({windows.ids[i] for i in found} - {None}), sorted({windows.ids[i] for i in close.get(d, set())} - {None}),
                        ))
                    frame = pd.DataFrame(rows, columns=["row", "n_words", "starts", "ends", "items", "near_items"])
                    frame.insert(0, "doc_id", block.row_ids)
                    yield frame

        small_batches(spark, "1m")
        part = index.mapInPandas(run, "doc_id long, row long, n_words long, starts array<long>, ends array<long>, items array<long>, near_items array<long>")
        out = part if out is None else out.union(part)
    return out


def _judge(found: DataFrame) -> DataFrame:
    """Per row: n_hit, n_items, digest and verdict."""

    # Words in the union of the spans, taken by their starts.
    hit_words = F.expr(
        "aggregate(array_sort(arrays_zip(starts, ends)), named_struct('n', 0L, 'last', 0L), (s, x) -> named_struct("
        "'n', s.n + greatest(0L, x.ends - greatest(x.starts, s.last)), 'last', greatest(s.last, x.ends)), s -> s.n)"
    )
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return (
        found.withColumn("n_hit", hit_words)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(listed, 256))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )


def _judged_rows(documents: DataFrame, benchmark: DataFrame, width: int, near_span: int | None, most: int) -> DataFrame:
    """The verdict of each row of documents (doc_id, row, text)."""
    found = find_spans(documents, benchmark, width, near_span, most)
    if _several(benchmark, most):
        # Slices of the benchmark: unite a row's spans and items.
        found = found.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
        )
    return _judge(found)


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, near_span: int | None = None, most: int = MOST_ITEM_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near of every document.

    contaminated: a word is hit, and a twentieth of the words or more.
    """
    bench = benchmark.select(F.col("item_id").cast("long"), "text").dropDuplicates(["item_id", "text"])
    docs = documents.select("doc_id", "text")
    # Row numbers unite the slices; a single one needs none that last.
    docs = numbered(docs) if _several(bench, most) else docs.withColumn("row", F.monotonically_increasing_id())
    judged = _judged_rows(docs, bench, width, near_span, most)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", F.size("near_items").cast("long").alias("n_near"))


def _several(benchmark: DataFrame, most: int) -> bool:
    return 4 * (benchmark.select(F.sum(F.length("text"))).first()[0] or 0) > most


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, most: int = MOST_ITEM_BYTES) -> DataFrame:
    """documents, all columns, without the contaminated ones; each row is judged by its own text, whatever its doc_id."""
    own = free_name(documents, "_row")
    docs = numbered(documents, own)
    bench = benchmark.select(F.col("item_id").cast("long"), "text").dropDuplicates(["item_id", "text"])
    gone = _judged_rows(docs.select("doc_id", F.col(own).alias("row"), "text"), bench, width, None, most).where("contaminated").select(F.col("row").alias(own))
    return docs.join(materialize(gone, "contaminated"), own, "left_anti").select(*documents.columns)
