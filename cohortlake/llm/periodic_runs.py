"""Runs of repeated words in documents, by the branching-tandem test on enhanced suffix arrays.

A run is a stretch of words with smallest period q, words q apart being equal,
of at least max(LEAST, TIMES * q) words, that no neighbouring word extends.

Documents are dealt to tasks as they lie; no step shuffles. In a task the words
of many documents are numbered and laid side by side, each document behind a
mark of its own, and arrays over all of them are built at once:

1. the suffix array, by prefix doubling (positions sorted by pairs of ranks until
   all ranks differ); the ranks of each round give the LCP of neighbours;
2. the LCP intervals, as the previous and next smaller values of each LCP. An
   interval of several equal LCPs is split at each of them, so that each split has
   two sides and the side with fewer suffixes is known;
3. the branching-tandem test: for each split of depth d, each suffix i of the smaller
   side is kept where the inverse suffix array finds i + d or i - d on the other
   side. Such a pair shares exactly d words, so that a square of period d ends there
   and cannot be moved right. This is n log n tests in all;
4. each such square is moved left while the words d apart agree, which gives the
   stretch; of stretches with the same ends the least period stays.

Defined results: a null or empty text, or one without words, has no runs. Every
row gives one row, and rows that repeat a doc_id, or have none, are rows like
others. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_columns, ids_of, in_chunks, remember_only, small_batches, strings

#: Least words of a run, and least words in periods.
LEAST, TIMES = 6, 4
#: Characters of documents whose arrays are built together; a longer document is alone.
CHUNK_CHARS = 500_000


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of integers, its inverse, and the LCP of each suffix with that before it."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels, span = [rank], 1
    while True:
        key = rank * (n + 1)
        key[: n - span] += rank[span:] + 1
        by = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(key[by[1:]] != key[by[:-1]]))
        rank = np.empty(n, np.int64)
        rank[by] = new
        span *= 2
        if new[-1] == n - 1 or span >= n:
            break
        levels.append(rank)
    # Neighbours agree on the blocks whose ranks agree, from the longest on.
    lcp = np.zeros(n, np.int64)
    left, right = by[:-1].copy(), by[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        level = np.append(levels[k], -1)
        inside = (left < n) & (right < n)
        same = inside & (level[np.minimum(left, n)] == level[np.minimum(right, n)])
        lcp[1:] += same << k
        left, right = left + (same << k), right + (same << k)
    return by, rank, lcp


def nearest_smaller(values: np.ndarray, strict: bool) -> np.ndarray:
    """For each value the nearest index before it with a smaller (or, not strict, no larger) value, else -1."""
    at = np.arange(len(values)) - 1
    padded = np.append(values, -1)  # index -1 reads this
    open_ = np.flatnonzero(padded[at] >= values) if strict else np.flatnonzero(padded[at] > values)
    while len(open_):
        at[open_] = at[at[open_]]
        there = padded[at[open_]]
        open_ = open_[there >= values[open_] if strict else there > values[open_]]
    return at


def branching_squares(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and period of every square, of a period up to `longest`, that cannot be moved right."""
    n = len(words)
    by, place, lcp = suffix_array(words)
    # A split k parts the suffixes [low, k) from [k, high) at depth lcp[k].
    split = np.flatnonzero((lcp > 0) & (lcp <= longest))
    low = nearest_smaller(lcp, True)[split]
    high = n - 1 - nearest_smaller(lcp[::-1], False)[::-1][split]
    low = np.maximum(low, 0)
    depth = lcp[split]
    left_is_less = split - low <= high - split
    first = np.where(left_is_less, low, split)
    count = np.where(left_is_less, split - low, high - split)
    other_first, other_end = np.where(left_is_less, split, low), np.where(left_is_less, high, split)
    starts, periods = [], []
    # The smaller sides, some at a time, as they hold up to n log n suffixes.
    total = np.cumsum(count)
    begin = 0
    while begin < len(split):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + 2_000_000, "right")))
        here = np.repeat(np.arange(begin, end), count[begin:end])
        offset = np.arange(len(here)) - np.repeat(np.cumsum(count[begin:end]) - count[begin:end], count[begin:end])
        i, d = by[first[here] + offset], depth[here]
        for start, partner in ((i, i + d), (i - d, i - d)):
            fits = (partner >= 0) & (partner < n)
            at = place[np.clip(partner, 0, n - 1)]
            fits &= (at >= other_first[here]) & (at < other_end[here])
            starts.append(start[fits])
            periods.append(d[fits])
        begin = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def runs(words: np.ndarray, document: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """start, end, period of the runs of words laid side by side, by start, then period; `document` numbers each word's document.

    Words that part documents are unlike all others.
    """
    if len(words) < least:
        return np.empty((0, 3), np.int64)
    sizes = np.bincount(document)
    start, period = branching_squares(words, max(1, int(sizes.max()) // times))
    end = start + 2 * period
    # Squares are moved left while the words a period apart agree: a block of squares further at each step.
    reach, live, block = start.copy(), np.arange(len(start)), 8
    while len(live):
        back = reach[live][:, None] - 1 - np.arange(block)
        same = (back >= 0) & (words[np.maximum(back, 0)] == words[np.maximum(back, 0) + period[live][:, None]])
        moved = np.where(same.all(axis=1), block, np.argmin(same, axis=1))
        reach[live] -= moved
        live = live[moved == block]
        block = min(2 * block, max(8, 4_000_000 // max(1, len(live))))
    length = end - reach
    fits = length >= np.maximum(least, times * period)
    found = np.stack([reach[fits], period[fits], end[fits]], 1)
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    new = np.append(True, (found[1:, [0, 2]] != found[:-1, [0, 2]]).any(axis=1))[: len(found)]
    found = found[new]
    return found[np.lexsort((found[:, 1], found[:, 0]))][:, [0, 2, 1]]


def in_runs(size: int, found: np.ndarray) -> np.ndarray:
    """Which of the words some run contains after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    return np.cumsum(change)[:-1] > 0


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


_RESULT = "doc_id long, n_words long, n_runs long, runs array<long>, collapsed string"


def periodic_runs(documents: DataFrame, rewrite: Callable[[int, np.ndarray], np.ndarray] | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, n_runs, runs (start, end, period of each, by start, then period) and collapsed (the text with each run cut to its first period) of every document.

    `rewrite` gives, for a doc_id and the numbers of a document's words, the words
    to take in their place.
    """
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("runs")
        for batch in in_chunks(batches, most=CHUNK_CHARS):
            numbers, texts, laid = _Numbers(), [], []
            for doc_id, none, text in zip(batch["doc_id"].tolist(), batch["no_id"].tolist(), batch["text"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                order = np.arange(len(words))
                if rewrite and words and not none:
                    order = rewrite(doc_id, order)
                    words = [words[i] for i in order.tolist()]
                texts.append(words)
                laid.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            sizes = np.array([len(x) for x in laid])
            begin = np.cumsum(np.append(0, sizes + 1))[:-1]
            flat = np.empty(int(sizes.sum()) + len(sizes), np.int64)
            for i, (b, x) in enumerate(zip(begin.tolist(), laid, strict=True)):
                flat[b : b + len(x)] = x
                flat[b + len(x)] = -1 - i  # a mark that is like no word
            document = np.repeat(np.arange(len(sizes)), sizes + 1)
            found = runs(flat, document, least, times)
            of = document[found[:, 0]]
            low, high = np.searchsorted(of, np.arange(len(sizes))), np.searchsorted(of, np.arange(len(sizes)), "right")
            rows = []
            for words, b, i, j in zip(texts, begin.tolist(), low.tolist(), high.tolist(), strict=True):
                own = found[i:j] - [b, b, 0]
                if i < j:
                    words = [w for w, gone in zip(words, in_runs(len(words), own).tolist(), strict=True) if not gone]
                rows.append((len(laid[len(rows)]), j - i, own.ravel(), b" ".join(words).decode("utf-8", "surrogatepass")))
            frame = pd.DataFrame({"n_words": [r[0] for r in rows], "n_runs": [r[1] for r in rows], "runs": [r[2] for r in rows], "collapsed": strings(r[3] for r in rows)})
            frame.insert(0, "doc_id", ids_of(batch))
            yield frame

    return documents.select(*id_columns(), F.col("text").cast("string")).mapInPandas(run, _RESULT)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli, and sha256 of the runs' lines and of the collapsed text."""
    each = F.expr("transform(sequence(0, cast(n_runs as int) - 1), k -> struct(runs[3 * k + 1] - runs[3 * k] as length, -runs[3 * k] as start, -runs[3 * k + 2] as period))")
    longest = F.when(F.col("n_runs") > 0, F.array_max(each))
    lines = F.expr("concat_ws('', transform(sequence(0, cast(n_runs as int) - 1), k -> concat_ws(',', runs[3 * k], runs[3 * k + 1] - runs[3 * k], runs[3 * k + 2]) || '\n'))")
    return found.withColumn("longest", longest).select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, lines).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
