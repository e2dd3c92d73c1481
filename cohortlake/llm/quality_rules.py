"""Quality rules as a short-circuit cascade, with DataFrame functions only.

The word statistics of each text are computed in its row. The rules are
predicates over them and over the text; a document is kept if none rejects it.
On a bounded sample every rule's cost (seconds of its predicate over repeated
rows, less those of reading them) and its verdicts are measured. The first rule
is that with the most rejections per cost; each next one is chosen by what it
rejects of the rows that the earlier ones leave. The rules are joined by AND in
this order, so that a document stops at the first rule that rejects it. The
order has no influence on the verdict. `filter_quality` counts repeated words,
by far the dearest statistic, only in documents that all rules pass.

Repeated words are found in the row as well: window hashes with their positions
are sorted as integers and equal neighbours are compared by their words. Where
hashes that differ share their sorted bits, or the text has 2^21 words or more,
the windows themselves are sorted.

Defined results: a null text has no words; all its counts are 0 and it fails
the base. Every row of the input gives one row, repeated rows too. Other
columns are kept by `with_statistics` and `filter_quality`, whatever their
names; of columns with the names of the statistics the new ones win in the
former, and none are added in the latter. An empty table gives no rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialize

#: Documents, in the mean of the draw, on which costs and selectivities are measured, and times that each predicate is run over them.
SAMPLE_DOCS = 2_000
REPEATS = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
_BITS = 21


@dataclass(frozen=True)
class Rule:
    """A name and a SQL predicate that is true for documents to reject."""

    name: str
    rejects: str


#: Over _text, _words and the statistics.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > size(split(_text, '\\n'))"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    # Distinct words grow more slowly than a text, about with its root.
    Rule("few_distinct_words", "10 * size(array_distinct(_words)) < n_words AND size(array_distinct(_words)) < 2 * sqrt(n_words)"),
    Rule("capitals", "2 * length(regexp_replace(_text, '[^\\\\p{Lu}]+', '')) > word_chars"),
    Rule("no_letters", "2 * length(regexp_replace(_text, '[^\\\\p{L}]+', '')) < word_chars"),
    Rule("exclamations", "10 * length(regexp_replace(_text, '[^!?]+', '')) > word_chars"),
)


def base_expression() -> str:
    return "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _same_words(a: str, b: str) -> str:
    return " AND ".join(f"get(_words, {a}{k}) = get(_words, {b}{k})" for k in ("", " + 1", " + 2"))


def _fenced(df: DataFrame, names: list[str]) -> DataFrame:
    """df with these columns behind a generator: a filter over them must not be moved below them, where it would compute them anew for each use."""
    return df.select("_row", F.inline(F.array(F.struct(*names))))


def _cheap(documents: DataFrame, text: str) -> DataFrame:
    """_row (all columns of documents), _text, _words and the statistics that one look at the text gives."""
    df = documents.select(F.struct("*").alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", f"[{SPACE}]+"), ""))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.regexp_replace("_text", f"[{SPACE}]+", "")).cast("long"))
    df = df.withColumn("n_symbols", (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]+", ""))).cast("long"))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    return df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))


def _repeats(df: DataFrame) -> DataFrame:
    """df with n_repeat_words."""
    mask = (1 << _BITS) - 1
    # Hash of each window above its position, sorted.
    df = df.withColumn("_keys", F.expr(
        f"CASE WHEN n_words >= 3 AND n_words < {1 << _BITS} THEN sort_array(transform(sequence(0, cast(n_words AS int) - 3),"
        f" i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), {_BITS}) | i)) ELSE cast(array() AS array<bigint>) END"
    ))
    df = df.withColumn("_equal", F.expr(
        f"CASE WHEN size(_keys) < 2 THEN cast(array() AS array<int>) ELSE filter(sequence(1, size(_keys) - 1),"
        f" k -> shiftright(_keys[k], {_BITS}) = shiftright(_keys[k - 1], {_BITS})) END"
    ))
    a, b = f"cast(_keys[k - 1] & {mask} AS int)", f"cast(_keys[k] & {mask} AS int)"
    df = df.withColumn("_mixed", F.expr(f"n_words >= {1 << _BITS} OR exists(_equal, k -> NOT ({_same_words(a, b)}))"))
    exact = "array_sort(transform(sequence(0, cast(n_words AS int) - 3), i -> named_struct('a', _words[i], 'b', _words[i + 1], 'c', _words[i + 2], 'i', i)))"
    df = df.withColumn("_sorted", F.expr(f"CASE WHEN _mixed THEN {exact} END"))
    same = "_sorted[k].a = _sorted[k - 1].a AND _sorted[k].b = _sorted[k - 1].b AND _sorted[k].c = _sorted[k - 1].c"
    df = df.withColumn("_at", F.expr(
        f"CASE WHEN _mixed THEN sort_array(flatten(transform(filter(sequence(1, size(_sorted) - 1), k -> {same}), k -> array(_sorted[k - 1].i, _sorted[k].i))))"
        f" WHEN size(_equal) = 0 THEN cast(array() AS array<int>)"
        f" ELSE sort_array(flatten(transform(_equal, k -> array({a}, {b})))) END"
    ))
    # Windows cover min(3, distance to the window before) further words each.
    df = df.withColumn("n_repeat_words", F.expr(
        "cast(aggregate(_at, named_struct('before', -3, 'sum', 0), (s, p) -> named_struct('before', p, 'sum', s.sum + least(3, p - s.before)), s -> s.sum) AS bigint)"
    ))
    return df


def _measured(documents: DataFrame, text: str) -> DataFrame:
    df = _fenced(_repeats(_cheap(documents, text)), ["_text", "_words", *STATISTICS[:-1]])
    return df.withColumn("base_failed", F.expr(base_expression()))


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with the statistics of base and counts."""
    kept = [F.col("_row")[c].alias(c) for c in documents.columns if c not in STATISTICS]
    return _measured(documents, text).select(*kept, *STATISTICS)


def greedy_order(rejects: np.ndarray, costs: np.ndarray) -> list[int]:
    """Columns of rejects (rows x rules) by rejections per cost among the rows that earlier ones leave; ties by cost, then by number."""
    left, order = np.ones(len(rejects), bool), []
    while len(order) < len(costs):
        rest = [k for k in range(len(costs)) if k not in order]
        best = min(rest, key=lambda k: (-rejects[left, k].sum() / costs[k], costs[k], k))
        order.append(best)
        left &= ~rejects[:, best]
    return order


def plan_cascade(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """The rules in the order of the cascade, measured on a bounded sample."""
    total = documents.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    texts = documents.select(F.col("text").alias("_sampled"))
    drawn = _fenced(_cheap(texts.sample(fraction=share, seed=1) if share < 1 else texts, "_sampled"), ["_text", "_words", *STATISTICS[:4]])
    sample = materialize(drawn.where("n_words >= 50").drop("_row"), "quality-sample")
    rejects = sample.select(*[F.expr(r.rejects).alias(r.name) for r in rules]).toPandas().to_numpy(bool).reshape(-1, len(rules))
    repeated = sample.withColumn("_time", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(predicate: str) -> float:
        start = time.perf_counter()
        repeated.agg(F.count_if(F.expr(predicate))).first()
        return time.perf_counter() - start

    seconds("n_words < _time")  # the first job also compiles
    base = seconds("n_words < _time")
    costs = np.array([max(1e-3, seconds(r.rejects) - base) for r in rules])
    return [rules[k] for k in greedy_order(rejects, costs)]


def passes(rules: list[Rule], base: tuple[str, ...] = ("NOT base_failed",)):
    """A column: base passed and no rule rejects; evaluated from left to right."""
    return F.expr(" AND ".join([*base, *(f"NOT ({r.rejects})" for r in rules)]))


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of every document."""
    order = plan_cascade(documents, rules)
    return _measured(documents.select("doc_id", "text"), "text").select(F.col("_row.doc_id").alias("doc_id"), *STATISTICS, passes(order).alias("kept"))


def filter_quality(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """documents, all columns, that the cascade keeps."""
    order = plan_cascade(documents, rules)
    cheap = ["_text", "_words", *STATISTICS[:4]]
    left = _fenced(_cheap(documents, "text"), cheap).where(passes(order, ("n_words >= 50",)))
    return _fenced(_repeats(left), ["n_words", "n_repeat_words"]).where(f"NOT ({base_expression()})").select("_row.*")
