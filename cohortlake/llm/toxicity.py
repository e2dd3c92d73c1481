"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if any sentence is: score = 1 -
(1 - leak) * prod(1 - p_sentence), the noisy-or. Only documents have labels; the
gradient of the document's likelihood reaches the sentences through the noisy-or,
and the fitted sentence scores then locate the offending sentences.

Of a sentence with the summed weight z of its known features, p = 1 - exp(-max(0,
z + bias)): a sentence without known features, or with too little weight, has
exactly no probability, so that clean texts do not become toxic by their length.
What labels leave unexplained is one leak of each document, not of each sentence.
Sentences with the same features count once, as saying a thing again is no new
evidence; a text and the same text a thousand times over score alike. The fit also
sees long clean documents, made of many clean ones. Where no sentence has a
probability the leak is graded by the mean of the sentences' logistic weights, which
orders such documents.

Features of a sentence are beginnings of its words (3 to 7 letters) and whole
short words, so that other endings of a known stem count as well. Which of them
are kept is decided by counts over the training documents.

The model is fitted on a bounded sample of labelled rows: about MOST_TRAINED of each
label, drawn by a hash of doc_id, as far as they have MOST_CHARS bytes of text. These
bounds hold for the fit alone; scoring covers every whole text.

Defined results: a null or empty text, or one without letters, scores 0. Labels
that are null, or whose document is missing, are not used. Without a toxic label
every score is 0. A repeated doc_id in the labels counts once for each label.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_columns, ids_of, in_chunks, remember_only, small_batches

#: Bounds of the fit: labelled documents of each label, features, rounds.
MOST_TRAINED = 8_000
MOST_CHARS = 32_000_000
MOST_FEATURES = 4_000
ROUNDS = 200
#: Long clean documents that the fit makes, and clean documents in each.
LONG_BAGS, LONG = 200, 30
THRESHOLD = 0.7

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    whole = word + "$"
    return [whole[:k] for k in range(3, min(7, len(whole)) + 1)] + ([whole] if 7 < len(whole) <= 12 else [])


class Model:
    """Weights of a sentence's features, their bias, and the leak of a document."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float = 0.0):
        self.weights, self.bias, self.leak = weights, bias, leak
        self._words: dict[str, tuple] = {}

    def __getstate__(self):
        return self.weights, self.bias, self.leak

    def __setstate__(self, state):
        self.__init__(*state)

    def features(self, word: str) -> tuple[str, ...]:
        if (found := self._words.get(word)) is None:
            if len(self._words) > 100_000:
                self._words.clear()
            found = self._words[word] = tuple(f for f in word_features(word) if f in self.weights)
        return found

    def known(self, text: str) -> frozenset[str]:
        """The known features of a sentence in lower case."""
        return frozenset(f for w in set(_WORD.findall(text)) for f in self.features(w))

    def weight(self, known: frozenset[str]) -> float:
        return self.bias + sum(self.weights[f] for f in sorted(known))

    def sentence(self, text: str) -> float:
        """Probability that this sentence, in lower case, is toxic."""
        known = self.known(text)
        return float(-np.expm1(-max(0.0, self.weight(known)))) if known else 0.0

    def document(self, text: str | None) -> float:
        """Noisy-or over the distinct sentences."""
        if not text or not self.weights:
            return 0.0
        lower = text.lower()
        found = {self.known(part) for part in _SENTENCE.findall(lower)}
        found.discard(frozenset())
        if not found and not _WORD.search(lower):
            return 0.0
        z = np.sort(np.array([self.weight(x) for x in found]))  # in one order, so that equal sets have equal sums
        grade = (1 / (1 + np.exp(-z))).mean() if len(z) else 0.0
        return float(-np.expm1(-(self.leak * grade + np.maximum(z, 0).sum())))


def _training(documents: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """text, toxic and weight of the bounded sample of labelled documents."""
    spark = documents.sparkSession
    own = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(usable).distinct()
    counts = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if len(counts) < 2:
        return spark.createDataFrame([], "text string, toxic int, weight double")
    share = {k: int(min(1.0, MOST_TRAINED / v) * (1 << 30)) for k, v in counts.items()}
    hashed = F.xxhash64("doc_id")
    drawn = own.where(F.pmod(hashed, F.lit(1 << 30)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # About 2 * MOST_TRAINED rows without their texts: which of them fit into the bytes is decided on the driver.
    found = docs.select("doc_id", F.octet_length("text").alias("size")).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"))
    found = found.select("doc_id", "toxic", "size", hashed.alias("order")).toPandas().sort_values(["toxic", "order", "doc_id"])
    held = found[found.groupby("toxic")["size"].cumsum() <= MOST_CHARS]
    if held["toxic"].nunique() < 2:
        return spark.createDataFrame([], "text string, toxic int, weight double")
    kept = held.groupby("toxic").size()
    # As an Arrow table: rows of Python would start further workers in the executors, which stay there.
    rows = pa.table({
        "doc_id": pa.array(held["doc_id"], pa.int64()), "toxic": pa.array(held["toxic"], pa.int32()),
        "weight": pa.array([counts[y] / int(kept[y]) for y in held["toxic"]], pa.float64()),
    })
    return docs.join(F.broadcast(spark.createDataFrame(rows)), "doc_id").select("text", "toxic", "weight")


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    remember_only("toxicity")
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    docs = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = set(_WORD.findall((text or "").lower()))
            counts[toxic].update({f for w in words for f in word_features(w)})
            docs[toxic] += 1
    names = list(counts[0] | counts[1]) + [""]
    yield pd.DataFrame({"feature": names, "clean": [counts[0][f] for f in names[:-1]] + [docs[0]], "toxic": [counts[1][f] for f in names[:-1]] + [docs[1]]})


def _bags(known: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                sentences = {tuple(sorted({known[f] for w in set(_WORD.findall(part)) for f in word_features(w) if f in known})) for part in _SENTENCE.findall((text or "").lower())}
                rows.append([i for x in sorted(sentences) if x for i in (*x, -1)])
            yield pd.DataFrame({"flat": rows, "toxic": batch["toxic"].to_numpy(), "weight": batch["weight"].to_numpy()})

    return run


def fit(documents: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Fit on the labelled documents for which `usable` (over doc_id) holds."""
    small_batches(documents.sparkSession, "1m")
    rows = _training(documents, labels, usable)
    counts = rows.mapInPandas(_count_features, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = counts.where("feature = ''").collect()
    if not totals or not totals[0]["clean"] or not totals[0]["toxic"]:
        return Model({}, 0.0)
    clean, toxic = totals[0]["clean"], totals[0]["toxic"]
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    strength = F.abs(F.col("toxic") / toxic - F.col("clean") / clean) / F.sqrt((F.col("toxic") + F.col("clean") + 1.0) / (toxic + clean))
    chosen = (
        counts.where("feature <> '' and toxic + clean >= 6").select("feature", odds.alias("odds"), strength.alias("strength"))
        .where("abs(odds) >= 1").orderBy(F.desc("strength"), "feature").limit(MOST_FEATURES).toPandas()
    )
    if not len(chosen):
        return Model({}, 0.0)
    known = {f: i for i, f in enumerate(chosen["feature"])}
    bags = rows.mapInPandas(_bags(known), "flat array<int>, toxic int, weight double").toPandas()
    bags = bags.assign(key=[bytes(np.asarray(x, np.int32)) for x in bags["flat"]]).sort_values(["toxic", "key"]).drop(columns="key")  # tasks end in any order
    weights, bias, leak = _descend(bags, np.clip(chosen["odds"].to_numpy(float), -3, 3) / 3)
    return Model(dict(zip(chosen["feature"], weights.tolist(), strict=True)), float(bias), float(leak))


def _descend(bags: pd.DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak of the likeliest labels under the noisy-or, by AdaGrad over all rows.

    The hinge of a sentence begins as a soft one, so that sentences below it still
    have a gradient, and sharpens over the rounds.
    """
    flats = [np.asarray(x, np.int64) for x in bags["flat"]]
    y, weight = bags["toxic"].tolist(), bags["weight"].tolist()
    clean = [k for k, label in enumerate(y) if label == 0]
    draw = np.random.default_rng(1)
    for _ in range(min(LONG_BAGS, len(clean) // 8)):
        flats.append(np.concatenate([flats[k] for k in draw.choice(clean, LONG)]))
        y.append(0)
        weight.append(1.0)
    lengths = np.array([len(x) for x in flats])
    flat = np.concatenate(flats)
    end = flat == -1
    sentence = (np.cumsum(end) - end)[~end]
    feature = flat[~end]
    document = np.repeat(np.arange(len(flats)), lengths)[end]
    y, weight = np.array(y, float), np.array(weight) / np.sum(weight)
    bias, leak, n_s = -0.5, -4.0, int(end.sum())  # the leak as a logarithm
    past = np.full(len(weights) + 2, 1e-8)
    for k in range(ROUNDS):
        sharp = 1 + 19 * min(1, k / (0.7 * ROUNDS))
        z = sharp * (bias + np.bincount(sentence, weights[feature], n_s))
        none = np.exp(leak) + np.bincount(document, np.logaddexp(0, z) / sharp, len(flats))  # -log of no toxic sentence
        outer = weight * np.where(y == 1, -np.exp(-none) / np.clip(-np.expm1(-none), 1e-9, 1), 1.0)
        g_z = outer[document] / (1 + np.exp(-np.clip(z, -50, 50)))
        g = np.concatenate([np.bincount(feature, g_z[sentence], len(weights)) + 3e-6 * weights, [g_z.sum(), outer.sum() * np.exp(leak)]])
        past += g * g
        step = 0.3 * g / np.sqrt(past)
        weights, bias, leak = weights - step[:-2], bias - step[-2], leak - step[-1]
    return weights, bias, np.exp(leak)


def score(model: Model, text: str = "text") -> Column:
    """The toxicity of each text, 0 to 1, as a column."""

    @F.pandas_udf("double")
    def noisy_or(texts: pd.Series) -> pd.Series:
        remember_only("toxicity")
        return pd.Series([model.document(t) for t in texts], dtype=float)

    return noisy_or(F.col(text).cast("string"))


def offending(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, start, length, sentence, score of the sentences that make documents toxic."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches):
            rows = [
                (i, m.start(), len(m[0]), m[0], p)
                for i, text in enumerate(batch["text"]) if text
                for m in _SENTENCE.finditer(text)
                if _WORD.search(m[0]) and (p := float(model.sentence(m[0].lower()))) >= least
            ]
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "sentence", "score"])
            yield frame.assign(doc_id=ids_of(batch)[frame["doc_id"].to_numpy(int)])

    return documents.select(*id_columns(), F.col("text").cast("string")).mapInPandas(run, "doc_id long, start long, length long, sentence string, score double")


def reject_toxic(documents: DataFrame, labels: DataFrame, usable: Column, threshold: float = THRESHOLD) -> DataFrame:
    """documents, all columns, without those that score at least the threshold."""
    model = fit(documents, labels, usable)
    return documents.where(score(model) < threshold)
