"""Token counts of documents without their ids.

1. The distinct pre-tokens of the corpus are gathered with their frequencies, and
   the library counts the pieces of each once. Pre-tokens are the cuts before
   spaces of `encoding`; strings of added tokens are pre-tokens of their own.
2. Each document's pre-token frequencies are joined to the piece counts and
   summed. The most frequent pre-tokens, at most MOST_SENT of them, are sent to
   the tasks, so that their share of the join happens where the document is; the
   frequencies of all others are shuffled to their counts.

Defined results: a null or empty text has no bytes and no tokens. Every row of
the input gives one row; a null doc_id stays null. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_columns, ids_of, in_chunks, materialize, small_batches, strings
from .encoding import cut, encoder

#: Piece counts sent to every task, and distinct pre-tokens that a task gathers before it passes them on.
MOST_SENT = 400_000
MOST_GATHERED = 300_000


def pre_tokens(of, text: str) -> list[str]:
    out = []
    for segment in of.segments(text):
        first, *rest = cut(segment)
        if first:
            out.append(first)
        out += [" " + x for x in rest]
    return out


def vocabulary_counts(documents: DataFrame, vocabulary: str) -> DataFrame:
    """piece, n, pieces: each distinct pre-token, its frequency and its number of tokens."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, counts = encoder(vocabulary), Counter()
        for batch in in_chunks(batches):
            for text in batch["text"]:
                if text:
                    counts.update(pre_tokens(of, text))
            if len(counts) > MOST_GATHERED:
                yield pd.DataFrame({"piece": strings(counts), "n": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"piece": strings(counts), "n": list(counts.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = encoder(vocabulary)
        for batch in in_chunks(batches, "piece"):
            pieces = list(batch["piece"])
            yield pd.DataFrame({"piece": strings(pieces), "n": batch["n"].to_numpy(), "pieces": np.array(of.count(pieces), np.int64)})

    gathered = documents.select("text").mapInPandas(gather, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return materialize(gathered.mapInPandas(count, "piece string, n long, pieces long"), "piece-counts")


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(*id_columns(), F.col("text").cast("string"))
    counted = vocabulary_counts(docs, vocabulary)
    # Frequent pre-tokens first; a threshold on the frequency keeps the number sent below its bound.
    sent = counted.where("length(piece) <= 64").groupBy("n").count().orderBy(F.desc("n")).limit(100_000).toPandas()
    fits = sent["count"].cumsum() <= MOST_SENT
    least = int(sent.loc[fits, "n"].min()) if fits.any() else None
    frequent = counted.where(f"length(piece) <= 64 AND n >= {least}").select("piece", "pieces").toPandas() if least else pd.DataFrame({"piece": [], "pieces": []})
    shared = spark.sparkContext.broadcast(dict(zip(frequent["piece"], frequent["pieces"].astype(int), strict=True)))

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, known = encoder(vocabulary), shared.value
        for batch in in_chunks(batches):
            out = []
            for text in batch["text"]:
                tokens, rest = 0, Counter()
                for piece in pre_tokens(of, text) if text else ():
                    n = known.get(piece)
                    if n is None:
                        rest[piece] += 1
                    else:
                        tokens += n
                out.append((tokens, len(text.encode("utf-8", "surrogatepass")) if text else 0, list(rest), list(rest.values())))
            frame = pd.DataFrame(out, columns=["tokens", "n_bytes", "rest", "times"])
            frame.insert(0, "doc_id", ids_of(batch))
            yield frame

    rows = docs.mapInPandas(local, "doc_id long, tokens long, n_bytes long, rest array<string>, times array<long>")
    # A row's own number, as doc_id may repeat; kept with it in the written table.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "token-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("piece"), F.col("x.times").alias("times"))
    counts = counted.select("piece", "pieces") if least is None else counted.where(f"length(piece) > 64 OR n < {least}").select("piece", "pieces")
    summed = rare.join(counts, "piece").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    total = F.col("tokens") + F.coalesce("more", F.lit(0))
    return rows.select("row", "doc_id", "n_bytes", "tokens").join(summed, "row", "left").select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
