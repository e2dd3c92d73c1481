"""Corpus pipeline: toxicity, quality rules, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last keep the
columns of documents.

Defined results of every stage: each row is judged by its own text, so rows with
null or repeated doc_ids are rows like others; other columns, whatever their
names, are handed on as they are; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import materialize, table
from cohortlake.llm.decontaminate import remove_contaminated
from cohortlake.llm.jaccard_join import keep_one
from cohortlake.llm.packing import pack
from cohortlake.llm.quality_rules import filter_quality
from cohortlake.llm.queries import LEARNABLE, vocabulary
from cohortlake.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below the threshold; null and empty texts score 0 and stay."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"), F.expr(LEARNABLE))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that base and rules pass; null and empty texts have too few words and go."""
    return filter_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies; rows without words are near nothing and stay."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark passage, or little of one; null and empty texts stay."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row; a null or empty text is one piece with the end id."""
    return pack(docs, vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the learned score, the components or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
