"""Yearly share of a category, in two variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..bounds import Bounds


def share_by_year(works: DataFrame, bounds: Bounds) -> DataFrame:
    """publication_year, variant, cs_works, ai_works, share, is_partial_year; one shuffle of a row for each year and task."""
    yearly = works.groupBy("publication_year").agg(F.count("*").alias("cs_works"), F.count_if("is_ai_strict").alias("strict"), F.count_if("is_ai_broad").alias("broad"))
    long = yearly.select("publication_year", "cs_works", F.expr("stack(2, 'strict', strict, 'broad', broad) AS (variant, ai_works)"))
    return long.select(
        "publication_year", "variant", "cs_works", "ai_works", (F.col("ai_works") / F.col("cs_works")).alias("share"),
        (F.col("publication_year") == bounds.partial_year).alias("is_partial_year"),
    )
