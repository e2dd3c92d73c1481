"""Classified works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..bounds import Bounds
from ..schemas import WORKS

UNCLASSIFIED = "__unclassified__"


def classify(df: DataFrame, bounds: Bounds, column: str = "primary_topic_subfield_id") -> DataFrame:
    """Adds is_ai_strict and is_ai_broad, never null."""
    of = F.col(column)
    return df.withColumns({
        "is_ai_strict": F.coalesce(of == bounds.strict_id, F.lit(False)),
        "is_ai_broad": F.coalesce(of.isin(bounds.strict_id, bounds.broad_id), F.lit(False)),
    })


def silver_works(staged: DataFrame, bounds: Bounds) -> DataFrame:
    return classify(staged, bounds).select(*WORKS.fieldNames())


def cited_group(subfield: Column, bounds: Bounds) -> Column:
    """ai, cv_pr, or rest_cs for all others and null."""
    return F.when(subfield == bounds.strict_id, "ai").when(subfield == bounds.broad_id, "cv_pr").otherwise("rest_cs")


def subfield_bucket(subfield: Column) -> Column:
    """A bucket of its own for works without a subfield, so that no denominator loses them."""
    return F.coalesce(subfield, F.lit(UNCLASSIFIED))
