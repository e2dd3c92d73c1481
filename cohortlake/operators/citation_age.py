"""Age of what is cited, by year of the citation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..bounds import Bounds
from .works import cited_group

GRAIN = ["citation_year", "cited_group"]


def eligible_events(works: DataFrame, bounds: Bounds) -> DataFrame:
    """One row for each positive entry in the window that does not precede publication: grain, age, weight, id."""
    rows = works.select("id", "publication_year", cited_group(F.col("primary_topic_subfield_id"), bounds).alias("cited_group"), F.inline("counts_by_year"))
    return rows.where(
        F.col("year").between(bounds.age_year_min, bounds.age_year_max) & (F.col("year") >= F.col("publication_year")) & (F.col("cited_by_count") > 0)
    ).select(F.col("year").alias("citation_year"), "cited_group", (F.col("year") - F.col("publication_year")).alias("age"), F.col("cited_by_count").alias("weight"), "id")


def weighted_quantiles(bins: DataFrame, keys: list[str], value: str, weight: str, quarters: dict[str, int], *more: Column) -> DataFrame:
    """For each name its discrete quantile: the least value whose running weight reaches that many quarters of the total; total too, and more aggregates of the bins."""
    cell = Window.partitionBy(*keys)
    ranked = bins.withColumns({
        "_total": F.sum(weight).over(cell),
        "_running": F.sum(weight).over(cell.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    reach = [F.min(F.when(4 * F.col("_running") >= k * F.col("_total"), F.col(value))).alias(name) for name, k in quarters.items()]
    return ranked.groupBy(*keys).agg(F.max("_total").alias("total"), *reach, *more)


def recency_columns(value: str, weight: str, limits: tuple[int, ...]) -> list[Column]:
    return [(F.sum(F.when(F.col(value) <= k, F.col(weight)).otherwise(0)) / F.sum(weight)).alias(f"share_within_{k}") for k in limits]


def citation_age_by_year(works: DataFrame, bounds: Bounds) -> DataFrame:
    # Works are aggregated once: in a citation year a work has one age, so its ages' distinct works add up.
    bins = eligible_events(works, bounds).groupBy(*GRAIN, "age").agg(F.sum("weight").alias("weight"), F.countDistinct("id").alias("works"))
    out = weighted_quantiles(
        bins, GRAIN, "age", "weight", {"p25_age": 1, "median_age": 2, "p75_age": 3}, F.sum("works").alias("cited_works"), *recency_columns("age", "weight", (2, 5, 10))
    ).withColumnRenamed("total", "citation_events")
    return out.select(*GRAIN, "citation_events", "cited_works", "p25_age", "median_age", "p75_age", "share_within_2", "share_within_5", "share_within_10")
