"""Concentration of citations in fixed windows after publication.

Papers are shuffled once, into value frequencies; everything after that is a
re-aggregation of that small table. Sums are exact integers and each measure is
one division at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..bounds import Bounds
from .works import UNCLASSIFIED, cited_group, subfield_bucket

CELL = ["publication_year", "citation_age"]


def paper_windows(works: DataFrame, bounds: Bounds, first_age: int = 1, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row for each paper and observable age with its citations in years first_age..age after publication, and those of year 0.

    Entries are summed inside the row, so a paper without entries stays and nothing is shuffled. carried: further columns of works to keep.
    """
    cohort = works.where(F.col("publication_year").between(bounds.cohort_min, bounds.cohort_max))
    ages = F.explode(F.expr(f"sequence(1, cast({bounds.cohort_citation_max} - publication_year AS int))"))
    rows = cohort.select("id", "publication_year", "primary_topic_subfield_id", *carried, "counts_by_year", ages.alias("citation_age"))
    total = "aggregate(filter(coalesce(counts_by_year, array()), e -> e.cited_by_count > 0 AND e.year BETWEEN publication_year + {} AND publication_year + {}), 0L, (s, e) -> s + e.cited_by_count)"
    return rows.select(
        "id", "publication_year", "primary_topic_subfield_id", *carried, F.col("citation_age").cast("long").alias("citation_age"),
        F.expr(total.format(first_age, "citation_age")).alias("window_citations"), F.expr(total.format(0, 0)).alias("age0_citations"),
    )


def value_frequencies(windows: DataFrame, carried: tuple[Column, ...] = ()) -> DataFrame:
    """Papers for each raw subfield, cell and window value, with what the diagnostics need and further aggregates."""
    return windows.groupBy("primary_topic_subfield_id", *CELL, "window_citations").agg(
        F.count("*").alias("papers"), F.sum("age0_citations").alias("age0"), F.count_if(F.col("window_citations") + F.col("age0_citations") == 0).alias("zero_with_age0"), *carried
    )


def regroup(frequencies: DataFrame, key: dict, carried: tuple[Column, ...] = ()) -> DataFrame:
    """Frequencies are additive: the same table at a coarser key."""
    return frequencies.groupBy(*[c.alias(name) for name, c in key.items()], *CELL, "window_citations").agg(
        *[F.sum(c).alias(c) for c in ("papers", "age0", "zero_with_age0")], *carried
    )


def measures(frequencies: DataFrame, keys: list[str], carried: tuple[Column, ...] = ()) -> DataFrame:
    """All measures of each cell from its value frequencies; the window and the sums share one partitioning."""
    cell = Window.partitionBy(*keys)
    ranked = frequencies.withColumns({
        "n": F.sum("papers").over(cell), "t": F.sum(F.col("window_citations") * F.col("papers")).over(cell),
        "z": F.sum(F.when(F.col("window_citations") == 0, F.col("papers")).otherwise(0)).over(cell),
        "below": F.coalesce(F.sum("papers").over(cell.orderBy("window_citations").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).withColumns({"above": F.col("n") - F.col("below") - F.col("papers"), "weight": F.col("window_citations") * F.col("papers")})
    def top(percent: int):  # noqa: E306
        wanted = F.expr(f"(n * {percent} + 99) div 100") - F.col("above")
        return F.sum(F.col("window_citations") * F.least("papers", F.greatest(wanted, F.lit(0))))

    sums = ranked.groupBy(*keys).agg(
        F.max("n").alias("n_papers"), F.max("t").alias("total_citations"), F.max("z").alias("z"),
        F.sum(F.col("weight") * (2 * F.col("below") + F.col("papers") - F.col("n"))).alias("g"),
        # Among the cited only: the zeros leave the ranks and the number.
        F.sum(F.when(F.col("window_citations") > 0, F.col("weight") * (2 * (F.col("below") - F.col("z")) + F.col("papers") - (F.col("n") - F.col("z"))))).alias("g_cited"),
        top(1).alias("top1"), top(5).alias("top5"), top(10).alias("top10"), F.sum("age0").alias("a0"), F.sum("zero_with_age0").alias("z0"), *carried,
    )
    over = lambda x, y: x / F.nullif(y, F.lit(0))
    n, t = F.col("n_papers"), F.col("total_citations")
    return sums.select(
        *sums.columns[len(sums.columns) - len(carried) :], *keys, "n_papers", "total_citations", (F.col("z") / n).alias("zero_share"), over(F.col("g"), n * t).alias("gini"), over(F.col("g_cited"), (n - F.col("z")) * t).alias("gini_cited_only"),
        *[over(F.col(f"top{k}"), t).alias(f"top{k}_share") for k in (1, 5, 10)], over(F.col("a0"), t + F.col("a0")).alias("age0_citation_share"), (F.col("z0") / n).alias("zero_share_including_age0"),
    )


def label_mapping(works: DataFrame, bounds: Bounds) -> DataFrame:
    """One stable label for each subfield of the cohorts: its greatest name, else its id."""
    cohort = works.where(F.col("publication_year").between(bounds.cohort_min, bounds.cohort_max))
    labels = cohort.groupBy("primary_topic_subfield_id").agg(F.max("primary_topic_subfield_display_name").alias("name"), F.bool_or("is_ai_strict").alias("is_ai_strict"), F.bool_or("is_ai_broad").alias("is_ai_broad"))
    id = subfield_bucket(F.col("primary_topic_subfield_id"))
    return labels.select(id.alias("subfield_id"), _label(id, F.col("name")).alias("subfield_display_name"), "is_ai_strict", "is_ai_broad")


def _label(id: Column, name: Column) -> Column:
    return F.when(id == UNCLASSIFIED, "Unclassified").otherwise(F.coalesce(name, id))


def concentration_by_subfield(works: DataFrame, bounds: Bounds, first_age: int = 1) -> DataFrame:
    """All measures by subfield; labels travel with the frequencies, so that works are read once, and are made equal over the few cells."""
    marks = ("is_ai_strict", "is_ai_broad")
    labels = (F.max("name").alias("name"), *[F.bool_or(c).alias(c) for c in marks])
    windows = paper_windows(works, bounds, first_age, ("primary_topic_subfield_display_name", *marks)).withColumnRenamed("primary_topic_subfield_display_name", "name")
    found = regroup(value_frequencies(windows, labels), {"subfield_id": subfield_bucket(F.col("primary_topic_subfield_id"))}, labels)
    own = Window.partitionBy("subfield_id")
    cells = measures(found, ["subfield_id", *CELL], labels)
    cells = cells.withColumns({"subfield_display_name": _label(F.col("subfield_id"), F.max("name").over(own)), **{c: F.bool_or(c).over(own) for c in marks}})
    return cells.select("publication_year", "subfield_id", "subfield_display_name", "is_ai_strict", "is_ai_broad", "citation_age", *_MEASURES)


def concentration_by_group(works: DataFrame, bounds: Bounds, first_age: int = 1) -> DataFrame:
    found = regroup(value_frequencies(paper_windows(works, bounds, first_age)), {"cited_group": cited_group(F.col("primary_topic_subfield_id"), bounds)})
    return measures(found, ["cited_group", *CELL]).select("publication_year", "cited_group", "citation_age", *_MEASURES)


_MEASURES = ["n_papers", "total_citations", "zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share", "age0_citation_share", "zero_share_including_age0"]

