"""Analyses over the published aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..bounds import Bounds
from .concentration import concentration_by_group
from .works import UNCLASSIFIED

AGES = ["publication_year", "citation_age"]
MEASURES = ("zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share", "age0_citation_share", "zero_share_including_age0")
DELTAS = ("zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share")


def age0_sensitivity(works: DataFrame, bounds: Bounds) -> DataFrame:
    """Measures over ages 0..n less those over 1..n, for each group and cell."""
    a, b = concentration_by_group(works, bounds, 0).alias("a"), concentration_by_group(works, bounds).alias("b")
    return a.join(b, ["cited_group", *AGES]).select("cited_group", *AGES, *[(F.col(f"a.{c}") - F.col(f"b.{c}")).alias(f"delta_{c}") for c in DELTAS])


def long_form(table: DataFrame, key: str) -> DataFrame:
    """key, publication_year, citation_age, measure, value: a row for each measure of a cell."""
    return table.select(key, *AGES, *[F.col(c).cast("double").alias(c) for c in MEASURES]).unpivot([key, *AGES], list(MEASURES), "measure", "value")


def terminal_edge(table: DataFrame, key: str, bounds: Bounds, ages: tuple[int, ...] = (3, 5)) -> DataFrame:
    """key, measure, view, before, value, step, earlier_steps, earlier_spread: the step into the cohorts whose window ends last.

    Views at fixed ages compare the last cohort with the one before, those of the diagonal each
    cell whose window ends last with the cell of the same cohort one year younger. earlier_steps and
    earlier_spread (largest less least) are those of the steps before at that age, or of the cohort.
    """
    rows = long_form(table, key)
    across = Window.partitionBy(key, "measure", "citation_age").orderBy("publication_year")
    along = Window.partitionBy(key, "measure", "publication_year").orderBy("citation_age")

    def edge(steps: DataFrame, order, last: Column, view: Column) -> DataFrame:
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        steps = steps.withColumn("before", F.lag("value").over(order)).withColumn("step", F.col("value") - F.col("before"))
        steps = steps.withColumns({"earlier_steps": F.count("step").over(before), "earlier_spread": F.max("step").over(before) - F.min("step").over(before)})
        return steps.where(last & F.col("before").isNotNull()).select(key, "measure", view.alias("view"), "before", "value", "step", "earlier_steps", "earlier_spread")

    ends_last = F.col("publication_year") + F.col("citation_age") == bounds.cohort_citation_max
    fixed = edge(rows.where(F.col("citation_age").isin(*ages)), across, ends_last, F.concat(F.lit("age "), F.col("citation_age").cast("string")))
    return fixed.unionByName(edge(rows, along, ends_last, F.concat(F.lit("cohort "), F.col("publication_year").cast("string"))))


def pooled_against_members(by_subfield: DataFrame, by_group: DataFrame, group) -> DataFrame:
    """The pooled gini of a group beside the mean gini of its members."""
    members = by_subfield.where(F.col("subfield_id") != UNCLASSIFIED).groupBy(group.alias("cited_group"), *AGES).agg(F.avg("gini").alias("mean_member_gini"), F.stddev_samp("gini").alias("sd_member_gini"), F.count("gini").alias("members"))
    return by_group.select("cited_group", *AGES, F.col("gini").alias("pooled_gini")).join(members, ["cited_group", *AGES])


def compare_builds(a: DataFrame, b: DataFrame, keys: list[str], counts: list[str], ratios: list[str], flags: tuple[str, ...] = (), count_tolerance: float = 0.0, ratio_tolerance: float = 0.0) -> DataFrame:
    """One row: keys missing on either side, changed flags, summed and worst count differences, worst ratio differences, and whether the builds agree.

    They agree if no key is missing, no flag changed, no count is off by more than
    count_tolerance of the larger value, and no ratio by more than ratio_tolerance; a
    value that only one build has is off by more than any tolerance.
    """
    x, y = a.withColumn("_x", F.lit(1)).alias("x"), b.withColumn("_y", F.lit(1)).alias("y")
    both = x.join(y, keys, "full")
    left, right = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    paired = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    apart = lambda c: F.abs(left(c) - right(c))
    one_only = lambda c: paired & (left(c).isNull() != right(c).isNull())
    off = [apart(c) > count_tolerance * F.greatest(F.abs(left(c)), F.abs(right(c))) for c in counts] + [apart(c) > ratio_tolerance for c in ratios]
    broken = reduce(lambda p, q: p | q, [F.coalesce(x, F.lit(False)) for x in off] + [one_only(c) for c in (*counts, *ratios)] + [paired & ~left(c).eqNullSafe(right(c)) for c in flags], F.lit(False))
    found = both.agg(
        F.count_if(F.col("_x").isNull()).alias("missing_left"), F.count_if(F.col("_y").isNull()).alias("missing_right"),
        *[F.count_if(paired & ~left(c).eqNullSafe(right(c))).alias(f"changed_{c}") for c in flags],
        *[F.sum(apart(c)).alias(f"apart_{c}") for c in counts], *[F.max(apart(c)).alias(f"worst_{c}") for c in (*counts, *ratios)], F.count_if(broken).alias("cells_beyond"),
    )
    return found.withColumn("agree", F.expr("missing_left + missing_right + cells_beyond = 0"))


def negative_ages(works: DataFrame) -> DataFrame:
    """entries, weight, first_age, last_age and share of all positive weight of entries before publication."""
    rows = works.select("publication_year", F.inline("counts_by_year")).where("cited_by_count > 0").withColumn("age", F.col("year") - F.col("publication_year"))
    early = F.col("age") < 0
    return rows.agg(
        F.count_if(early).alias("entries"), F.sum(F.when(early, F.col("cited_by_count")).otherwise(0)).alias("weight"), F.min(F.when(early, F.col("age"))).alias("first_age"), F.max(F.when(early, F.col("age"))).alias("last_age"),
        (F.sum(F.when(early, F.col("cited_by_count")).otherwise(0)) / F.sum("cited_by_count")).alias("share"),
    )


def first_year_at(ages: DataFrame, limit: int) -> DataFrame:
    """The first citation year in which a group's median age is at most the limit; null if none."""
    return ages.groupBy("cited_group").agg(F.min(F.when(F.col("median_age") <= limit, F.col("citation_year"))).alias("first_year"))


def cohort_trend(by_group: DataFrame, age: int) -> DataFrame:
    """Gini of each cohort at an age, and its change from the cohort before."""
    order = Window.partitionBy("cited_group").orderBy("publication_year")
    return by_group.where(F.col("citation_age") == age).select("cited_group", "publication_year", "gini", (F.col("gini") - F.lag("gini").over(order)).alias("change"))


def rank_among_peers(by_subfield: DataFrame) -> DataFrame:
    """Position by gini in each cell, without the synthetic bucket."""
    order = Window.partitionBy(*AGES).orderBy(F.desc("gini"))
    return by_subfield.where(F.col("subfield_id") != UNCLASSIFIED).select(*AGES, "subfield_id", F.rank().over(order).cast("long").alias("position"))
