"""The checks of a bibliographic corpus that compare works and the tables built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..bounds import Bounds
from ..operators.works import UNCLASSIFIED, cited_group, subfield_bucket
from ..sources.tables import written
from .quality import Check, key_difference, reconcile

AGES = ["publication_year", "citation_age"]


def entries(works: DataFrame) -> DataFrame:
    return works.select("id", "publication_year", "primary_topic_subfield_id", F.inline("counts_by_year"))


def invalid_entries(works: DataFrame, bounds: Bounds) -> DataFrame:
    """id, year, problem: a null year anywhere; in the active years a null or negative count, or a year twice in a work."""
    rows = entries(works)
    active = rows.where(F.col("year").between(bounds.age_year_min, bounds.age_year_max) | F.col("year").between(bounds.cohort_min, bounds.cohort_citation_max))
    return (
        rows.where("year IS NULL").select("id", "year", F.lit("null_year").alias("problem"))
        .union(active.where("cited_by_count IS NULL OR cited_by_count < 0").select("id", "year", F.lit("bad_count")))
        .union(active.groupBy("id", "year").count().where("count > 1").select("id", "year", F.lit("repeated_year")))
    )


def entries_before_publication(works: DataFrame, bounds: Bounds) -> DataFrame:
    """Positive entries of years before the work's own, in the active years."""
    low, high = min(bounds.age_year_min, bounds.cohort_min), max(bounds.age_year_max, bounds.cohort_citation_max)
    return entries(works).where(F.col("year").between(low, high) & (F.col("year") < F.col("publication_year")) & (F.col("cited_by_count") > 0)).select("id", "publication_year", "year", "cited_by_count")


def unparsed(raw: DataFrame, staged: DataFrame, column: str) -> DataFrame:
    """Ids with a text in the column of the raw rows that staging made null."""
    return raw.where(F.col(column).isNotNull()).select("id").join(staged.where(F.col(column).isNull()).select("id"), "id", "left_semi")


def row_counts_differ(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.agg(F.count("*").alias("left_rows")).crossJoin(b.agg(F.count("*").alias("right_rows"))).where("left_rows <> right_rows")


def strict_above_broad(share: DataFrame) -> DataFrame:
    return share.groupBy("publication_year").pivot("variant", ["strict", "broad"]).agg(F.max("share")).where("strict > broad")


def incomplete_groups(spark: SparkSession, ages: DataFrame, bounds: Bounds) -> DataFrame:
    grid = spark.range(bounds.age_year_min, bounds.age_year_max + 1).select(F.col("id").alias("citation_year"), F.explode(F.array(*map(F.lit, ("ai", "cv_pr", "rest_cs")))).alias("cited_group"))
    return key_difference(grid, ages, ["citation_year", "cited_group"])


def independent_events(works: DataFrame, bounds: Bounds) -> DataFrame:
    """Event totals and distinct works by another way: per work first, then per grain."""
    total = works.select("id", cited_group(F.col("primary_topic_subfield_id"), bounds).alias("cited_group"), "publication_year", F.explode(F.expr(f"sequence(greatest(publication_year, {bounds.age_year_min}L), {bounds.age_year_max}L)")).alias("citation_year"), "counts_by_year").where(f"publication_year <= {bounds.age_year_max}")
    own = total.select("citation_year", "cited_group", "id", F.expr("aggregate(filter(counts_by_year, e -> e.year = citation_year AND e.cited_by_count > 0), 0L, (s, e) -> s + e.cited_by_count)").alias("weight")).where("weight > 0")
    return own.groupBy("citation_year", "cited_group").agg(F.sum("weight").alias("citation_events"), F.countDistinct("id").alias("cited_works"))


def missing_strict_cohorts(spark: SparkSession, by_subfield: DataFrame, bounds: Bounds) -> DataFrame:
    """Built cohorts without the pinned category."""
    built = by_subfield.select("publication_year").distinct()
    return built.join(by_subfield.where(F.col("subfield_id") == bounds.strict_id).select("publication_year").distinct(), "publication_year", "left_anti")


def cohort_floor(by_subfield: DataFrame, bounds: Bounds) -> DataFrame:
    found = by_subfield.agg(F.min("publication_year").alias("first"), F.count_if(F.col("publication_year") < bounds.cohort_min).alias("early"))
    return found.where((F.col("early") > 0) | ~F.col("first").eqNullSafe(F.lit(bounds.cohort_min)))


def floor_not_retained(spark: SparkSession, works: DataFrame, bounds: Bounds) -> DataFrame:
    """A row if no entry of the floor's year is left in the source."""
    kept = entries(works).where(F.col("year") == bounds.cohort_min).select(F.lit(bounds.cohort_min).cast("long").alias("year")).limit(1)
    return spark.range(bounds.cohort_min, bounds.cohort_min + 1).select(F.col("id").alias("year")).join(kept, "year", "left_anti")


def triangle_gaps(table: DataFrame, bounds: Bounds, key: str) -> DataFrame:
    """Cells that each key of a cohort should have or should not."""
    wanted = table.select(key, "publication_year").distinct().where(F.col("publication_year") <= bounds.cohort_max)
    wanted = wanted.select(key, "publication_year", F.explode(F.expr(f"sequence(1L, {bounds.cohort_citation_max} - publication_year)")).alias("citation_age"))
    return key_difference(wanted, table, [key, *AGES])


def cross_grain(by_subfield: DataFrame, by_group: DataFrame, bounds: Bounds) -> DataFrame:
    sums = lambda df: df.groupBy("cited_group", *AGES).agg(F.sum("n_papers").alias("n_papers"), F.sum("total_citations").alias("total_citations"))
    return reconcile(sums(by_subfield.withColumn("cited_group", cited_group(F.col("subfield_id"), bounds))), sums(by_group), ["cited_group", *AGES], ["n_papers", "total_citations"])


def ranked(rows: DataFrame, cell: list[str], order: list[str]) -> DataFrame:
    """rows with rank (from 1) and cell_size in their cell, in the order of columns; a cell may be larger than a task.

    Rows are range-partitioned by cell and order, so a cell's rows lie side by side in
    some partitions. What a partition adds to the ranks of a cell is the number of that
    cell's rows in the partitions before: one small row for each cell and partition that meet.
    """
    keys = [*cell, *order]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    laid = written(laid, "ranked").withColumn("_part", F.shiftright("_at", 33))
    pieces = laid.groupBy("_part", *cell).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    own = Window.partitionBy(*cell)
    before = F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("_part", *cell, (F.col("_first") - before).alias("_zero"), F.sum("_rows").over(own).alias("cell_size"))
    same = reduce(lambda p, q: p & q, [F.col(f"l.{c}").eqNullSafe(F.col(f"p.{c}")) for c in cell], F.col("l._part") == F.col("p._part"))
    return laid.alias("l").join(F.broadcast(pieces.alias("p")), same).select("l.*", (F.col("l._at") - F.col("p._zero") + 1).alias("rank"), "p.cell_size").drop("_at", "_part")


def window_values(works: DataFrame, bounds: Bounds) -> DataFrame:
    """id, primary_topic_subfield_id, ages and v, the citations of each paper's windows: entries are exploded beside the ages and grouped again."""
    papers = works.where(F.col("publication_year").between(bounds.cohort_min, bounds.cohort_max)).select("id", "primary_topic_subfield_id", "publication_year", "counts_by_year")
    grid = papers.withColumn("citation_age", F.explode(F.expr(f"sequence(1L, {bounds.cohort_citation_max} - publication_year)"))).withColumn("entry", F.explode_outer("counts_by_year"))
    inside = F.expr("entry.cited_by_count > 0 AND entry.year > publication_year AND entry.year - publication_year <= citation_age")
    return grid.groupBy("id", "primary_topic_subfield_id", *AGES).agg(F.coalesce(F.sum(F.when(inside, F.col("entry.cited_by_count"))), F.lit(0)).alias("v"))


def independent_cells(values: DataFrame, key) -> DataFrame:
    """Each cell's measures from ranked papers instead of value frequencies; values are those of window_values, best written, as laying them out by ranges reads them twice."""
    rows = ranked(values.select("id", key.alias("cell"), *AGES, "v"), ["cell", *AGES], ["v", "id"])
    n, t, r = F.count("*"), F.sum("v"), F.sum(F.col("rank") * F.col("v"))
    zeros = F.count_if(F.col("v") == 0)
    cited = n - zeros
    tops = {k: F.sum(F.when(F.col("rank") > F.col("cell_size") - F.expr(f"(cell_size * {k} + 99) div 100"), F.col("v")).otherwise(0)) for k in (1, 5, 10)}
    over = lambda x, y: x / F.nullif(y, F.lit(0))
    return rows.groupBy("cell", *AGES).agg(
        n.alias("n_papers"), t.alias("total_citations"), (zeros / n).alias("zero_share"), over(2 * r - (n + 1) * t, n * t).alias("gini"),
        # Zeros have the first ranks, so that the cited have theirs less the number of zeros.
        over(2 * (r - zeros * t) - (cited + 1) * t, cited * t).alias("gini_cited_only"), *[over(x, t).alias(f"top{k}_share") for k, x in tops.items()],
    )


def cell_differences(table: DataFrame, works: DataFrame, bounds: Bounds, key: str, values: DataFrame | None = None) -> DataFrame:
    """Cells that differ from those found by another way; values are the written window_values of works, where there are some."""
    by = subfield_bucket(F.col("primary_topic_subfield_id")) if key == "subfield_id" else cited_group(F.col("primary_topic_subfield_id"), bounds)
    compared = ["n_papers", "total_citations", "zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share"]
    return reconcile(table.withColumnRenamed(key, "cell"), independent_cells(window_values(works, bounds) if values is None else values, by), ["cell", *AGES], compared, 1e-12)


def label_problems(works: DataFrame, by_subfield: DataFrame) -> DataFrame:
    """Ids with several names in the source, or without exactly one in the table."""
    many = works.where("primary_topic_subfield_id IS NOT NULL").groupBy(F.col("primary_topic_subfield_id").alias("subfield_id")).agg(F.countDistinct("primary_topic_subfield_display_name").alias("names")).where("names > 1")
    return many.union(by_subfield.groupBy("subfield_id").agg(F.countDistinct("subfield_display_name").alias("names")).where("names <> 1"))


def bucket_problems(works: DataFrame, by_subfield: DataFrame, bounds: Bounds) -> DataFrame:
    """A row if the bucket of works without a subfield is missing, superfluous or labelled as a category."""
    source = works.where(F.col("publication_year").between(bounds.cohort_min, bounds.cohort_max)).agg(F.count_if(F.col("primary_topic_subfield_id").isNull()).alias("unlabelled"))
    table = by_subfield.agg(F.count_if(F.col("subfield_id") == UNCLASSIFIED).alias("cells"), F.count_if((F.col("subfield_id") == UNCLASSIFIED) & (F.col("is_ai_strict") | F.col("is_ai_broad"))).alias("labelled"))
    return source.crossJoin(table).where("(unlabelled > 0) <> (cells > 0) OR labelled > 0")


def event_differences(ages: DataFrame, works: DataFrame, bounds: Bounds) -> DataFrame:
    """measure, citation_year, cited_group: event totals and distinct works that differ from those found by another way, in one pass over works."""
    grain = ["citation_year", "cited_group"]
    apart = reconcile(ages, independent_events(works, bounds), grain, ["citation_events", "cited_works"])
    measures = F.array(*[F.when(~F.col(f"left_{m}").eqNullSafe(F.col(f"right_{m}")), m) for m in ("citation_events", "cited_works")])
    return apart.select(F.explode(F.array_compact(measures)).alias("measure"), *grain)


def corpus_checks(spark: SparkSession, works: DataFrame, share: DataFrame, ages: DataFrame, by_subfield: DataFrame, by_group: DataFrame, bounds: Bounds) -> list[Check]:
    """The checks that compare tables; the rules on each table alone are those of table_checks."""
    values = written(window_values(works, bounds), "values")  # for both grains
    checks = [
        Check("works_entries_valid", lambda: invalid_entries(works, bounds)),
        Check("works_entries_before_publication", lambda: entries_before_publication(works, bounds), "warn"),
        Check("share_strict_below_broad", lambda: strict_above_broad(share)), Check("ages_groups_complete", lambda: incomplete_groups(spark, ages, bounds)),
        Check("ages_reconcile", lambda: event_differences(ages, works, bounds)),
        Check("subfield_strict_present", lambda: missing_strict_cohorts(spark, by_subfield, bounds)), Check("subfield_cohort_floor", lambda: cohort_floor(by_subfield, bounds)),
        Check("source_retains_floor", lambda: floor_not_retained(spark, works, bounds)), Check("subfield_labels", lambda: label_problems(works, by_subfield)),
        Check("subfield_bucket", lambda: bucket_problems(works, by_subfield, bounds)), Check("grains_agree", lambda: cross_grain(by_subfield, by_group, bounds)),
    ]
    for name, table, key in (("by_subfield", by_subfield, "subfield_id"), ("by_group", by_group, "cited_group")):
        checks += [
            Check(f"{name}_triangle", lambda t=table, k=key: triangle_gaps(t, bounds, k)),
            Check(f"{name}_source_reconcile", lambda t=table, k=key: cell_differences(t, works, bounds, k, values)),
        ]
    return checks
