"""Exact fixtures of the aggregates, with literal expected values."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortlake import standin
from cohortlake.bounds import Bounds
from cohortlake.operators import citation_age, concentration, evidence, share
from cohortlake.operators.works import classify
from cohortlake.plans import check_queries, checks, quality, table_checks
from cohortlake.schemas import BY_GROUP, BY_SUBFIELD, CITATION_AGE, SHARE, differences

AI, CV = "s/1702", "s/1707"
BOUNDS = Bounds(2000, 2023, 2020, 2020, 2020, 2023, 2023, AI, CV)


def make(spark, rows, bounds=BOUNDS):
    data = [(f"p{i}", y, sf, name, [(a, b) for a, b in entries.items()]) for i, (y, sf, name, entries) in enumerate(rows)]
    df = spark.createDataFrame(data, "id STRING, publication_year BIGINT, primary_topic_subfield_id STRING, primary_topic_subfield_display_name STRING, counts_by_year ARRAY<STRUCT<year: BIGINT, cited_by_count: BIGINT>>")
    return classify(df, bounds)


def test_citation_age(spark):
    bounds = replace(BOUNDS, age_year_min=2015, age_year_max=2016)
    rows = [
        (2015, AI, "A", {2015: 2, 2016: 5}), (2012, AI, "A", {2015: 6, 2016: 1, 2017: 50}), (2004, AI, "A", {2016: 2}),
        (2013, CV, "V", {2016: 9, 2012: 4}), (2016, CV, "V", {2015: 3, 2016: 0}),  # before publication, and none
        (2010, "s/9", "N", {2015: 1}), (2003, None, None, {2015: 3}),
    ]
    df = citation_age.citation_age_by_year(make(spark, rows, bounds), bounds)
    assert differences(df.schema, CITATION_AGE) == []
    # Ages and weights: ai 2015 0:2 3:6; ai 2016 1:5 4:1 12:2; cv 2016 3:9; rest 2015 5:1 12:3.
    assert {tuple(r) for r in df.collect()} == {
        (2015, "ai", 8, 2, 0, 3, 3, 0.25, 1.0, 1.0), (2016, "ai", 8, 3, 1, 1, 4, 0.625, 0.75, 0.75),
        (2016, "cv_pr", 9, 1, 3, 3, 3, 0.0, 1.0, 1.0), (2015, "rest_cs", 4, 2, 5, 12, 12, 0.0, 0.25, 0.25),
    }


def subfield_rows():
    own = [{2021: 6, 2022: 2}, {2021: 2}, {2023: 4}, {2020: 5}] + [{}] * 4
    many = [{2022: 5}, {2022: 5}, {2022: 2}] + [{}] * 18
    return [(2020, AI, "Own", e) for e in own] + [(2020, "many", "Many", e) for e in many] + [(2020, None, None, {2020: 3, 2023: 1}), (2020, "bare", None, {})]


def test_concentration_by_subfield(spark):
    works = make(spark, subfield_rows())
    df = concentration.concentration_by_subfield(works, BOUNDS)
    assert differences(df.schema, BY_SUBFIELD) == []
    cells = {(r.subfield_id, r.citation_age): r for r in df.collect()}
    assert len(cells) == 12
    # gini = sum((2 i - n - 1) x_i) / (n * total) over counts in rising order; a top share holds ceil(n * percent) papers.
    wanted = {
        (AI, 1): (8, 8, 6 / 8, 52 / 64, 4 / 16, 6 / 8, 6 / 8, 6 / 8, 5 / 13, 5 / 8),  # 6, 2
        (AI, 2): (8, 10, 6 / 8, 66 / 80, 6 / 20, 0.8, 0.8, 0.8, 5 / 15, 5 / 8),  # 8, 2
        (AI, 3): (8, 14, 5 / 8, 82 / 112, 12 / 42, 8 / 14, 8 / 14, 8 / 14, 5 / 19, 4 / 8),  # 8, 4, 2
        ("many", 1): (21, 0, 1.0, None, None, None, None, None, None, 1.0),
        ("many", 2): (21, 12, 18 / 21, 222 / 252, 6 / 36, 5 / 12, 10 / 12, 1.0, 0.0, 18 / 21),  # 5, 5, 2: tops of 1, 2 and 3 papers
        ("__unclassified__", 1): (1, 0, 1.0, None, None, None, None, None, 1.0, 0.0),
        ("__unclassified__", 3): (1, 1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 3 / 4, 0.0),
        ("bare", 2): (1, 0, 1.0, None, None, None, None, None, None, 1.0),
    }
    assert {k: tuple(cells[k])[6:] for k in wanted} == wanted
    assert tuple(cells["many", 3])[6:] == wanted["many", 2]
    labels = {r.subfield_id: (r.subfield_display_name, r.is_ai_strict, r.is_ai_broad) for r in cells.values()}
    assert labels["__unclassified__"] == ("Unclassified", False, False) and labels["bare"] == ("bare", False, False) and labels[AI] == ("Own", True, True)


def test_concentration_by_group(spark):
    rows = [
        (2020, AI, "A", {2021: 1, 2022: 3}), (2020, AI, "A", {2022: 1}), (2020, AI, "A", {}), (2020, AI, "A", {2020: 2}),
        (2020, CV, "V", {2023: 2}), (2020, CV, "V", {2021: 1}), (2020, "q", "Q", {2020: 1}), (2020, None, None, {2021: 4}),
    ]
    df = concentration.concentration_by_group(make(spark, rows), BOUNDS)
    assert differences(df.schema, BY_GROUP) == []
    cells = {(r.cited_group, r.citation_age): tuple(r)[3:] for r in df.collect()}
    one = (2, 1, 1 / 2, 1 / 2, 0.0, 1.0, 1.0, 1.0, 0.0, 1 / 2)
    rest = (2, 4, 1 / 2, 4 / 8, 0.0, 1.0, 1.0, 1.0, 1 / 5, 0.0)
    later = (4, 5, 2 / 4, 13 / 20, 3 / 10, 4 / 5, 4 / 5, 4 / 5, 2 / 7, 1 / 4)
    assert cells == {
        ("ai", 1): (4, 1, 3 / 4, 3 / 4, 0.0, 1.0, 1.0, 1.0, 2 / 3, 2 / 4), ("ai", 2): later, ("ai", 3): later,
        ("cv_pr", 1): one, ("cv_pr", 2): one, ("cv_pr", 3): (2, 3, 0.0, 1 / 6, 1 / 6, 2 / 3, 2 / 3, 2 / 3, 0.0, 0.0),
        ("rest_cs", 1): rest, ("rest_cs", 2): rest, ("rest_cs", 3): rest,
    }


def test_measures_equal_the_rank_formula_in_any_order(spark):
    rng = random.Random(3)
    rows = [(2020, rng.choice([AI, CV, "x", None]), "n", {2021: rng.choice([0, 0, 0, 1, 1, 2, 5, 40]), 2022: rng.randrange(3)}) for _ in range(300)]
    works = make(spark, rows)
    for table, key in ((concentration.concentration_by_group(works.repartition(7), BOUNDS), "cited_group"), (concentration.concentration_by_subfield(works, BOUNDS), "subfield_id")):
        assert checks.cell_differences(table, works, BOUNDS, key).isEmpty()
        rules = [r for r in table_checks.corpus_rules(BOUNDS) if r.table == ("by_group" if key == "cited_group" else "by_subfield")]
        assert not [r for r in table_checks.count_all({rules[0].table: table}, rules).collect() if r.violations]


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_ranks_of_cells_larger_than_a_task(spark, partitions):
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "a", None, "b"]), rng.randrange(7), i) for i in range(500)] + [("c", 1, 1000)]
    rows = spark.createDataFrame(data, "cell STRING, v BIGINT, id BIGINT")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {tuple(r) for r in checks.ranked(rows, ["cell"], ["v", "id"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    wanted = set()
    for cell in ("a", "b", "c", None):
        own = sorted((v, i) for c, v, i in data if c == cell)
        wanted |= {(cell, v, i, k, len(own)) for k, (v, i) in enumerate(own, 1)}
    assert found == wanted


def test_share_and_rows_of_the_cohort_bounds(spark):
    works = make(spark, [(2023, AI, "A", {}), (2023, CV, "V", {}), (2023, None, None, {}), (2019, AI, "A", {2020: 1})])
    df = share.share_by_year(works, BOUNDS)
    assert differences(df.schema, SHARE) == []
    assert {tuple(r) for r in df.collect()} == {(2023, "strict", 3, 1, 1 / 3, True), (2023, "broad", 3, 2, 2 / 3, True), (2019, "strict", 1, 1, 1.0, False), (2019, "broad", 1, 1, 1.0, False)}
    assert concentration.paper_windows(works, BOUNDS).isEmpty()  # no cohort in the bounds, and no cell beyond the triangle
    assert concentration.concentration_by_group(works.limit(0), BOUNDS).isEmpty()


def test_all_checks_pass_on_built_tables_and_find_faults(spark):
    bounds = replace(BOUNDS, cohort_citation_max=2022, age_year_min=2020, age_year_max=2021)
    works = make(spark, [(y, sf, f"n{sf}", {y: 1, y + 1: i % 4, 2020: 2, 2021: 1}) for y in (2020, 2021) for sf in (AI, CV, None) for i in range(5)], bounds)
    works = works.withColumn("counts_by_year", F.expr("filter(counts_by_year, (e, i) -> i = 0 OR NOT exists(slice(counts_by_year, 1, i), x -> x.year = e.year))"))
    gold = [share.share_by_year(works, bounds), citation_age.citation_age_by_year(works, bounds), concentration.concentration_by_subfield(works, bounds), concentration.concentration_by_group(works, bounds)]
    found = {r.check_name: r.violations for r in quality.report(checks.corpus_checks(spark, works, *gold, bounds)).collect()}
    assert {k: v for k, v in found.items() if v} == {"works_entries_before_publication": 15}
    rules = table_checks.corpus_rules(bounds)[1:]
    tables = dict(zip(("works", "share", "ages", "by_subfield", "by_group"), (works, *gold), strict=True))
    assert not [r for r in table_checks.count_all(tables, rules).collect() if r.violations]
    by_subfield, by_group = gold[2], gold[3]
    assert checks.triangle_gaps(by_subfield.where("citation_age < 2"), bounds, "subfield_id").count() == 3
    assert checks.bucket_problems(works, by_subfield.where("subfield_id <> '__unclassified__'"), bounds).count() == 1
    tops = {r.check_name: r.violations for r in table_checks.count_violations(by_group.withColumn("top1_share", F.lit(2.0)), rules[-1]).collect()}
    assert tops["tail order"] == tops["top1_share in range"] == by_group.count() and tops["gini in range"] == 0
    bad = make(spark, [(2020, AI, "A", {2021: -1, None: 2})], bounds)
    assert {r.problem for r in checks.invalid_entries(bad, bounds).collect()} == {"bad_count", "null_year"}
    assert checks.floor_not_retained(spark, works.limit(0), bounds).count() == 1
    assert checks.row_counts_differ(works, works.limit(2)).count() == 1


def test_a_table_is_scanned_once_for_all_rules(spark, tmp_path):
    works = make(spark, subfield_rows())
    for of, table in ((r, t) for r in table_checks.corpus_rules(BOUNDS) for name, t in (("by_group", concentration.concentration_by_group(works, BOUNDS)), ("works", works)) if r.table == name):
        table.write.parquet(f"{tmp_path}/{of.table}")
        plan = table_checks.count_violations(spark.read.parquet(f"{tmp_path}/{of.table}"), of)._jdf.queryExecution().executedPlan().toString()
        # One scan; the keys' shuffle and the last sum.
        assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_every_declared_rule_finds_its_fault(spark, data):
    found = check_queries.declared_checks_find_faults(spark, data).collect()
    assert len(found) == 109 and not [r for r in found if r.violations == 0]
    assert not [r for r in check_queries.corpus_checks_find_faults(spark, data).collect() if r.violations == 0]


def test_evidence(spark):
    works = make(spark, subfield_rows())
    assert evidence.negative_ages(works).first().entries == 0
    ranks = {(r.subfield_id, r.citation_age): r.position for r in evidence.rank_among_peers(concentration.concentration_by_subfield(works, BOUNDS)).collect()}
    assert ranks[AI, 1] == 1 and ranks["many", 2] == 1 and ranks[AI, 2] == 2 and ("__unclassified__", 1) not in ranks
    shifted = {(r.cited_group, r.citation_age): r.delta_zero_share for r in evidence.age0_sensitivity(works, BOUNDS).collect()}
    assert shifted["ai", 1] == pytest.approx(-1 / 8)


def test_partitions_by_order_do_not_grow_with_the_items(spark):
    items = spark.range(4000).select((F.col("id") % 1000).alias("l_orderkey"), F.lit(1995).cast("long").alias("year"), F.lit(2.0).alias("l_quantity"))
    for most, parts in ((100, 40), (200, 20)):
        yearly = standin.by_order(items, most).groupBy("l_orderkey", "year").agg(F.sum("l_quantity").alias("n")).withColumn("part", F.spark_partition_id())
        sizes = {r.part: r.orders for r in yearly.groupBy("part").agg(F.count("*").alias("orders")).collect()}
        assert sum(sizes.values()) == 1000 and len(sizes) > parts * 0.7 and max(sizes.values()) < 2 * most / 4 + 30  # 4 items an order; the session has 4 partitions


def test_window_values_read_works_once(spark):
    rows = make(spark, [(2020, AI, "A", {2019: 9, 2020: 7, 2021: 2, 2023: 4}), (2021, None, None, {}), (2022, CV, "V", {2023: None})])
    values = checks.window_values(rows, BOUNDS)
    found = {(r.id, r.citation_age): r.v for r in values.collect()}
    assert found == {("p0", 1): 2, ("p0", 2): 2, ("p0", 3): 6, ("p1", 1): 0, ("p1", 2): 0, ("p2", 1): 0}
    assert "Join" not in values._jdf.queryExecution().executedPlan().toString()
