"""Registered queries of the checks: on the tables as built, and on tables that are damaged so that every check has something to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bounds import STANDIN as B
from ..operators import citation_age, concentration, share, staging
from ..sources.tables import written
from ..standin import bronze as bronze_records, works
from . import checks, quality, table_checks
from .queries import _AGES, _STAGED, _WORKS, ORACLE_SQL, query

RULES = table_checks.corpus_rules(B)
_GOLD = {"share": ORACLE_SQL["share_by_year"], "ages": _AGES, "by_subfield": ORACLE_SQL["concentration_by_subfield"], "by_group": ORACLE_SQL["concentration_by_group"]}
#: DuckDB SQL of the tables that the rules are about.
TABLES = {
    "staging": f"WITH {_STAGED} SELECT 'W' || k AS id, y AS publication_year, o_orderpriority AS primary_topic_subfield_id FROM s",
    "works": f"WITH {_WORKS} z AS (SELECT 1) SELECT CAST(k AS VARCHAR) AS id, py AS publication_year, sf AS primary_topic_subfield_id, sf = '1-URGENT' AS is_ai_strict, sf IN ('1-URGENT', '2-HIGH') AS is_ai_broad FROM w",
    **_GOLD,
}


def build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables, works and staging written once and read by all that follows."""
    rows = written(works(spark, sf_dir), "works")
    staged = staging.stage(bronze_records(spark, sf_dir), B).select("id", "publication_year", "primary_topic_subfield_id")
    return {
        "staging": staged, "works": rows, "share": share.share_by_year(rows, B), "ages": citation_age.citation_age_by_year(rows, B),
        "by_subfield": concentration.concentration_by_subfield(rows, B), "by_group": concentration.concentration_by_group(rows, B),
    }


def _when(column: str, *cases: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {column} END"


def _cell_damage(key: str, wrong_key: str) -> dict[str, str]:
    at = "publication_year = {} AND citation_age = {}".format
    first = f"{key} = '{'1-URGENT' if key == 'subfield_id' else 'ai'}'"
    bad = {"n_papers": "0", "total_citations": "-1"} | dict.fromkeys(
        ("zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share", "age0_citation_share", "zero_share_including_age0"), "1.5"
    )
    also = {"top1_share": [(at(1998, 3), "NULL")], "zero_share_including_age0": [(at(1998, 3), "1.25")]}
    return {c: _when(c, (at(1995, 2), "NULL"), (at(1996, 2), v), *also.get(c, [])) for c, v in bad.items()} | {
        "publication_year": _when("publication_year", (at(1997, 1), "NULL"), (at(1997, 2), "1990")), "citation_age": _when("citation_age", (at(1998, 1), "NULL"), (at(1998, 2), "0")),
        key: _when(key, (f"{at(1999, 1)} AND {first}", "NULL"), (f"{at(1999, 2)} AND {first}", wrong_key)),
    }


#: What is done to each table, in SQL that Spark and DuckDB share: replaced columns, and rows that are there twice.
DAMAGE: dict[str, tuple[dict[str, str], str]] = {
    "staging": ({"id": _when("id", ("publication_year = 1996", "NULL")), "publication_year": _when("publication_year", ("publication_year = 1997", "NULL"), ("publication_year = 1998", "1980")),
                 "primary_topic_subfield_id": _when("primary_topic_subfield_id", ("publication_year = 1999", "NULL"))}, "publication_year = 2000"),
    "works": ({"id": _when("id", ("publication_year = 1995", "NULL")), "is_ai_strict": _when("is_ai_strict", ("publication_year = 1996", "NULL"), ("publication_year = 1997", "NOT is_ai_strict")),
               "is_ai_broad": _when("is_ai_broad", ("publication_year = 1999", "NULL"), ("publication_year = 1998", "NOT is_ai_broad"))}, "publication_year = 2000"),
    "share": ({
        "publication_year": _when("publication_year", ("publication_year = 1999 AND variant = 'broad'", "NULL")), "variant": _when("variant", ("publication_year = 1999 AND variant = 'strict'", "NULL"), ("publication_year = 2000 AND variant = 'strict'", "'other'")),
        "cs_works": _when("cs_works", ("publication_year = 1995", "NULL"), ("publication_year = 1996", "0")), "ai_works": _when("ai_works", ("publication_year = 1995", "NULL"), ("publication_year = 1996", "-1"), ("publication_year = 1997", "cs_works + 1")),
        "share": _when("share", ("publication_year = 1995", "NULL"), ("publication_year = 1996", "1.5")), "is_partial_year": _when("is_partial_year", ("publication_year = 1995", "NULL"), ("publication_year = 1996", "NOT is_partial_year")),
    }, "publication_year = 1998"),
    "ages": ({
        "citation_year": _when("citation_year", ("citation_year = 1999 AND cited_group = 'ai'", "NULL"), ("citation_year = 2000 AND cited_group = 'ai'", "1980")),
        "cited_group": _when("cited_group", ("citation_year = 1999 AND cited_group = 'cv_pr'", "NULL"), ("citation_year = 2000 AND cited_group = 'cv_pr'", "'other'")),
        "citation_events": _when("citation_events", ("citation_year = 1996", "NULL"), ("citation_year = 1997", "0")), "cited_works": _when("cited_works", ("citation_year = 1996", "NULL"), ("citation_year = 1997", "0"), ("citation_year = 1998", "citation_events + 1")),
        "median_age": _when("median_age", ("citation_year = 1996", "NULL"), ("citation_year = 1997", "-1"), ("citation_year = 1998", "p75_age + 1")), **{c: _when(c, ("citation_year = 1996", "NULL"), ("citation_year = 1997", "-1")) for c in ("p25_age", "p75_age")},
        "share_within_2": _when("share_within_2", ("citation_year = 1996", "NULL"), ("citation_year IN (1997, 1998)", "1.5")), **{c: _when(c, ("citation_year = 1996", "NULL"), ("citation_year = 1997", "1.5")) for c in ("share_within_5", "share_within_10")},
    }, "citation_year = 2001"),
    "by_subfield": ({**_cell_damage("subfield_id", "'other'"), **{c: _when(c, ("publication_year = 1995 AND citation_age = 3", "NULL")) for c in ("subfield_display_name", "is_ai_strict", "is_ai_broad")}}, "publication_year = 2000"),
    "by_group": (_cell_damage("cited_group", "'other'"), "publication_year = 2000"),
}


def damaged(df: DataFrame, table: str) -> DataFrame:
    columns, twice = DAMAGE[table]
    rows = df.unionByName(df.where(twice))
    return rows.select(*[F.expr(columns[c]).cast(df.schema[c].dataType).alias(c) if c in columns else F.col(c) for c in rows.columns])


def _damaged_sql(table: str) -> str:
    columns, twice = DAMAGE[table]
    changes = ", ".join(f"{v} AS {c}" for c, v in columns.items())
    return f"SELECT * REPLACE ({changes}) FROM (SELECT * FROM t_{table} UNION ALL SELECT * FROM t_{table} WHERE {twice})"


def _count_sql(of: table_checks.TableRules, source: str) -> str:
    out = []
    for r in of.rules:
        if r.keys:
            one = f" AND {r.keys[0]} IS NOT NULL" if len(r.keys) == 1 else ""
            counted = f"(SELECT count(*) FROM (SELECT {', '.join(r.keys)} FROM {source} GROUP BY ALL HAVING count(*) > 1{one}))"
        else:
            counted = f"(SELECT count(*) FILTER (WHERE {r.broken}) FROM {source})"
        out.append(f"SELECT '{of.table}' AS table_name, '{r.name}' AS check_name, '{r.severity}' AS severity, {counted} AS violations")
    return " UNION ALL ".join(out)


def _rules_sql(damage: bool) -> str:
    parts = []
    for of in RULES:
        parts.append(f"t_{of.table} AS MATERIALIZED ({TABLES[of.table]})")
        source = _damaged_sql(of.table) if damage else f"SELECT * FROM t_{of.table}"
        if of.along:
            order = f"OVER (PARTITION BY {', '.join(of.along[0])} ORDER BY {of.along[1]} NULLS FIRST)"
            source = f"SELECT *, {', '.join(f'lag({c}) {order} AS last_{c}' for c in of.last)} FROM ({source})"
        parts.append(f"r_{of.table} AS MATERIALIZED ({source})")
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(_count_sql(of, f"r_{of.table}") for of in RULES)


@query(_rules_sql(False))
def declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared rule of every table, counted in one scan a table."""
    return table_checks.count_all(build(spark, sf_dir), RULES)


@query(_rules_sql(True))
def declared_checks_find_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on damaged tables: no rule finds nothing."""
    return table_checks.count_all({k: damaged(v, k) for k, v in build(spark, sf_dir).items()}, RULES)


def _changed(df: DataFrame, **columns: str) -> DataFrame:
    return df.withColumns({c: F.expr(v).cast(df.schema[c].dataType) for c, v in columns.items()})


_RECONCILED = ("n_papers", "total_citations", "zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share")
_CELL_FAULTS = {
    "gini": _when("gini", ("publication_year = 1995", "gini + 0.01")), "gini_cited_only": _when("gini_cited_only", ("publication_year = 1996 AND citation_age = 1", "NULL")),
    "top5_share": _when("top5_share", ("publication_year = 1997", "top5_share / 2")), "n_papers": _when("n_papers", ("publication_year = 1998", "n_papers + 1")),
}


def _cells_apart(table: str) -> str:
    changes = ", ".join(f"{v} AS {c}" for c, v in _CELL_FAULTS.items())
    apart = " OR ".join(f"(x.{c} IS NULL) <> (y.{c} IS NULL) OR abs(x.{c} - y.{c}) > 1e-12" for c in _RECONCILED)
    key = "subfield_id" if table == "by_subfield" else "cited_group"
    return f"SELECT count(*) FROM (SELECT * REPLACE ({changes}) FROM t_{table}) x JOIN t_{table} y USING ({key}, publication_year, citation_age) WHERE {apart}"


@query(f"""WITH {', '.join(f't_{k} AS MATERIALIZED ({v})' for k, v in TABLES.items() if k != 'staging')}, {_WORKS.rstrip().rstrip(',')},
e AS (SELECT w.k, w.py, c.y, c.n FROM w JOIN c USING (k))
SELECT 'entries null_year' AS check_name, (SELECT count(*) FROM e WHERE py = 1996 AND y = 1996) AS violations
UNION ALL SELECT 'entries bad_count', (SELECT count(*) FROM e WHERE py = 1997 AND y = 1997)
UNION ALL SELECT 'entries repeated_year', (SELECT count(*) FROM e WHERE py = 1998 AND y = 1998 AND y BETWEEN 1995 AND 2001)
UNION ALL SELECT 'works lost from staging', (SELECT CAST(count(*) > 0 AS BIGINT) FROM w WHERE py = 1997)
UNION ALL SELECT 'strict above broad', (SELECT count(*) FROM t_share WHERE variant = 'broad' AND publication_year IN (1996, 1997) AND share < 1)
UNION ALL SELECT 'groups incomplete', (SELECT count(*) FROM t_ages WHERE citation_year = 1997 AND cited_group <> 'ai') + (SELECT 21 - count(*) FROM t_ages)
UNION ALL SELECT 'events apart', (SELECT count(*) FROM t_ages WHERE citation_year IN (1998, 2000))
UNION ALL SELECT 'works apart', (SELECT count(*) FROM t_ages WHERE citation_year IN (1999, 2000))
UNION ALL SELECT 'strict cohorts missing', (SELECT count(DISTINCT publication_year) FROM t_by_subfield WHERE publication_year IN (1996, 1999))
UNION ALL SELECT 'cohorts below the floor', (SELECT CAST(count(*) > 0 AS BIGINT) FROM t_by_subfield WHERE publication_year > 1995)
UNION ALL SELECT 'floor not retained', 1
UNION ALL SELECT 'triangle by_subfield', (SELECT count(*) FROM t_by_subfield WHERE citation_age = 2 OR publication_year = 2000)
UNION ALL SELECT 'triangle by_group', (SELECT count(*) FROM t_by_group WHERE citation_age = 2 OR publication_year = 2000)
UNION ALL SELECT 'grains apart', (SELECT count(*) FROM t_by_group WHERE cited_group = 'ai')
UNION ALL SELECT 'labels', (SELECT count(DISTINCT sf) FROM w WHERE sf IN ('1-URGENT', '2-HIGH')) + (SELECT count(DISTINCT subfield_id) FROM t_by_subfield WHERE subfield_id = '3-MEDIUM')
UNION ALL SELECT 'bucket missing', (SELECT CAST(count(*) > 0 AS BIGINT) FROM w WHERE py = 1996)
UNION ALL SELECT 'bucket labelled', (SELECT CAST(count(*) > 0 AS BIGINT) FROM t_by_subfield WHERE subfield_id = '1-URGENT')
UNION ALL SELECT 'cells apart by_subfield', ({_cells_apart('by_subfield')}) UNION ALL SELECT 'cells apart by_group', ({_cells_apart('by_group')})""")
def corpus_checks_find_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each check that compares tables, on tables with a fault that it has to find, and how often it does."""
    t = build(spark, sf_dir)
    t |= {k: written(t[k], k) for k in ("share", "ages", "by_subfield", "by_group")}  # read by many checks
    rows, ages, by_subfield, by_group = t["works"], t["ages"], t["by_subfield"], t["by_group"]
    values = written(checks.window_values(rows, B), "values")
    entry = "transform(counts_by_year, e -> IF(publication_year = {0} AND e.year = {0}, {1}, e))"
    null_year = _changed(rows, counts_by_year=entry.format(1996, "named_struct('year', CAST(NULL AS BIGINT), 'cited_by_count', e.cited_by_count)"))
    bad_count = _changed(rows, counts_by_year=entry.format(1997, "named_struct('year', e.year, 'cited_by_count', -1L)"))
    repeated = _changed(rows, counts_by_year="IF(publication_year = 1998, concat(counts_by_year, filter(counts_by_year, e -> e.year = 1998)), counts_by_year)")
    renamed = _changed(rows, primary_topic_subfield_display_name=_when("primary_topic_subfield_display_name", ("publication_year = 1996 AND primary_topic_subfield_id IN ('1-URGENT', '2-HIGH')", "'other'")))
    unlabelled = _changed(rows, primary_topic_subfield_id=_when("primary_topic_subfield_id", ("publication_year = 1996", "NULL")))
    bucket = _changed(by_subfield, subfield_id=_when("subfield_id", ("subfield_id = '1-URGENT'", "'__unclassified__'")))
    shifted = _changed(ages, citation_events=_when("citation_events", ("citation_year IN (1998, 2000)", "citation_events + 1")), cited_works=_when("cited_works", ("citation_year IN (1999, 2000)", "cited_works - 1")))
    apart = checks.event_differences(shifted, rows, B).groupBy().agg(F.count_if(F.col("measure") == "citation_events").alias("events apart"), F.count_if(F.col("measure") == "cited_works").alias("works apart"))
    triangle = lambda table, key: checks.triangle_gaps(table.where("citation_age <> 2").withColumn("citation_age", F.expr("IF(publication_year = 2000, citation_age + 1, citation_age)")).unionByName(table.where("publication_year = 2000")), B, key)
    faults = {
        **{f"entries {k}": checks.invalid_entries(df, B).where(F.col("problem") == k) for k, df in (("null_year", null_year), ("bad_count", bad_count), ("repeated_year", repeated))},
        "works lost from staging": checks.row_counts_differ(rows.where("publication_year <> 1997"), rows),
        "strict above broad": checks.strict_above_broad(_changed(t["share"], share=_when("share", ("variant = 'strict' AND publication_year IN (1996, 1997)", "1.0")))),
        "groups incomplete": checks.incomplete_groups(spark, ages.where("citation_year <> 1997 OR cited_group = 'ai'"), B),
        "strict cohorts missing": checks.missing_strict_cohorts(spark, by_subfield.where("subfield_id <> '1-URGENT' OR publication_year NOT IN (1996, 1999)"), B),
        "cohorts below the floor": checks.cohort_floor(by_subfield.where("publication_year > 1995"), B),
        "floor not retained": checks.floor_not_retained(spark, _changed(rows, counts_by_year="filter(counts_by_year, e -> e.year > 1995)"), B),
        "triangle by_subfield": triangle(by_subfield, "subfield_id"), "triangle by_group": triangle(by_group, "cited_group"),
        "grains apart": checks.cross_grain(by_subfield, _changed(by_group, total_citations=_when("total_citations", ("cited_group = 'ai'", "total_citations + 1"))), B),
        "labels": checks.label_problems(renamed, _changed(by_subfield, subfield_display_name=_when("subfield_display_name", ("subfield_id = '3-MEDIUM' AND publication_year = 1996", "'other'")))),
        "bucket missing": checks.bucket_problems(unlabelled, by_subfield, B), "bucket labelled": checks.bucket_problems(unlabelled, bucket, B),
        "cells apart by_subfield": checks.cell_differences(_changed(by_subfield, **_CELL_FAULTS), rows, B, "subfield_id", values), "cells apart by_group": checks.cell_differences(_changed(by_group, **_CELL_FAULTS), rows, B, "cited_group", values),
    }
    found = quality.report([quality.Check(k, lambda df=df: df) for k, df in faults.items()]).drop("severity")
    return found.unionByName(apart.select(F.expr("stack(2, 'events apart', `events apart`, 'works apart', `works apart`) AS (check_name, violations)")))
