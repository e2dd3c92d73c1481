"""Declared checks of a table, all of them counted in one scan.

A rule is data. Rules on rows become conditional counts, and a rule on keys shares
their pass: rows are grouped by the keys with the counts of the row rules beside
them, and the few groups' sums are added up. Rules that compare a row with the
one before it in its cohort use columns `last_<column>`; that window has the
partitioning that the keys are grouped by, so it adds no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..bounds import Bounds


@dataclass(frozen=True)
class Rule:
    """A named condition on rows (SQL that is true where a row breaks it) or on keys that may not repeat; a broken one of severity warn does not fail the run."""

    name: str
    broken: str = ""
    keys: tuple[str, ...] = ()
    severity: str = "error"


@dataclass(frozen=True)
class TableRules:
    """The rules of one table; `along` names the cohort and the order of the rows that `last_` columns look back on."""

    table: str
    rules: tuple[Rule, ...]
    along: tuple[tuple[str, ...], str] | None = None
    last: tuple[str, ...] = ()


def literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def not_null(*columns: str, severity: str = "error") -> list[Rule]:
    return [Rule(f"{c} not null", f"{c} IS NULL", severity=severity) for c in columns]


def within(column: str, low=None, high=None) -> Rule:
    """Inclusive bounds; null passes."""
    parts = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
    return Rule(f"{column} in range", " OR ".join(parts))


def one_of(column: str, values: list) -> Rule:
    """Null passes."""
    return Rule(f"{column} in values", f"{column} NOT IN ({', '.join(map(literal, values))})")


def holds(name: str, expression: str) -> Rule:
    """An expression that is false breaks it; null passes."""
    return Rule(name, f"NOT ({expression})")


def unique(*columns: str) -> Rule:
    """Keys that occur more than once are counted; a null in a single key column passes."""
    return Rule(", ".join(columns) + " unique", keys=columns)


def count_violations(df: DataFrame, of: TableRules) -> DataFrame:
    """table_name, check_name, severity, violations of every rule, from one scan of df."""
    names = [r for r in of.rules if r.broken]
    keyed = [r for r in of.rules if r.keys]
    if of.along:
        order = Window.partitionBy(*of.along[0]).orderBy(F.asc_nulls_first(of.along[1]))
        df = df.withColumns({f"last_{c}": F.lag(c).over(order) for c in of.last})
    flags = {f"_{i}": F.coalesce(F.expr(r.broken), F.lit(False)).cast("int") for i, r in enumerate(names)}
    rows = df.select(*sorted({c for r in keyed for c in r.keys}), *[c.alias(k) for k, c in flags.items()])
    sums = [F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in flags]
    if keyed:
        first = keyed[0]
        rows = rows.groupBy(*first.keys).agg(F.count("*").alias("_n"), *sums)
        sums += [F.count_if(_repeated(first)).alias("_k0")]
    counted = rows.agg(*sums)
    for i, rule in enumerate(keyed[1:], 1):  # a scan for each further key
        counted = counted.crossJoin(df.groupBy(*rule.keys).agg(F.count("*").alias("_n")).agg(F.count_if(_repeated(rule)).alias(f"_k{i}")))
    cells = [(r, f"_{i}") for i, r in enumerate(names)] + [(r, f"_k{i}") for i, r in enumerate(keyed)]
    found = [F.struct(F.lit(r.name).alias("check_name"), F.lit(r.severity).alias("severity"), F.col(c).alias("violations")) for r, c in cells]
    return counted.select(F.lit(of.table).alias("table_name"), F.inline(F.array(*found)))


def _repeated(rule: Rule) -> Column:
    more = F.col("_n") > 1
    return more & F.col(rule.keys[0]).isNotNull() if len(rule.keys) == 1 else more


def count_all(tables: dict[str, DataFrame], rules: list[TableRules]) -> DataFrame:
    """The violations of all tables; each is scanned once."""
    return reduce(DataFrame.unionByName, [count_violations(tables[r.table], r) for r in rules])


GROUPS = ["ai", "cv_pr", "rest_cs"]
#: What a rounded quotient may be off by.
TOLERANCE = 1e-9


def _concentration(table: str, key: str, own: list[Rule], b: Bounds) -> TableRules:
    ratios = ("zero_share", "gini", "gini_cited_only", "top1_share", "top5_share", "top10_share", "age0_citation_share", "zero_share_including_age0")
    nulls = "CAST(top1_share IS NULL AS INT) + CAST(top5_share IS NULL AS INT) + CAST(top10_share IS NULL AS INT)"
    return TableRules(table, (
        unique(key, "publication_year", "citation_age"),
        *not_null("publication_year", key, "citation_age", "n_papers", "total_citations", "zero_share", "zero_share_including_age0"), *own,
        within("publication_year", b.cohort_min, b.cohort_max), within("citation_age", 1), within("n_papers", 1), within("total_citations", 0), *[within(c, 0, 1) for c in ratios],
        Rule("cohort size constant", "n_papers <> last_n_papers"),
        Rule("totals rise", "total_citations < last_total_citations"), Rule("zero share falls", "zero_share > last_zero_share"),
        Rule("zero share with age 0 not above", "zero_share_including_age0 > zero_share"), Rule("zero share with age 0 falls", "zero_share_including_age0 > last_zero_share_including_age0"),
        Rule("age 0 share falls", "age0_citation_share > last_age0_citation_share"),
        Rule("decomposition", f"(gini IS NULL) <> (gini_cited_only IS NULL) OR abs(gini - (zero_share + (1 - zero_share) * gini_cited_only)) > {TOLERANCE}"),
        Rule("tail order", f"top1_share > top5_share OR top5_share > top10_share OR ({nulls}) NOT IN (0, 3) OR (gini IS NULL) <> (top1_share IS NULL)"),
    ), ((key, "publication_year"), "citation_age"), ("n_papers", "total_citations", "zero_share", "zero_share_including_age0", "age0_citation_share"))


def corpus_rules(b: Bounds) -> list[TableRules]:
    """The declared rules of staging, classified works and the four published tables, and those on the order of their measures."""
    quantiles, shares = ("p25_age", "median_age", "p75_age"), ("share_within_2", "share_within_5", "share_within_10")
    return [
        TableRules("staging", (unique("id"), *not_null("id", "publication_year"), within("publication_year", b.year_min, b.year_max), *not_null("primary_topic_subfield_id", severity="warn"))),
        TableRules("works", (
            unique("id"), *not_null("id", "is_ai_strict", "is_ai_broad"), holds("strict is broad", "is_ai_broad OR NOT is_ai_strict"),
            holds("strict is its subfield", f"is_ai_strict = (primary_topic_subfield_id = {literal(b.strict_id)})"),
            holds("broad is its subfields", f"is_ai_broad = (primary_topic_subfield_id IN ({literal(b.strict_id)}, {literal(b.broad_id)}))"),
        )),
        TableRules("share", (
            unique("publication_year", "variant"), *not_null("publication_year", "variant", "cs_works", "ai_works", "share", "is_partial_year"), one_of("variant", ["strict", "broad"]),
            within("cs_works", 1), within("ai_works", 0), within("share", 0, 1), holds("part of all", "ai_works <= cs_works"),
            holds("partial year", f"is_partial_year = (publication_year = {b.partial_year})"),
        )),
        TableRules("ages", (
            unique("citation_year", "cited_group"), *not_null("citation_year", "cited_group", "citation_events", "cited_works", *quantiles, *shares),
            within("citation_year", b.age_year_min, b.age_year_max), one_of("cited_group", GROUPS), within("citation_events", 1), within("cited_works", 1),
            *[within(c, 0) for c in quantiles], *[within(c, 0, 1) for c in shares], holds("works have events", "cited_works <= citation_events"),
            holds("quantile order", "p25_age <= median_age AND median_age <= p75_age"), holds("share order", "share_within_2 <= share_within_5 AND share_within_5 <= share_within_10"),
        )),
        _concentration("by_subfield", "subfield_id", not_null("subfield_display_name", "is_ai_strict", "is_ai_broad"), b),
        _concentration("by_group", "cited_group", [one_of("cited_group", GROUPS)], b),
    ]
