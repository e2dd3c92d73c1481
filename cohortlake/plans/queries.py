"""Registered queries over the driver's tables, each with DuckDB SQL written by another way where SQL can say it."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..bounds import STANDIN as B
from ..functions.parsing import mask_first, records
from ..operators import citation_age, concentration, evidence, intervals, profiling, share, staging, works as classes
from ..sources import landing, tables
from ..schemas import BRONZE, BY_GROUP, UPLOAD_MANIFEST, WORKS
from ..standin import bronze as bronze_records, table, works
from . import checks, manifests, quality

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# Shared parts of the SQL.
_WORKS = """
c AS (SELECT l_orderkey AS k, CAST(year(l_shipdate) AS BIGINT) AS y, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2),
w AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS BIGINT) AS py, o_orderpriority AS sf,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ai' WHEN '2-HIGH' THEN 'cv_pr' ELSE 'rest_cs' END AS g FROM orders),
"""
_CELLS = _WORKS + """
p AS (SELECT w.k, w.py, w.sf, w.g, a.age,
  CAST(coalesce(sum(c.n) FILTER (WHERE c.y > w.py AND c.y <= w.py + a.age), 0) AS BIGINT) AS v, CAST(coalesce(sum(c.n) FILTER (WHERE c.y = w.py), 0) AS BIGINT) AS v0
  FROM w JOIN (SELECT unnest(range(1, 7)) AS age) a ON a.age <= 2001 - w.py LEFT JOIN c ON c.k = w.k WHERE w.py BETWEEN 1995 AND 2000 GROUP BY ALL),
"""


def _cell_sql(key: str) -> str:
    return f"""WITH {_CELLS}
r AS (SELECT *, row_number() OVER (PARTITION BY {key}, py, age ORDER BY v, k) AS r, row_number() OVER (PARTITION BY {key}, py, age ORDER BY v DESC, k) AS d, count(*) OVER (PARTITION BY {key}, py, age) AS m FROM p),
s AS (SELECT {key} AS cell, py, age, count(*) AS n, CAST(sum(v) AS BIGINT) AS t, count(*) FILTER (WHERE v = 0) AS z, CAST(sum((2 * r - m - 1) * v) AS BIGINT) AS num,
  CAST(sum(v) FILTER (WHERE d <= (m + 99) // 100) AS BIGINT) AS t1, CAST(sum(v) FILTER (WHERE d <= (m * 5 + 99) // 100) AS BIGINT) AS t5, CAST(sum(v) FILTER (WHERE d <= (m * 10 + 99) // 100) AS BIGINT) AS t10,
  CAST(sum(v0) AS BIGINT) AS a0, count(*) FILTER (WHERE v + v0 = 0) AS z0 FROM r GROUP BY 1, 2, 3),
q AS (SELECT {key} AS cell, py, age, v, row_number() OVER (PARTITION BY {key}, py, age ORDER BY v, k) AS r, count(*) OVER (PARTITION BY {key}, py, age) AS m FROM p WHERE v > 0),
u AS (SELECT cell, py, age, CAST(sum((2 * r - m - 1) * v) AS BIGINT) AS num, max(m) AS m, CAST(sum(v) AS BIGINT) AS t FROM q GROUP BY 1, 2, 3)
SELECT s.py AS publication_year, s.cell, CAST(s.age AS BIGINT) AS citation_age, s.n AS n_papers, s.t AS total_citations, s.z / s.n AS zero_share, s.num / nullif(s.n * s.t, 0) AS gini,
  u.num / nullif(u.m * u.t, 0) AS gini_cited_only, s.t1 / nullif(s.t, 0) AS top1_share, s.t5 / nullif(s.t, 0) AS top5_share, s.t10 / nullif(s.t, 0) AS top10_share,
  s.a0 / nullif(s.t + s.a0, 0) AS age0_citation_share, s.z0 / s.n AS zero_share_including_age0
FROM s LEFT JOIN u USING (cell, py, age)"""


_AGES = f"""WITH {_WORKS}
e AS (SELECT w.k, w.g, c.y, c.y - w.py AS age, c.n FROM w JOIN c USING (k) WHERE c.y BETWEEN 1995 AND 2001 AND c.y >= w.py AND c.n > 0),
b AS (SELECT y, g, age, CAST(sum(n) AS BIGINT) AS n FROM e GROUP BY 1, 2, 3),
t AS (SELECT y, g, CAST(sum(n) AS BIGINT) AS t FROM b GROUP BY 1, 2),
r AS (SELECT b.y, b.g, b.age, t.t, (SELECT CAST(sum(x.n) AS BIGINT) FROM b x WHERE x.y = b.y AND x.g = b.g AND x.age <= b.age) AS run FROM b JOIN t USING (y, g))
SELECT t.y AS citation_year, t.g AS cited_group, t.t AS citation_events, (SELECT count(DISTINCT k) FROM e WHERE e.y = t.y AND e.g = t.g) AS cited_works,
  (SELECT min(age) FROM r WHERE r.y = t.y AND r.g = t.g AND 4 * run >= r.t) AS p25_age, (SELECT min(age) FROM r WHERE r.y = t.y AND r.g = t.g AND 2 * run >= r.t) AS median_age,
  (SELECT min(age) FROM r WHERE r.y = t.y AND r.g = t.g AND 4 * run >= 3 * r.t) AS p75_age,
  (SELECT CAST(sum(n) AS BIGINT) FROM b WHERE b.y = t.y AND b.g = t.g AND age <= 2) / t.t AS share_within_2, (SELECT CAST(sum(n) AS BIGINT) FROM b WHERE b.y = t.y AND b.g = t.g AND age <= 5) / t.t AS share_within_5,
  (SELECT CAST(sum(n) AS BIGINT) FROM b WHERE b.y = t.y AND b.g = t.g AND age <= 10) / t.t AS share_within_10
FROM t"""


@query("""WITH v AS (SELECT 'strict' AS variant, ['1-URGENT'] AS ids UNION ALL SELECT 'broad', ['1-URGENT', '2-HIGH'])
SELECT CAST(year(o_orderdate) AS BIGINT) AS publication_year, variant, count(*) AS cs_works, count(*) FILTER (WHERE list_contains(ids, o_orderpriority)) AS ai_works,
  count(*) FILTER (WHERE list_contains(ids, o_orderpriority)) / count(*) AS share, year(o_orderdate) = 2001 AS is_partial_year FROM orders, v GROUP BY ALL""")
def share_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share.share_by_year(works(spark, sf_dir), B)


@query(_AGES)
def citation_age_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citation_age.citation_age_by_year(works(spark, sf_dir), B)


@query(f"SELECT c.publication_year, c.cell AS subfield_id, substr(c.cell, 3) AS subfield_display_name, c.cell = '1-URGENT' AS is_ai_strict, c.cell IN ('1-URGENT', '2-HIGH') AS is_ai_broad, c.* EXCLUDE (publication_year, cell) FROM ({_cell_sql('sf')}) c")
def concentration_by_subfield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.concentration_by_subfield(works(spark, sf_dir), B)


@query(f"SELECT c.cell AS cited_group, c.* EXCLUDE (cell) FROM ({_cell_sql('g')}) c")
def concentration_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.concentration_by_group(works(spark, sf_dir), B)


@query(f"WITH {_CELLS} z AS (SELECT 1) SELECT CAST(k AS VARCHAR) AS id, py AS publication_year, sf AS primary_topic_subfield_id, CAST(age AS BIGINT) AS citation_age, v AS window_citations, v0 AS age0_citations FROM p")
def paper_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.paper_windows(works(spark, sf_dir), B)


@query(f"WITH {_CELLS} z AS (SELECT 1) SELECT sf AS primary_topic_subfield_id, py AS publication_year, CAST(age AS BIGINT) AS citation_age, v AS window_citations, count(*) AS papers, CAST(sum(v0) AS BIGINT) AS age0, count(*) FILTER (WHERE v + v0 = 0) AS zero_with_age0 FROM p GROUP BY 1, 2, 3, 4")
def value_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.value_frequencies(concentration.paper_windows(works(spark, sf_dir), B))


@query("""SELECT o_orderpriority AS subfield_id, max(substr(o_orderpriority, 3)) AS subfield_display_name, o_orderpriority = '1-URGENT' AS is_ai_strict, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_ai_broad
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2000 GROUP BY o_orderpriority""")
def label_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.label_mapping(works(spark, sf_dir), B)


@query(f"WITH {_WORKS} z AS (SELECT 1) SELECT c.y AS citation_year, w.g AS cited_group, c.y - w.py AS age, c.n AS weight, CAST(w.k AS VARCHAR) AS id FROM w JOIN c USING (k) WHERE c.y BETWEEN 1995 AND 2001 AND c.y >= w.py AND c.n > 0")
def eligible_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citation_age.eligible_events(works(spark, sf_dir), B)


@query("""SELECT o_orderkey AS id, o_orderpriority AS subfield, coalesce(o_orderpriority = '1-URGENT', false) AS is_ai_strict, coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS is_ai_broad,
CASE o_orderpriority WHEN '1-URGENT' THEN 'ai' WHEN '2-HIGH' THEN 'cv_pr' ELSE 'rest_cs' END AS cited_group, coalesce(o_orderpriority, '__unclassified__') AS bucket FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999""")
def classified_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("subfield"), F.year("o_orderdate").alias("publication_year"))
    rows = classes.classify(staging.year_bounds(orders, 1996, 1999), B, "subfield")
    return rows.select("id", "subfield", "is_ai_strict", "is_ai_broad", classes.cited_group(F.col("subfield"), B).alias("cited_group"), classes.subfield_bucket(F.col("subfield")).alias("bucket"))


@query("""SELECT event_id, user_id, event_type, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.latest(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value"), ["user_id", "event_type"], "ts", ["event_id"])


@query("SELECT c.k AS id, c.y AS year, c.n AS cited_by_count FROM (SELECT l_orderkey AS k, CAST(year(l_shipdate) AS BIGINT) AS y, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2) c")
def parsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested array as JSON text, parsed by staging and unnested."""
    text = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.year("l_shipdate").cast("long").alias("year")).agg(F.sum("l_quantity").cast("long").alias("cited_by_count"))
    text = text.groupBy(F.col("l_orderkey").alias("id")).agg(F.to_json(F.collect_list(F.struct("year", "cited_by_count"))).alias("text"))
    return text.select("id", F.inline(records(F.col("text"), staging.COUNTS)))


@query("""SELECT 'l_returnflag' AS check_name, count(DISTINCT l_returnflag) AS violations FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'l_discount', count(*) FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.05
UNION ALL SELECT 'l_orderkey', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'l_orderkey, l_partkey', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
UNION ALL SELECT 'shipped in the year', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(l_shipdate) <> year(o_orderdate)
UNION ALL SELECT 'quality', count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def generic_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    dated = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    labelled = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.report([
        quality.Check("l_returnflag", lambda: quality.accepted_values(items, "l_returnflag", ["A", "N"])),
        quality.Check("l_discount", lambda: quality.accepted_range(items, "l_discount", 0.01, 0.05)),
        quality.Check("l_orderkey", lambda: quality.unique(items, "l_orderkey")), quality.Check("l_orderkey, l_partkey", lambda: quality.unique_combination(items, ["l_orderkey", "l_partkey"])),
        quality.Check("shipped in the year", lambda: quality.expression_true(dated, "year(l_shipdate) = year(o_orderdate)")), quality.Check("quality", lambda: quality.not_null(labelled, "quality")),
    ]).drop("severity")


@query(f"""WITH {_WORKS} early AS (SELECT count(*) AS n FROM w JOIN c USING (k) WHERE c.y BETWEEN 1995 AND 2001 AND c.y < w.py AND c.n > 0),
names AS (SELECT unnest(['works_entries_valid', 'works_entries_before_publication', 'share_strict_below_broad', 'ages_groups_complete', 'ages_reconcile', 'subfield_strict_present', 'subfield_cohort_floor', 'source_retains_floor',
'subfield_labels', 'subfield_bucket', 'grains_agree', 'by_subfield_triangle', 'by_subfield_source_reconcile', 'by_group_triangle', 'by_group_source_reconcile']) AS name)
SELECT name AS check_name, CASE name WHEN 'works_entries_before_publication' THEN 'warn' ELSE 'error' END AS severity, CASE name WHEN 'works_entries_before_publication' THEN n ELSE 0 END AS violations FROM names, early""")
def corpus_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of every check that compares works and gold tables; these are written once and read by all checks."""
    rows = tables.written(works(spark, sf_dir), "works")
    gold = [tables.written(f(rows, B), f.__name__) for f in (share.share_by_year, citation_age.citation_age_by_year, concentration.concentration_by_subfield, concentration.concentration_by_group)]
    return quality.report(checks.corpus_checks(spark, rows, *gold, B))


@query(f"WITH {_WORKS} z AS (SELECT 1) SELECT CAST(w.k AS VARCHAR) AS id, w.py AS publication_year, c.y AS year, c.n AS cited_by_count FROM w JOIN c USING (k) WHERE c.y BETWEEN 1995 AND 2001 AND c.y < w.py AND c.n > 0")
def entries_before_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.entries_before_publication(works(spark, sf_dir), B)


@query("""SELECT page_id AS key, 'missing' AS problem FROM (SELECT DISTINCT page_id FROM pages) WHERE page_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)""")
def labelled_key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_difference(table(spark, sf_dir, "pages").select(F.col("page_id").alias("key")), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key")), ["key"])


@query("""WITH a AS (SELECT o_orderkey AS k, year(o_orderdate) AS v FROM orders), b AS (SELECT l_orderkey AS k, min(year(l_shipdate)) AS v FROM lineitem GROUP BY 1)
SELECT k, CAST(a.v AS INTEGER) AS left_v, CAST(b.v AS INTEGER) AS right_v FROM a FULL JOIN b USING (k) WHERE a.v IS DISTINCT FROM b.v OR a.k IS NULL OR b.k IS NULL""")
def reconciled_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("v"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min(F.year("l_shipdate")).alias("v"))
    return quality.reconcile(a, b, ["k"], ["v"])


@query("""WITH s AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, 'documents' AS s FROM documents UNION SELECT CAST(doc_id AS VARCHAR), 'labels' FROM labels UNION SELECT CAST(page_id AS VARCHAR), 'pages' FROM pages),
p AS (SELECT 'documents' AS a, 'labels' AS b UNION ALL SELECT 'documents', 'pages' UNION ALL SELECT 'labels', 'pages')
SELECT a AS left_source, b AS right_source, (SELECT count(*) FROM (SELECT id FROM s WHERE s = a EXCEPT SELECT id FROM s WHERE s = b)) AS only_left,
  (SELECT count(*) FROM (SELECT id FROM s WHERE s = b EXCEPT SELECT id FROM s WHERE s = a)) AS only_right, (SELECT count(*) FROM (SELECT id FROM s WHERE s = a INTERSECT SELECT id FROM s WHERE s = b)) AS "both" FROM p""")
def compare_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.compare_sources({"documents": table(spark, sf_dir, "documents").select("doc_id"), "labels": table(spark, sf_dir, "labels").select("doc_id"), "pages": table(spark, sf_dir, "pages").select("page_id")})


_SOURCES = "s AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, 'documents' AS s FROM documents UNION SELECT CAST(doc_id AS VARCHAR), 'labels' FROM labels UNION SELECT CAST(page_id AS VARCHAR), 'pages' FROM pages)"


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"documents": table(spark, sf_dir, "documents").select("doc_id"), "labels": table(spark, sf_dir, "labels").select("doc_id"), "pages": table(spark, sf_dir, "pages").select("page_id")}


@query(f"""WITH {_SOURCES}, p AS (SELECT 'documents' AS a, 'labels' AS b UNION ALL SELECT 'documents', 'pages' UNION ALL SELECT 'labels', 'pages')
SELECT a AS left_source, b AS right_source, 'left' AS side, id FROM p, s x WHERE x.s = a AND id NOT IN (SELECT id FROM s y WHERE y.s = b)
UNION ALL SELECT a, b, 'right', id FROM p, s x WHERE x.s = b AND id NOT IN (SELECT id FROM s y WHERE y.s = a)""")
def differing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.differing_ids(_sources(spark, sf_dir))


@query(f"""WITH {_SOURCES} (SELECT id FROM s WHERE s = 'documents' EXCEPT SELECT id FROM s WHERE s = 'labels') UNION ((SELECT id FROM s WHERE s = 'labels') INTERSECT (SELECT id FROM s WHERE s = 'pages'))""")
def id_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents without a label, and labelled ids that are a page's too."""
    sources = _sources(spark, sf_dir)
    return profiling.id_set(profiling.source_masks(sources), list(sources), "documents AND NOT labels OR labels AND pages")


@query("""WITH k AS (SELECT nullif(user_id, 7) AS id, count(*) AS n FROM events GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS records, CAST(sum(n) FILTER (WHERE id IS NULL) AS BIGINT) AS missing, count(id) AS ids,
count(*) FILTER (WHERE id IS NOT NULL AND n > 1) AS repeated, CAST(sum(n - 1) FILTER (WHERE id IS NOT NULL) AS BIGINT) AS excess FROM k""")
def summarize_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.summarize_source(table(spark, sf_dir, "events").select(F.expr("nullif(user_id, 7)").alias("user_id")), "user_id")


@query("""SELECT e.event_id, e.user_id, epoch_us(e.ts) AS at, i.event_id AS error_id, epoch_us(i.ts) AS low, epoch_us(i.ts) + CAST(floor(i.value * 600) AS BIGINT) * 1000000 AS high FROM events e
LEFT JOIN events i ON i.event_type = 'error' AND i.user_id = e.user_id AND epoch_us(e.ts) BETWEEN epoch_us(i.ts) AND epoch_us(i.ts) + CAST(floor(i.value * 600) AS BIGINT) * 1000000""")
def events_in_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event beside the intervals after errors of its user that it falls into; their lengths go from seconds to days."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "value")
    errors = events.where("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("at").alias("low"), (F.col("at") + F.floor(F.col("value") * 600) * 1_000_000).alias("high"))
    return intervals.left_interval_join(events.select("event_id", "user_id", "at"), errors, "event_id", ["user_id"], "at", "low", "high", width=1 << 30)


@query("SELECT event_type, count(*) AS \"rows\", count(DISTINCT user_id) AS keys, count(*) - count(DISTINCT user_id) AS excess FROM events GROUP BY 1")
def duplicate_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.duplicate_excess(table(spark, sf_dir, "events"), "user_id", ["event_type"])


@query("SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.duplicated_ids(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""SELECT r_name, to_json(list({'n_name': n_name} ORDER BY n_nationkey)) AS children FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def nest_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return profiling.nest_hierarchy(rows, ["r_name"], ["n_name"], "n_nationkey").select("r_name", F.to_json("children").alias("children"))


@query("""SELECT doc_id, length(text) AS characters, CASE WHEN text = '' THEN 0 ELSE length(regexp_replace(text, '\\n$', '')) - length(replace(regexp_replace(text, '\\n$', ''), chr(10), '')) + 1 END AS lines,
CAST(round_even(length(text) / 4.0, 0) AS BIGINT) AS tokens FROM documents""")
def measure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in profiling.measure_text(F.col("text")).items()])


@query("""SELECT split_part(regexp_extract(url, '://([^?#]*)', 1), '/', 1) || CASE WHEN length(regexp_replace(regexp_extract(url, '://([^?#]*)', 1), '[^/]', '', 'g')) >= 2 THEN '/' || split_part(regexp_extract(url, '://([^?#]*)', 1), '/', 2) ELSE '' END AS "group",
count(*) AS files, CAST(sum(length(html)) AS BIGINT) AS n_chars FROM pages GROUP BY 1""")
def rollup_by_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^?#]*)", 1).alias("path"), F.length("html").cast("long").alias("n_chars"))
    return profiling.rollup_by_depth(pages, "path", 2, ["n_chars"])


@query("""SELECT source, count(*) AS files, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 5""")
def heaviest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("files"), F.sum(F.length("text")).alias("n_chars"))
    return profiling.heaviest(rows, "n_chars", 5, ["source"])


@query("SELECT o_orderstatus AS status, count(*) AS n, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END) AS BIGINT) AS moved_size FROM orders GROUP BY 1")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.run_totals(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), "o_orderstatus", "year", "o_custkey", "F")


@query("""SELECT CASE WHEN event_type IN ('click', 'view') THEN 'OBJECT<k: BIGINT>' ELSE 'OBJECT<k: VARIANT>' END AS signature, list(DISTINCT event_type ORDER BY event_type) AS shards, count(DISTINCT event_type) AS n FROM events GROUP BY 1""")
def schema_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events, of which some types hold a text once in a while."""
    props = F.when(~F.col("event_type").isin("click", "view") & (F.col("event_id") % 5 == 0), '{"k": "many"}').otherwise(F.col("props"))
    return profiling.schema_signatures(table(spark, sf_dir, "events").withColumn("props", props), "event_type", "props")


@query("""SELECT DISTINCT y AS shard, d.path, d.change, d.expected, d.found FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders) JOIN (VALUES ('1997', 'topic.size', 'removed', 'BIGINT', NULL), ('1998', 'topic.size', 'retyped', 'BIGINT', 'STRING'),
('1999', 'tags', 'added', NULL, 'ARRAY'), ('1999', 'tags[*]', 'added', NULL, 'OBJECT'), ('1999', 'tags[*].name', 'added', NULL, 'STRING'), ('2000', 'topic', 'retyped', 'OBJECT', 'STRING'), ('2000', 'topic.id', 'removed', 'STRING', NULL), ('2000', 'topic.size', 'removed', 'BIGINT', NULL))
d(shard, path, change, expected, found) ON d.shard = y""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines of which four years have drifted, each in another way; a line's shard is the folder of its file."""
    year, size = F.year("o_orderdate"), F.col("o_custkey").cast("long")
    topic = lambda *fields: F.to_json(F.struct(F.col("o_orderpriority").alias("id"), *fields))
    rows = table(spark, sf_dir, "orders").select(year.cast("long").alias("publication_year"), F.concat(F.lit("W"), "o_orderkey").alias("id"), F.parse_json(
        F.when(year == 1997, topic()).when(year == 1998, topic(size.cast("string").alias("size"))).when(year == 2000, F.to_json(F.array("o_orderpriority")).substr(F.lit(2), F.length("o_orderpriority") + 2)).otherwise(topic(size.alias("size")))
    ).alias("topic"), F.when(year == 1999, F.array(F.struct(F.col("o_orderstatus").alias("name")))).alias("tags"))
    root = tables.scratch(spark, "landing")
    LandingZone(spark, root, packed=True).write(rows)
    return profiling.schema_drift(landing.read_lines(spark, root), "folder", "value")


@query("""WITH o AS (SELECT o_orderkey AS k, year(o_orderdate) AS y FROM orders), n AS (SELECT l_orderkey AS k FROM lineitem GROUP BY 1)
SELECT 'counts_by_year' AS json_column, count(*) AS ids, count(n.k) AS "values", count(n.k) FILTER (WHERE y <> 1997) AS parsed, count(*) FILTER (WHERE n.k IS NULL OR y <> 1997) AS same FROM o LEFT JOIN n USING (k)
UNION ALL SELECT 'open_access', count(*), count(*), count(*), count(*) FILTER (WHERE y <> 1998) FROM o UNION ALL SELECT 'ids', count(*), count(*), count(*), count(*) FROM o""")
def landed_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines with nested values against the bronze made of them, in which one column's texts are cut off in a year, another's changed in a year, and a third's keys are in another order."""
    names = ["counts_by_year", "open_access", "ids"]
    root, base = tables.scratch(spark, "landing"), tables.scratch(spark, "bronze")
    zone = LandingZone(spark, root, packed=True)
    zone.write(bronze_records(spark, sf_dir, nested=tuple(names)).where("title <> 'a'"))
    found = landing.discover_years(zone.inventory())
    manifests.ingest(spark, root, base, landing.shard_states(zone.inventory(), found, found.limit(0)))
    ids = F.from_json("ids", "doi STRING, mag BIGINT")
    stored = tables.read_bronze(spark, base).withColumns({
        "counts_by_year": F.expr("IF(publication_year = 1997, left(counts_by_year, 9), counts_by_year)"), "open_access": F.expr("IF(publication_year = 1998, replace(open_access, 'oa_status', 'status'), open_access)"),
        "ids": F.to_json(F.struct(ids["mag"].alias("mag"), ids["doi"].alias("doi"))),
    })
    return profiling.landed_fidelity(landing.read_lines(spark, root), "value", stored, "id", names)


@query("SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber <> 1) AS parsed, count(*) FILTER (WHERE l_linenumber <> 1 AND l_returnflag <> 'R') AS same FROM lineitem")
def json_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as JSON, and again with their keys in another order; the first item of each order is cut off, and returned ones have another flag."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    stored = F.to_json(F.struct(F.expr("replace(l_returnflag, 'R', 'X')").alias("l_returnflag"), *columns[2::-1]))
    rows = table(spark, sf_dir, "lineitem").select(F.to_json(F.struct(*columns)).alias("source"), F.when(F.col("l_linenumber") == 1, F.substring(stored, 1, 9)).otherwise(stored).alias("stored"))
    return profiling.json_fidelity(rows, "source", "stored")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, replace('filter=year:' || year(o_orderdate) || ',status:' || o_orderstatus, 'year:' || year(o_orderdate), '*') AS masked FROM orders")
def masked_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.year("o_orderdate").cast("string").alias("year"), "o_orderstatus")
    text = F.concat(F.lit("filter=year:"), "year", F.lit(",status:"), "o_orderstatus")
    return rows.select("id", mask_first(text, F.concat(F.lit("year:"), "year")).alias("masked"))


@query(f"""WITH b AS ({_cell_sql('g')}) SELECT cell AS cited_group, publication_year, gini, gini - lag(gini) OVER (PARTITION BY cell ORDER BY publication_year) AS change FROM b WHERE citation_age = 2""")
def cohort_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.cohort_trend(concentration.concentration_by_group(works(spark, sf_dir), B), 2)


@query(f"WITH b AS ({_cell_sql('sf')}) SELECT publication_year, citation_age, cell AS subfield_id, rank() OVER (PARTITION BY publication_year, citation_age ORDER BY gini DESC) AS position FROM b")
def rank_among_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.rank_among_peers(concentration.concentration_by_subfield(works(spark, sf_dir), B))


@query(f"WITH a AS ({_AGES}) SELECT cited_group, min(citation_year) FILTER (WHERE median_age <= 1) AS first_year FROM a GROUP BY 1")
def first_year_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.first_year_at(citation_age.citation_age_by_year(works(spark, sf_dir), B), 1)


@query(f"""WITH {_WORKS} e AS (SELECT c.n, c.y - w.py AS age FROM w JOIN c USING (k) WHERE c.n > 0)
SELECT count(*) FILTER (WHERE age < 0) AS entries, CAST(sum(n) FILTER (WHERE age < 0) AS BIGINT) AS weight, min(age) FILTER (WHERE age < 0) AS first_age, max(age) FILTER (WHERE age < 0) AS last_age,
CAST(sum(n) FILTER (WHERE age < 0) AS BIGINT) / CAST(sum(n) AS BIGINT) AS share FROM e""")
def negative_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.negative_ages(works(spark, sf_dir))


def _edge_sql(key: str, name: str) -> str:
    measures = ", ".join(evidence.MEASURES)
    window = lambda part, order: f"OVER (PARTITION BY cell, measure, {part} ORDER BY {order})"
    before = lambda part, order: f"OVER (PARTITION BY cell, measure, {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def edge(part: str, order: str, view: str, rows: str) -> str:
        w, p = window(part, order), before(part, order)
        return f"""SELECT cell AS {name}, measure, {view} AS view, before, value, step, count(step) {p} AS earlier_steps, max(step) {p} - min(step) {p} AS earlier_spread, publication_year + citation_age AS ends
        FROM (SELECT *, lag(value) {w} AS before, value - lag(value) {w} AS step FROM m WHERE {rows})"""

    return f"""WITH b AS ({_cell_sql(key)}), m AS (FROM (SELECT cell, publication_year, citation_age, {measures} FROM b) UNPIVOT INCLUDE NULLS (value FOR measure IN ({measures})))
    SELECT * EXCLUDE (ends) FROM ({edge("citation_age", "publication_year", "'age ' || citation_age", "citation_age IN (3, 5)")} UNION ALL {edge("publication_year", "citation_age", "'cohort ' || publication_year", "true")})
    WHERE ends = 2001 AND before IS NOT NULL"""


@query(_edge_sql("g", "cited_group"))
def terminal_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.terminal_edge(concentration.concentration_by_group(works(spark, sf_dir), B), "cited_group", B)


@query(_edge_sql("sf", "subfield_id"))
def terminal_edge_of_subfields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.terminal_edge(concentration.concentration_by_subfield(works(spark, sf_dir), B), "subfield_id", B)


@query(f"""WITH a AS ({_cell_sql("g").replace("c.y > w.py AND", "c.y >= w.py AND")}), b AS ({_cell_sql("g")})
SELECT a.cell AS cited_group, a.publication_year, a.citation_age, {", ".join(f"a.{c} - b.{c} AS delta_{c}" for c in evidence.DELTAS)}
FROM a JOIN b ON a.cell = b.cell AND a.publication_year = b.publication_year AND a.citation_age = b.citation_age""")
def age0_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.age0_sensitivity(works(spark, sf_dir), B)


@query(f"""WITH s AS ({_cell_sql("sf")}), g AS ({_cell_sql("g")}),
m AS (SELECT CASE cell WHEN '1-URGENT' THEN 'ai' WHEN '2-HIGH' THEN 'cv_pr' ELSE 'rest_cs' END AS cell, publication_year, citation_age, avg(gini) AS mean, stddev_samp(gini) AS sd, count(gini) AS members FROM s GROUP BY 1, 2, 3)
SELECT g.cell AS cited_group, g.publication_year, g.citation_age, g.gini AS pooled_gini, round(m.mean, 9) AS mean_member_gini, round(m.sd, 9) AS sd_member_gini, m.members
FROM g JOIN m ON g.cell = m.cell AND g.publication_year = m.publication_year AND g.citation_age = m.citation_age""")
def pooled_against_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and spreads are rounded to nine digits, as their sums depend on the order of members."""
    rows = works(spark, sf_dir)
    found = evidence.pooled_against_members(concentration.concentration_by_subfield(rows, B), concentration.concentration_by_group(rows, B), classes.cited_group(F.col("subfield_id"), B))
    return found.withColumns({c: F.round(c, 9) for c in ("mean_member_gini", "sd_member_gini")})


_CHANGED_CELLS = _cell_sql("sf").replace("FROM lineitem GROUP BY", "FROM lineitem WHERE year(l_shipdate) <> 1998 GROUP BY").replace("FROM orders)", "FROM orders WHERE o_orderpriority <> '5-LOW')")
_COMPARED = """SELECT count(*) FILTER (WHERE a.cell IS NULL) AS missing_left, count(*) FILTER (WHERE b.cell IS NULL) AS missing_right,
count(*) FILTER (WHERE a.cell IS NOT NULL AND b.cell IS NOT NULL AND a.strict IS DISTINCT FROM b.strict) AS changed_is_ai_strict, count(*) FILTER (WHERE a.cell IS NOT NULL AND b.cell IS NOT NULL AND a.broad IS DISTINCT FROM b.broad) AS changed_is_ai_broad,
CAST(sum(abs(a.n_papers - b.n_papers)) AS BIGINT) AS apart_n_papers, CAST(sum(abs(a.total_citations - b.total_citations)) AS BIGINT) AS apart_total_citations,
max(abs(a.n_papers - b.n_papers)) AS worst_n_papers, max(abs(a.total_citations - b.total_citations)) AS worst_total_citations, max(abs(a.gini - b.gini)) AS worst_gini, max(abs(a.top1_share - b.top1_share)) AS worst_top1_share,
count(*) FILTER (WHERE a.cell IS NOT NULL AND b.cell IS NOT NULL AND (a.strict IS DISTINCT FROM b.strict OR a.broad IS DISTINCT FROM b.broad OR abs(a.n_papers - b.n_papers) > 0.05 * greatest(a.n_papers, b.n_papers)
  OR coalesce(abs(a.total_citations - b.total_citations) > 0.05 * greatest(a.total_citations, b.total_citations), false) OR coalesce(abs(a.gini - b.gini) > 0.02, false) OR coalesce(abs(a.top1_share - b.top1_share) > 0.02, false)
  OR (a.gini IS NULL) <> (b.gini IS NULL) OR (a.top1_share IS NULL) <> (b.top1_share IS NULL))) AS cells_beyond
FROM a FULL JOIN b ON a.cell = b.cell AND a.publication_year = b.publication_year AND a.citation_age = b.citation_age"""
_FLAGGED = "SELECT *, cell = '1-URGENT' AS strict, cell IN ('1-URGENT', '2-HIGH') AS broad FROM"


def _compared(spark: SparkSession, sf_dir: str, change) -> DataFrame:
    rows = works(spark, sf_dir)
    a, b = concentration.concentration_by_subfield(rows, B), concentration.concentration_by_subfield(change(rows), B)
    return evidence.compare_builds(a, b, ["subfield_id", "publication_year", "citation_age"], ["n_papers", "total_citations"], ["gini", "top1_share"], ("is_ai_strict", "is_ai_broad"), 0.05, 0.02)


@query(f"""WITH a AS ({_FLAGGED} ({_cell_sql("sf")})), b AS (SELECT * EXCLUDE (strict), strict AND cell <> '1-URGENT' AS strict FROM ({_FLAGGED} ({_CHANGED_CELLS}))), c AS ({_COMPARED})
SELECT *, missing_left + missing_right + cells_beyond = 0 AS agree FROM c""")
def compare_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table by subfield against one built from works without a subfield, without the entries of one year, and with a flag lost."""
    return _compared(spark, sf_dir, lambda rows: rows.where("primary_topic_subfield_id <> '5-LOW'").withColumns({"counts_by_year": F.expr("filter(counts_by_year, e -> e.year <> 1998)"), "is_ai_strict": F.lit(False)}))


@query(f"WITH a AS ({_FLAGGED} ({_cell_sql('sf')})), b AS (SELECT * FROM a), c AS ({_COMPARED}) SELECT *, missing_left + missing_right + cells_beyond = 0 AS agree FROM c")
def compare_equal_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table built twice, from works in another order."""
    return _compared(spark, sf_dir, lambda rows: rows.repartition(7))


@query("SELECT CAST(year(o_orderdate) AS BIGINT) AS publication_year, 'INGESTED' AS status, count(*) AS records_fetched, count(*) AS bronze_row_count, CAST(0 AS BIGINT) AS duplicate_id_count FROM orders GROUP BY 1")
def landed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a landing zone of pages and reports, ingested to bronze, and the manifest of the result."""
    root, base = tables.scratch(spark, "landing"), tables.scratch(spark, "bronze")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("title"), F.year("o_orderdate").cast("long").alias("publication_year"))
    zone = LandingZone(spark, root, packed=True)
    zone.write(rows)
    states = landing.shard_states(zone.inventory(), landing.year_axis(spark, B.year_min, B.year_max), rows.limit(0).select("publication_year"))
    manifests.ingest(spark, root, base, states)
    bronze = tables.read_bronze(spark, base)
    files = landing.landing_inventory(spark, base)
    states = landing.shard_states(zone.inventory(), landing.year_axis(spark, B.year_min, B.year_max), landing.ingested_years(files))
    return manifests.bronze_manifest(states, landing.read_reports(spark, root), bronze, files).select("publication_year", "status", "records_fetched", "bronze_row_count", "duplicate_id_count")


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS publication_year, CASE WHEN year(o_orderdate) = 1997 THEN 'READY' ELSE 'INGESTED' END AS status, count(*) + CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END AS records_fetched,
CASE WHEN year(o_orderdate) <> 1997 THEN count(*) END AS bronze_row_count, CAST(0 AS BIGINT) AS rows_after_refusal FROM orders GROUP BY year(o_orderdate)""")
def refused_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing zone of which one year's report says a record more than there is: ingesting all years leaves nothing, ingesting the others leaves these."""
    root, base = tables.scratch(spark, "landing"), tables.scratch(spark, "bronze")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("title"), F.year("o_orderdate").cast("long").alias("publication_year"))
    zone = LandingZone(spark, root, packed=True)
    zone.write(rows, rows.where("publication_year = 1997").groupBy("publication_year").agg((F.count("*") + 1).alias("records_fetched")))
    axis = landing.discover_years(zone.inventory())
    states = landing.shard_states(zone.inventory(), axis, rows.limit(0).select("publication_year"))
    try:
        manifests.ingest(spark, root, base, states)
        raise AssertionError("a report that does not agree has to stop the ingest")
    except manifests.IntegrityError:
        left = landing.landing_inventory(spark, base).count()
    manifests.ingest(spark, root, base, states.where("publication_year <> 1997"))
    files = landing.landing_inventory(spark, base)
    states = landing.shard_states(zone.inventory(), axis, landing.ingested_years(files))
    found = manifests.bronze_manifest(states, landing.read_reports(spark, root), tables.read_bronze(spark, base), files)
    return found.select("publication_year", "status", "records_fetched", "bronze_row_count", F.lit(left).cast("long").alias("rows_after_refusal"))


_STAGED = """n AS (SELECT l_orderkey AS k, count(DISTINCT year(l_shipdate)) AS years, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1),
s AS (SELECT o.*, CAST(year(o_orderdate) AS BIGINT) AS y, coalesce(n.years, 0) AS years, CAST(coalesce(n.total, 0) AS BIGINT) AS total, o_orderkey AS k FROM orders o LEFT JOIN n ON n.k = o_orderkey
  WHERE o_orderstatus <> 'P' AND o_orderkey % 11 <> 0 AND year(o_orderdate) BETWEEN 1995 AND 2001)"""


@query(f"""WITH {_STAGED} SELECT 'W' || k AS id, 'order ' || k AS title, y AS publication_year, CASE WHEN k % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS publication_date, o_orderdate AS updated_date,
o_orderstatus AS primary_topic_id, CAST(k % 4 AS DOUBLE) AS primary_topic_score, o_orderpriority AS primary_topic_subfield_id, substr(o_orderpriority, 3) AS primary_topic_subfield_display_name, 'f' AS primary_topic_field_id,
CAST(NULL AS VARCHAR) AS primary_topic_field_display_name, CASE WHEN k % 2 = 0 THEN true END AS is_oa, o_orderstatus AS oa_status, k % 100 AS cited_by_percentile_year_min, CAST(NULL AS BIGINT) AS cited_by_percentile_year_max,
o_totalprice / 1000 AS citation_normalized_percentile_value, o_totalprice > 250000 AS is_in_top_1_percent, CAST(NULL AS BOOLEAN) AS is_in_top_10_percent, 'doi:' || k AS doi_url, CAST(k AS VARCHAR) AS mag_id,
CAST(k % 3 AS INTEGER) AS n_topics, CASE WHEN k % 3 > 0 THEN o_orderpriority END AS first_topic_subfield, CAST(k % 2 AS INTEGER) AS n_keywords, CAST(NULL AS DOUBLE) AS first_keyword_score, CAST(years AS INTEGER) AS n_years FROM s""")
def staged_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of JSON texts staged: filtered, parsed, typed, and the freshest of each id kept; arrays as their sizes and first elements."""
    rows = staging.stage(bronze_records(spark, sf_dir), B)
    return rows.select(
        "id", "title", "publication_year", "publication_date", "updated_date", "primary_topic_id", "primary_topic_score", "primary_topic_subfield_id", "primary_topic_subfield_display_name", "primary_topic_field_id",
        "primary_topic_field_display_name", "is_oa", "oa_status", "cited_by_percentile_year_min", "cited_by_percentile_year_max", "citation_normalized_percentile_value", "is_in_top_1_percent", "is_in_top_10_percent",
        "doi_url", "mag_id", F.size("topics").alias("n_topics"), F.get("topics", F.lit(0))["subfield_id"].alias("first_topic_subfield"), F.size("keywords").alias("n_keywords"),
        F.get("keywords", F.lit(0))["score"].alias("first_keyword_score"), F.size("counts_by_year").alias("n_years"),
    )


@query(f"""WITH {_STAGED} SELECT 'W' || k AS id, y AS publication_year, CASE WHEN k % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS publication_date, o_orderstatus AS primary_topic_id, o_orderstatus AS primary_topic_display_name,
o_orderpriority AS primary_topic_subfield_id, substr(o_orderpriority, 3) AS primary_topic_subfield_display_name, o_orderpriority = '1-URGENT' AS is_ai_strict, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_ai_broad,
total AS cited_by_count, o_totalprice AS fwci, CAST(years AS INTEGER) AS n_years, total AS entries_total FROM s""")
def landed_silver_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a landing zone of records in their full schema over bronze and staging to classified works."""
    root, base = tables.scratch(spark, "landing"), tables.scratch(spark, "bronze")
    zone = LandingZone(spark, root, packed=True)
    zone.write(bronze_records(spark, sf_dir))
    inventory = zone.inventory()
    manifests.ingest(spark, root, base, landing.shard_states(inventory, landing.discover_years(inventory), landing.discover_years(inventory).limit(0)))
    rows = classes.silver_works(staging.stage(tables.read_bronze(spark, base), B), B)
    total = F.aggregate("counts_by_year", F.lit(0).cast("long"), lambda s, e: s + e["cited_by_count"])
    return rows.select(*[c for c in WORKS.fieldNames() if c != "counts_by_year"], F.size("counts_by_year").alias("n_years"), total.alias("entries_total"))


_REPORTS = "r AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS expected_count, count(*) FILTER (WHERE o_totalprice > 1000 * year(o_orderdate) - 1990000) AS records_fetched FROM orders GROUP BY 1)"


@query(f"""WITH {_REPORTS} SELECT year, expected_count, records_fetched, records_fetched - expected_count AS drift, records_fetched <> expected_count AS differs,
abs(records_fetched - expected_count) > greatest(5, 0.01 * expected_count) AS alarm FROM r""")
def count_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a year against those above a price, which falls behind more from year to year."""
    year = F.year("o_orderdate")
    rows = table(spark, sf_dir, "orders").groupBy(year.cast("long").alias("year")).agg(F.count("*").alias("expected_count"), F.count_if(F.col("o_totalprice") > 1000 * year - 1990000).alias("records_fetched"))
    return landing.count_drift(rows, least=5, share=0.01)


@query("""SELECT 'filter=*,status:' || o_orderstatus AS masked, CAST(len(list(DISTINCT year(o_orderdate))) AS INTEGER) AS n_years, CAST(min(year(o_orderdate)) AS BIGINT) AS first_year FROM orders GROUP BY 1""")
def query_homogeneity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of a year and a status: one for each status is left when the year is masked."""
    year = F.year("o_orderdate").cast("long")
    reports = table(spark, sf_dir, "orders").select(year.alias("year"), F.concat(F.lit("filter=publication_year:"), year, F.lit(",status:"), "o_orderstatus").alias("query")).distinct()
    return landing.query_homogeneity(reports).select("masked", F.size("years").alias("n_years"), F.get("years", F.lit(0)).alias("first_year"))


_TIMES = """o AS (SELECT o_orderkey AS key, o_orderdate AS modified FROM orders), i AS (SELECT l_orderkey AS key, min(l_shipdate) AS modified FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)"""


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("modified"), (F.col("o_orderstatus") != "P").alias("complete"))
    items = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_shipdate").alias("modified")).withColumn("complete", F.lit(True))
    return orders, items


@query(f"WITH {_TIMES} SELECT key FROM o WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.key = o.key AND i.modified >= o.modified)")
def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which no item was shipped, or one before the order."""
    return manifests.stale_partitions(*_layers(spark, sf_dir), key="key")


@query(f"""WITH {_TIMES} SELECT o_orderkey AS key FROM orders WHERE o_orderstatus = 'P' OR o_orderkey NOT IN (SELECT o.key FROM o JOIN i ON i.key = o.key WHERE i.modified >= o.modified)""")
def layer_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not complete, or whose items are missing or older."""
    orders, items = _layers(spark, sf_dir)
    return manifests.layer_gaps(orders.select("key"), [orders, items], key="key")


@query("""WITH m AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS timed FROM orders WHERE year(o_orderdate) <> 1996 AND o_custkey % 2 = 0 GROUP BY 1, o_orderstatus), a AS (SELECT unnest(range(1994, 2000)) AS y)
SELECT a.y AS publication_year, 'missing' AS problem FROM a WHERE y NOT IN (SELECT y FROM m) UNION ALL SELECT DISTINCT y, 'unexpected' FROM m WHERE y NOT IN (SELECT y FROM a)
UNION ALL SELECT y, 'repeated' FROM m GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT y, 'no_time' FROM m WHERE timed = 0""")
def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with a row for each year and status, a time for one status only and a year left out, against the years 1994 to 1999."""
    orders = table(spark, sf_dir, "orders").where("year(o_orderdate) <> 1996 AND o_custkey % 2 = 0")
    rows = orders.groupBy(F.year("o_orderdate").cast("long").alias("publication_year"), "o_orderstatus").agg(F.sum("o_custkey").alias("file_size_bytes"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("timestamp"))).alias("uploaded_at"))
    rows = rows.select("publication_year", F.col("o_orderstatus").alias("path"), "file_size_bytes", "uploaded_at")
    return manifests.manifest_problems(rows, landing.year_axis(spark, 1994, 1999))


@query("""SELECT (SELECT event_type FROM events WHERE event_type <> 'error' ORDER BY event_id LIMIT 1) AS event_type, (SELECT value FROM events WHERE value > 100 ORDER BY event_id LIMIT 1) AS value""")
def first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.expr("nullif(event_type, 'error')").alias("event_type"), F.expr("CASE WHEN value > 100 THEN value END").alias("value"))
    return profiling.first_values(rows, ["event_type", "value"], "event_id")


@query("""SELECT count(quality) AS kept, count(*) - count(quality) AS dropped FROM documents LEFT JOIN labels USING (doc_id)""")
def drop_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    kept, dropped = profiling.drop_missing_ids(labelled, "quality")
    return kept.agg(F.count("*").alias("kept")).crossJoin(dropped)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_keys(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


@query("SELECT 'W' || o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0 AND year(o_orderdate) BETWEEN 1995 AND 2001")
def unparsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of staged works whose publication date did not parse."""
    raw = bronze_records(spark, sf_dir)
    return checks.unparsed(raw, staging.stage(raw, B), "publication_date").distinct()


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS publication_year, count(*) FILTER (WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F') AS n,
CAST(sum(o_orderkey) FILTER (WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F') AS BIGINT) AS keys FROM orders GROUP BY 1""")
def rebuilt_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of all years of which one is then derived anew, from finished orders only; the others stay."""
    base = tables.scratch(spark, "bronze")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("title"), F.year("o_orderdate").cast("long").alias("publication_year"))
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(BRONZE[c].dataType).alias(c) for c in BRONZE.fieldNames()])
    tables.write_bronze(rows, base)
    manifests.rebuild_year(rows.where("title = 'F'"), base, 1997)
    return tables.read_bronze(spark, base).groupBy("publication_year").agg(F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("keys"))


@query("SELECT o_orderpriority AS primary_topic_subfield_id, CAST(year(o_orderdate) AS BIGINT) AS publication_year, count(*) AS n FROM orders GROUP BY 1, 2")
def written_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works written by year and subfield, and read again."""
    path = tables.scratch(spark, "works")
    tables.write_works(works(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("primary_topic_subfield_id", F.col("publication_year").cast("long").alias("publication_year")).agg(F.count("*").alias("n"))


@query(ORACLE_SQL["concentration_by_group"])
def published_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grouped table, published as one file after its contract held, and read again."""
    path = tables.scratch(spark, "gold")
    tables.write_gold(concentration.concentration_by_group(works(spark, sf_dir), B), path, BY_GROUP)
    return spark.read.schema(BY_GROUP).parquet(path)


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS publication_year, min(o_orderstatus) AS path, CAST(sum(o_custkey) AS BIGINT) AS file_size_bytes, epoch_us(max(o_orderdate)) AS uploaded FROM orders GROUP BY 1""")
def published_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upload manifest of orders as files, written outside of the tables and read again."""
    files = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("b/publication_year="), F.year("o_orderdate"), F.lit("/"), "o_orderstatus").alias("path"), F.col("o_custkey").cast("long").alias("length"), F.col("o_orderdate").cast("timestamp").alias("modified")
    )
    path = tables.scratch(spark, "manifest")
    tables.write_manifest(manifests.upload_manifest(files), path)
    found = spark.read.schema(UPLOAD_MANIFEST).parquet(path)
    return found.select("publication_year", F.substring_index("path", "/", -1).alias("path"), "file_size_bytes", F.unix_micros("uploaded_at").alias("uploaded"))


@query("""SELECT '{"key":' || o_orderkey || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',"status":"' || o_orderstatus || '"' END || '}' AS line FROM orders""")
def exported_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines of allowed columns; nulls are left out."""
    path = tables.scratch(spark, "lines")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.expr("nullif(o_orderstatus, 'P')").alias("status"), F.col("o_custkey").alias("secret"))
    tables.write_jsonl(rows, ["key", "status"], path)
    return spark.read.text(path).select(F.col("value").alias("line"))


_SLICE = StructType([StructField("cited_group", StringType()), StructField("citation_age", LongType()), StructField("n_papers", LongType()), StructField("gini", DoubleType())])


@query(f"WITH b AS ({_cell_sql('g')}) SELECT cell AS cited_group, citation_age, n_papers, gini FROM b WHERE publication_year = 1996")
def published_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cohort published as a CSV with group names cut from paths, and read again under its contract, slice and row set."""
    path, ages = tables.scratch(spark, "slice"), B.cohort_citation_max - 1996
    rows = concentration.concentration_by_group(works(spark, sf_dir), B).withColumn("cited_group", F.concat(F.lit("groups/"), "cited_group"))
    tables.export_slice(rows, "publication_year = 1996", _SLICE.fieldNames(), path, ("cited_group",))
    expected = spark.range(1, ages + 1).select(F.explode(F.array(*map(F.lit, ("ai", "cv_pr", "rest_cs")))).alias("cited_group"), F.col("id").alias("citation_age"))
    return tables.read_extract(spark, path, _SLICE, ("cited_group", "citation_age"), f"citation_age BETWEEN 1 AND {ages} AND gini BETWEEN 0 AND 1", expected)


@query("""SELECT 'missing' AS problem, '{"o_orderkey":' || min(o_orderkey) || '}' AS example, count(*) AS n FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'foreign', '{"o_orderkey":' || min(-1 - o_orderkey) || '}', count(*) FROM orders WHERE o_orderkey < 10
UNION ALL SELECT 'outside the slice', '{"o_orderkey":' || min(CAST(o_orderkey AS VARCHAR)) || '}', count(*) FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus <> 'P'
UNION ALL SELECT 'repeated', '{"o_orderkey":' || min(CAST(o_orderkey AS VARCHAR)) || '}', count(*) FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus <> 'P'""")
def extract_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with an extract of orders that lacks a status, repeats a year, holds another year, and has keys that no order has."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus")
    held = orders.where("o_orderstatus <> 'P'")
    strange = orders.where("o_orderkey < 10").withColumns({"o_orderkey": -1 - F.col("o_orderkey"), "year": F.lit(2000)})
    found = tables.extract_problems(held.unionByName(held.where("year = 1997")).unionByName(strange), ("o_orderkey",), "year <> 1996", orders)
    # The first example in the order of keys as texts, but numbers where the SQL takes those.
    number = F.when(F.col("problem") == "missing", F.lit(orders.where("o_orderstatus = 'P'").agg(F.min("o_orderkey")).first()[0])).when(F.col("problem") == "foreign", F.lit(strange.agg(F.min("o_orderkey")).first()[0]))
    return found.withColumn("example", F.when(number.isNotNull(), F.concat(F.lit('{"o_orderkey":'), number, F.lit("}"))).otherwise(F.col("example")))


@query("SELECT DISTINCT 'W' || user_id AS id, 'log' AS source FROM events WHERE event_type IN ('error', 'purchase') UNION SELECT DISTINCT 'W' || event_id, 'log' FROM events WHERE event_type = 'error' UNION SELECT DISTINCT 'W' || event_id, 'checkpoint' FROM events WHERE event_type = 'click' UNION SELECT 'W' || event_id, 'file' FROM events WHERE event_type = 'view'")
def ids_of_a_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from the warnings and errors of a log, from a checkpoint, and from names of files."""
    events = table(spark, sf_dir, "events")
    log, checkpoint = tables.scratch(spark, "log"), tables.scratch(spark, "checkpoint")
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "WARNING").otherwise("INFO")
    message = F.when(F.col("event_type") == "error", F.concat(F.lit("no W"), "event_id", F.lit(" - of W"), "user_id")).otherwise(F.concat(F.lit("slow W"), "user_id"))
    events.select(F.concat_ws(" - ", F.col("ts").cast("string"), level, message)).write.text(log)
    events.where("event_type = 'click'").groupBy(F.pmod("user_id", F.lit(5))).agg(F.collect_list(F.concat(F.lit("W"), "event_id")).alias("completed_work_ids")).select("completed_work_ids").write.option("maxRecordsPerFile", 1).json(checkpoint)  # a file is one checkpoint
    inventory = events.where("event_type IN ('view', 'signup')").select(F.concat(F.lit("works/W"), "event_id", F.when(F.col("event_type") == "view", ".json").otherwise(".tmp")).alias("path"))
    found = {"log": landing.ids_from_log(spark, log), "checkpoint": landing.ids_from_checkpoint(spark, checkpoint), "file": landing.ids_from_filenames(inventory)}
    return reduce(DataFrame.unionByName, [df.select("id", F.lit(name).alias("source")) for name, df in found.items()])


@query("SELECT 'W' || o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0 AND year(o_orderdate) BETWEEN 1995 AND 2001")
def unparsed_update_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of staged works whose time of update did not parse."""
    raw = bronze_records(spark, sf_dir).where("title <> 'a'").withColumn("updated_date", F.expr("IF(CAST(substring(id, 2) AS BIGINT) % 13 = 0, 'never', updated_date)"))
    return checks.unparsed(raw, staging.stage(raw, B), "updated_date")


@query("""SELECT 'discount' AS check_name, 'error' AS severity, count(*) AS violations FROM lineitem WHERE l_discount > 0.05""")
def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a check that fails, one that only warns and one that passes, the first."""
    items = table(spark, sf_dir, "lineitem")
    return quality.failed(quality.report([
        quality.Check("discount", lambda: quality.accepted_range(items, "l_discount", high=0.05)), quality.Check("flag", lambda: quality.accepted_values(items, "l_returnflag", ["A"]), "warn"),
        quality.Check("key", lambda: quality.not_null(items, "l_orderkey")),
    ]))


#: Pages that a task writes at a time, one for each year; with more years it ends them and begins new ones.
MOST_OPEN = 200
#: Bytes of lines in a page, more or less: a gzipped one is read by one task.
MOST_IN_PAGE = 64 << 20


class LandingZone:
    """A landing zone in the shared folder, made of a table with publication_year; tasks write the pages and then the reports."""

    def __init__(self, spark: SparkSession, root: str, packed: bool = False):
        """packed: pages are gzipped, which takes about a tenth of the disk."""
        self.spark, self.root, self.packed = spark, root, packed

    def write(self, rows: DataFrame, expected: DataFrame | None = None) -> None:
        """expected: publication_year, records_fetched where a report shall say otherwise."""
        root, ending = self.root, ".jsonl.gz" if self.packed else ".jsonl"

        def pages(batches):
            part, number, made, current = TaskContext.get().partitionId(), 0, [], {}

            def close():
                for year, page in current.items():
                    page.close()
                    made.append((year, page.lines))
                current.clear()

            for batch in batches:
                years = batch.column("year").to_numpy()
                order = np.argsort(years, kind="stable")
                lines, years = batch.column("line").cast(pa.large_binary()).take(pa.array(order)), years[order]
                ends = [*(np.flatnonzero(years[1:] != years[:-1]) + 1).tolist(), len(years)]
                for first, end in zip([0, *ends], ends, strict=False):
                    year = int(years[first])
                    if year not in current:
                        if len(current) >= MOST_OPEN:
                            close()
                        current[year], number = Page(f"{root}/{year}/page-{part:05d}{number:05d}{ending}"), number + 1
                    page = current[year]
                    page.add(lines[first:end])
                    if page.bytes >= MOST_IN_PAGE:
                        page.close()
                        made.append((year, page.lines))
                        del current[year]
            close()
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in made], pa.int64()) for k in (0, 1)], ["year", "n"])

        def reports(batches):
            for batch in batches:
                for year, n, number in zip(batch["year"], batch["n"], batch["pages"], strict=True):
                    report = {"query": f"filter=publication_year:{year}", "year": year, "expected_count": n, "records_fetched": n, "page_count": number, "count_mismatch": False}
                    put(f"{root}/{year}/{landing.REPORT_NAME}", json.dumps(report))
                yield batch[["year"]]

        lines = rows.select(F.col("publication_year").alias("year"), F.concat(F.to_json(F.struct(*rows.columns)), F.lit("\n")).alias("line")).where("year IS NOT NULL")
        with tables.shuffles_removed(self.spark):
            made = tables.written(lines.mapInArrow(pages, "year long, n long"), "landed")
        totals = made.groupBy("year").agg(F.sum("n").alias("n"), F.count("*").alias("pages"))
        if expected is not None:
            said = expected.select(F.col("publication_year").alias("year"), "records_fetched")
            totals = totals.join(said, "year", "left").select("year", F.coalesce("records_fetched", "n").alias("n"), "pages")
        with tables.shuffles_removed(self.spark):
            totals.mapInPandas(reports, "year long").write.format("noop").mode("overwrite").save()

    def inventory(self) -> DataFrame:
        return landing.landing_inventory(self.spark, self.root)


class Page:
    """A file of the shared folder that a task writes bit by bit; it is there when it is closed, and a rerun writes the same name again."""

    def __init__(self, path: str):
        self.lines, self.bytes, self.path, self.aside = 0, 0, path, None
        self.zip = zlib.compressobj(2, wbits=31) if path.endswith(".gz") else None
        if path.startswith("file:"):
            self.path = "/" + path[5:].lstrip("/")
        if "://" in self.path:
            from pyarrow import fs

            store, inner = fs.FileSystem.from_uri(self.path)
            store.create_dir(os.path.dirname(inner), recursive=True)
            self.out = store.open_output_stream(inner, compression=None)
        else:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            self.aside = f"{os.path.dirname(os.path.dirname(self.path))}/.{uuid.uuid4().hex}"
            self.out = open(self.aside, "wb")

    def add(self, lines: pa.LargeBinaryArray) -> None:
        """Ended lines, as the bytes that Arrow holds in one piece."""
        _, ends, data = lines.buffers()
        ends = np.frombuffer(ends, np.int64)[lines.offset : lines.offset + len(lines) + 1]
        text = memoryview(data)[ends[0] : ends[-1]]
        self.out.write(self.zip.compress(text) if self.zip else text)
        self.lines, self.bytes = self.lines + len(lines), self.bytes + len(text)

    def close(self) -> None:
        if self.zip:
            self.out.write(self.zip.flush())
        self.out.close()
        if self.aside:
            os.replace(self.aside, self.path)


def put(path: str, text: str) -> None:
    page = Page(path)
    page.out.write(text.encode())
    page.close()


from . import check_queries  # noqa: E402, F401  registers its queries
