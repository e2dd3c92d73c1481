"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import token_files, warc
from .alignment import align
from .common import table
from .decontaminate import contamination
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .packing import pack
from .periodic_runs import digests, periodic_runs
from .quality_rules import judge
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .toxicity import THRESHOLD, fit, score
from .url_filter import by_rules, host_of, judge_urls, path_of

#: The vocabulary file of the queries on tokens.
VOCABULARY = "byte_bpe_50k.json"
#: The model file of the other side of alignments.
PIECES = "piece_bpe_32k.model"
#: Rows whose labels may be learned; the others are held out.
LEARNABLE = "pmod(crc32(cast(doc_id as string)), 3) <> 1"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents under the Jaccard join of 4-word shingles at 85 percent."""
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict, by rules and by the graph of hosts."""
    return judge_urls(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's word statistics, base and verdict of the cascade."""
    return judge(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by a model of the labels that may be learned."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"), F.expr(LEARNABLE))
    scored = documents.select("doc_id", (~F.expr(LEARNABLE)).alias("held_out"), score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words hit by passages of the benchmark, and near matches in twice the window."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near_span=26)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives it was written to."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 2048 tokens."""
    # No other operator shares these workers' memory, so they remember as many cuts as the writers of token files.
    return pack(table(spark, sf_dir, "documents"), vocabulary(), remembered=token_files.MOST_CUTS)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token files, read back from them."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract_text(table(spark, sf_dir, "pages"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens on both sides, groups and links, with what the corpus-wide counts of its pairs give."""
    return align(table(spark, sf_dir, "documents"), vocabulary(), vocabulary(PIECES))


def planted(doc_id: int, order: np.ndarray) -> np.ndarray:
    """The words of a document of which one in ten repeats a stretch up to its end, as the query's contract has it."""
    h, n = zlib.crc32(str(doc_id).encode()), len(order)
    if h % 10:
        return order
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(order < a, order, a + (order - a) % p)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of repeated words, with stretches planted in one of ten."""
    return digests(periodic_runs(table(spark, sf_dir, "documents"), planted))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes that strings of 200 bytes found elsewhere cover."""
    found = remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules alone say of every page; SQL can say it too."""
    rule, verdict = by_rules()
    rows = table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact matches of op5, without those near; SQL can say them too."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_near")


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_url_filters, op3_quality_rules, op4_toxicity, op5_benchmark_decontamination,
        op6_warc, op7_packing, op8_token_counts, op9_token_files, op10_html_extraction,
        op11_cross_tokenizer_alignment, op12_periodic_runs, op13_suffix_array_dedup, url_rules, benchmark_hits,
    )
}
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: DuckDB SQL. The Jaccard components, learned scores, packing, token ids, archives, extracted texts, alignments, runs of words and repeated bytes
#: are beyond it, or too slow on whole tables; they are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "url_rules": f"""WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS h, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
v AS (SELECT page_id, {_LOWER.format('h')} AS host, path FROM u), r(rule, rule_verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
f AS (SELECT v.page_id, v.host, v.path, r.rule, r.rule_verdict, length(r.rule) AS n FROM v JOIN r ON ends_with('.' || v.host, '.' || split_part(r.rule, '/', 1)) AND starts_with(v.path, substr(r.rule, strpos(r.rule, '/'))))
SELECT v.page_id, v.host, v.path, (SELECT arg_max(rule, n) FROM f WHERE f.page_id = v.page_id) AS rule, (SELECT arg_max(rule_verdict, n) FROM f WHERE f.page_id = v.page_id) AS rule_verdict FROM v""",
    "op3_quality_rules": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
g AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM d, unnest(range(1, greatest(1, len(w) - 1))) AS r(i)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g), p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM c, range(0, 3) AS o(k) WHERE n > 1 GROUP BY 1),
s AS (SELECT doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_dup_lines > len(string_split(t, chr(10))) OR word_chars < 3 * n_words OR word_chars > 10 * n_words
  OR (10 * len(list_distinct(w)) < n_words AND len(list_distinct(w)) < 2 * sqrt(n_words)) OR 2 * length(regexp_replace(t, '[^\\p{Lu}]+', '', 'g')) > word_chars OR 2 * length(regexp_replace(t, '[^\\p{L}]+', '', 'g')) < word_chars) AS kept FROM b""",
    "benchmark_hits": f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g, least(len(w), 13) AS n FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS r(i) WHERE len(w) > 0),
o AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM g) AS lengths, unnest(range(1, len(w) - n + 2)) AS r(i)),
h AS (SELECT o.doc_id, o.i, o.n, g.item_id FROM o JOIN g ON o.n = g.n AND o.g = g.g),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM h) AS x, unnest(range(0, x.n)) AS r(k) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
