"""Schemas, each declared once. The names and types of records are fixed values of the public format they have."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

TEXT, LONG, DOUBLE, FLAG, DATE, TIME = StringType(), LongType(), DoubleType(), BooleanType(), DateType(), TimestampType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Records as they land; nested columns stay JSON text.
JSON_COLUMNS = ("primary_topic", "topics", "counts_by_year", "cited_by_percentile_year", "citation_normalized_percentile", "open_access", "ids", "keywords")
BRONZE = struct(
    id=TEXT, title=TEXT, publication_year=LONG, publication_date=TEXT, type=TEXT, language=TEXT, is_retracted=FLAG, is_paratext=FLAG, primary_topic=TEXT, topics=TEXT, cited_by_count=LONG,
    counts_by_year=TEXT, cited_by_percentile_year=TEXT, citation_normalized_percentile=TEXT, fwci=DOUBLE, referenced_works_count=LONG, open_access=TEXT, doi=TEXT, ids=TEXT, keywords=TEXT, updated_date=TEXT,
)
REPORT = struct(query=TEXT, year=LONG, started_at=TEXT, completed_at=TEXT, expected_count=LONG, records_fetched=LONG, page_count=LONG, count_mismatch=FLAG)
BRONZE_MANIFEST = struct(
    publication_year=LONG, status=TEXT, query=TEXT, expected_count=LONG, records_fetched=LONG, count_mismatch=FLAG, extraction_completed_at=TEXT, bronze_row_count=LONG, duplicate_id_count=LONG,
    bronze_file_path=TEXT, ingested_at=TIME,
)
UPLOAD_MANIFEST = struct(publication_year=LONG, path=TEXT, file_size_bytes=LONG, uploaded_at=TIME)
WORKS = struct(
    id=TEXT, publication_year=LONG, publication_date=DATE, primary_topic_id=TEXT, primary_topic_display_name=TEXT, primary_topic_subfield_id=TEXT, primary_topic_subfield_display_name=TEXT,
    is_ai_strict=FLAG, is_ai_broad=FLAG, cited_by_count=LONG, fwci=DOUBLE, counts_by_year=ArrayType(struct(year=LONG, cited_by_count=LONG)),
)
SHARE = struct(publication_year=LONG, variant=TEXT, cs_works=LONG, ai_works=LONG, share=DOUBLE, is_partial_year=FLAG)
CITATION_AGE = struct(
    citation_year=LONG, cited_group=TEXT, citation_events=LONG, cited_works=LONG, p25_age=LONG, median_age=LONG, p75_age=LONG, share_within_2=DOUBLE, share_within_5=DOUBLE, share_within_10=DOUBLE
)
_CONCENTRATION = dict(
    citation_age=LONG, n_papers=LONG, total_citations=LONG, zero_share=DOUBLE, gini=DOUBLE, gini_cited_only=DOUBLE, top1_share=DOUBLE, top5_share=DOUBLE, top10_share=DOUBLE,
    age0_citation_share=DOUBLE, zero_share_including_age0=DOUBLE,
)
BY_SUBFIELD = struct(publication_year=LONG, subfield_id=TEXT, subfield_display_name=TEXT, is_ai_strict=FLAG, is_ai_broad=FLAG, **_CONCENTRATION)
BY_GROUP = struct(publication_year=LONG, cited_group=TEXT, **_CONCENTRATION)


def differences(found: StructType, wanted: StructType) -> list[str]:
    """What breaks a contract of names, order and types; empty if nothing does."""
    have, want = [(f.name, f.dataType.simpleString()) for f in found], [(f.name, f.dataType.simpleString()) for f in wanted]
    return [f"column {i}: {h} instead of {w}" for i, (h, w) in enumerate(zip(have, want, strict=False)) if h != w] + [f"missing {w}" for w in want[len(have) :]] + [f"extra {h}" for h in have[len(want) :]]
