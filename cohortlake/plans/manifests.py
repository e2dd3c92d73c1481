"""Manifests of the layers, and what they say about the work left."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_MANIFEST, UPLOAD_MANIFEST, differences
from ..sources import landing, tables


#: Bytes of pages, as they are stored, whose records are shuffled at a time.
MOST_AT_ONCE = 512 << 20


class IntegrityError(ValueError):
    """Records and their report, or their ids, do not agree."""


def ingest(spark: SparkSession, root: str, base: str, states: DataFrame) -> int:
    """Write all READY years to bronze, and a file without rows for each EMPTY one.

    Null ids and counts that differ from the reports stop it before anything is written.
    """
    found = states.where("bronze IN ('READY', 'EMPTY')").select("publication_year", "bronze", "bytes").collect()  # one row for each year
    ready, empty = (sorted((y, size) for y, state, size in found if state == wanted) for wanted in ("READY", "EMPTY"))
    empty = [y for y, _ in empty]
    if not found:
        return 0
    reports = landing.read_reports(spark, root).select("year", "records_fetched")
    bad = reports.where(F.col("year").isin(empty) & ~F.col("records_fetched").eqNullSafe(F.lit(0))).limit(10).collect()
    if bad:
        raise IntegrityError(f"years {sorted(r['year'] for r in bad)}: no records, though the report says otherwise")
    if ready:
        _ingest_ready(spark, root, base, ready, reports)
    for year in empty:
        tables.write_empty_year(spark, base, year)
    return len(found)


def portions(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Years with their bytes as lists of at most so many bytes, in the order of the years; a larger year is a list of its own."""
    out, held = [], 0
    for year, size in sizes:
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(year)
        held += size
    return out


def _ingest_ready(spark: SparkSession, root: str, base: str, sizes: list[tuple[int, int]], reports: DataFrame) -> None:
    """Parse the pages once, into a staging place beside the years; what the writes counted on their way decides whether they are put in place.

    Years are written in portions, a job each, as a job's shuffle holds its records a second time.
    """
    ready = [y for y, _ in sizes]
    fetched = {r["year"]: r["records_fetched"] for r in reports.where(F.col("year").isin(ready)).collect()}  # one for each year
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1).cast("bigint")
    records = lambda years: landing.read_pages(spark, [f"{root}/{y}/{landing.PAGES}" for y in years]).withColumn("_folder", folder)
    staged = f"{base.rstrip('/')}-staged-{uuid.uuid4().hex}"
    try:
        strange = 0
        for years in portions(sizes, MOST_AT_ONCE):
            seen = Observation()
            counted = records(years).observe(seen, F.count_if(F.col("id").isNull()).alias("nulls"), F.count_if(~F.col("publication_year").eqNullSafe(F.col("_folder"))).alias("astray"))
            tables.write_bronze(counted, staged, "append")  # a record may belong to a year of another portion
            strange += seen.get["nulls"] + seen.get["astray"]
        if strange:
            counts = records(ready).groupBy("_folder").agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("nulls"))
        else:  # then what was written says it, without another look at the pages
            counts = tables.read_bronze(spark, staged).groupBy("publication_year").agg(F.count("*").alias("n"), F.lit(0).alias("nulls"))
        found = {y: (n, nulls) for y, n, nulls in counts.collect()}  # one row for each year
        bad = [y for y in ready if found.get(y, (0, 0)) != (fetched.get(y), 0)]
        if bad:
            raise IntegrityError(f"years {bad}: null ids, or not as many records as fetched")
        tables.swap_years(spark, staged, base)
        if not strange:
            for year in ready:
                if year not in found:  # its pages hold bytes, as gzipped ones do, but no records
                    tables.write_empty_year(spark, base, year)
    finally:
        tables.discard(spark, staged)


def bronze_manifest(states: DataFrame, reports: DataFrame, bronze: DataFrame, files: DataFrame) -> DataFrame:
    """A row for each year: state, report, rows, duplicate ids, path and time of its files."""
    counts = bronze.groupBy("publication_year").agg(F.count("*").alias("bronze_row_count"), (F.count("*") - F.countDistinct("id")).alias("duplicate_id_count"))
    year = F.regexp_extract("path", r"publication_year=(\d+)/", 1).try_cast("bigint")
    written = files.select(year.alias("publication_year"), F.regexp_extract("path", r"^(.*publication_year=\d+)/", 1).alias("folder"), "modified").where("publication_year IS NOT NULL")
    written = written.groupBy("publication_year").agg(F.max("folder").alias("bronze_file_path"), F.max("modified").alias("ingested_at"))
    own = reports.withColumnRenamed("year", "publication_year").withColumnRenamed("completed_at", "extraction_completed_at")
    rows = states.select("publication_year", F.col("bronze").alias("status")).join(own, "publication_year", "left").join(counts, "publication_year", "left").join(written, "publication_year", "left")
    counted = ("bronze_row_count", "duplicate_id_count")
    rows = rows.withColumns({c: F.when(F.col("status") == "INGESTED", F.coalesce(c, F.lit(0))).otherwise(F.col(c)) for c in counted})
    return rows.select(*BRONZE_MANIFEST.fieldNames())


def manifest_mismatches(manifest: DataFrame) -> DataFrame:
    """Ingested years whose rows are not those fetched."""
    return manifest.where("status = 'INGESTED' AND NOT (records_fetched <=> bronze_row_count)")


def upload_manifest(files: DataFrame) -> DataFrame:
    year = F.coalesce(F.regexp_extract("path", r"publication_year=(\d+)/", 1).try_cast("bigint"), F.regexp_extract("path", r"/(\d+)\.parquet$", 1).try_cast("bigint"))
    rows = files.select(year.alias("publication_year"), "path", F.col("length").alias("size"), "modified").where("publication_year IS NOT NULL")
    return rows.groupBy("publication_year").agg(F.min("path").alias("path"), F.sum("size").alias("file_size_bytes"), F.max("modified").alias("uploaded_at"))


def manifest_problems(manifest: DataFrame, years: DataFrame) -> DataFrame:
    """publication_year, problem: years that are missing, unexpected, repeated, or without a time; a broken schema is one row without a year."""
    if differences(manifest.schema, UPLOAD_MANIFEST):
        return years.sparkSession.createDataFrame([(None, "schema")], "publication_year BIGINT, problem STRING")
    held = manifest.select("publication_year").distinct()
    return (
        years.join(held, "publication_year", "left_anti").select("publication_year", F.lit("missing").alias("problem"))
        .union(held.join(years, "publication_year", "left_anti").select("publication_year", F.lit("unexpected")))
        .union(manifest.groupBy("publication_year").count().where("count > 1").select("publication_year", F.lit("repeated")))
        .union(manifest.where("uploaded_at IS NULL").select("publication_year", F.lit("no_time")))
    )


def stale_partitions(source: DataFrame, target: DataFrame, key: str = "publication_year", time: str = "modified") -> DataFrame:
    """Keys whose target is missing or older than the source; equal times are fresh."""
    to = target.select(key, F.col(time).alias("_time"))
    return source.join(to, key, "left").where(~F.coalesce(F.col("_time") >= F.col(time), F.lit(False))).select(key)


def layer_gaps(years: DataFrame, layers: list[DataFrame], key: str = "publication_year", time: str = "modified") -> DataFrame:
    """Years that are not complete in every layer, or less fresh in one than in the layer before; layers hold key, complete and a time."""
    rows, good = years.select(key), F.lit(True)
    for i, layer in enumerate(layers):
        rows = rows.join(layer.select(key, F.col("complete").alias(f"c{i}"), F.col(time).alias(f"t{i}")), key, "left")
        good = good & F.coalesce(f"c{i}", F.lit(False))
        if i:
            good = good & F.coalesce(F.col(f"t{i}") >= F.col(f"t{i - 1}"), F.lit(False))
    return rows.where(~good).select(key)


def rebuild_year(df: DataFrame, base: str, year: int) -> None:
    """Derive one year anew: a dynamic overwrite replaces it in one commit."""
    tables.write_bronze(df.where(F.col("publication_year") == year), base)
