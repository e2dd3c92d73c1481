"""Landing zones: JSONL pages, plain or gzipped, and reports in a folder for each year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.parsing import mask_first
from ..schemas import BRONZE, REPORT
from .folders import folder_files

REPORT_NAME, META_NAME, CURSOR_NAME = "_YEAR_REPORT.json", "_META.json", "_CURSOR.json"
PAGES = "page-*.{jsonl,jsonl.gz}"


def read_pages(spark: SparkSession, paths: list[str], schema: StructType = BRONZE) -> DataFrame:
    """Records under the imposed schema; nested values keep their text, a value that does not conform fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """value, folder, file: the lines of all pages as they landed, with the folder and the file of each."""
    path = F.col("_metadata.file_path")
    folder, file = F.substring_index(F.substring_index(path, "/", -2), "/", 1), F.substring_index(path, "/", -1)  # for every line, so no patterns
    return spark.read.text(f"{root}/*/{PAGES}").select("value", folder.alias("folder"), file.alias("file"))


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """The report of every shard; one that is no report fails the read."""
    found = folder_files(spark, root, (REPORT_NAME,)).where(F.col("name") == REPORT_NAME)
    return found.select(F.from_json("content", REPORT, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def landing_inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, name, folder, length, modified of every file in a folder below root; contents are not read."""
    return folder_files(spark, root).drop("content")


def discover_years(inventory: DataFrame) -> DataFrame:
    """publication_year of numeric folders and of numeric Parquet names; manifests and temporary files are neither."""
    stem = F.regexp_extract("name", r"^(\d+)\.parquet$", 1)
    year = F.when(F.col("folder").rlike(r"^\d+$"), F.col("folder")).otherwise(F.nullif(stem, F.lit("")))
    return inventory.select(year.try_cast("bigint").alias("publication_year")).where("publication_year is not null").distinct()


def ingested_years(inventory: DataFrame) -> DataFrame:
    """publication_year of every partition of bronze that holds a file, with rows or without."""
    year = F.regexp_extract("path", r"/publication_year=(\d+)/[^/]+\.parquet$", 1).try_cast("bigint")
    return inventory.select(year.alias("publication_year")).where("publication_year IS NOT NULL").distinct()


def year_axis(spark: SparkSession, low: int, high: int) -> DataFrame:
    """publication_year from low to high; empty if high is below low."""
    return spark.range(low, high + 1).select(F.col("id").alias("publication_year"))


def shard_states(inventory: DataFrame, years: DataFrame, ingested: DataFrame) -> DataFrame:
    """publication_year, landing, bronze, pages, bytes: the state of each year in its two layers, and how many pages of how many bytes it has.

    landing: COMPLETE (a report wins over other markers), IN_PROGRESS (markers or
    pages), FRESH. bronze: INGESTED, else READY, EMPTY (one page of no bytes) or
    CORRUPT (a report without pages, or a page of no bytes beside others) for a
    complete year, else PENDING.
    """
    page = F.col("name").rlike(r"^page-\d+\.jsonl(\.gz)?$")
    found = inventory.where(F.col("folder").rlike(r"^\d+$")).groupBy(F.col("folder").cast("bigint").alias("publication_year")).agg(
        F.bool_or(F.col("name") == REPORT_NAME).alias("report"), F.bool_or(F.col("name").isin(META_NAME, CURSOR_NAME)).alias("started"),
        F.count_if(page).alias("pages"), F.count_if(page & (F.col("length") == 0)).alias("blank"), F.sum(F.when(page, F.col("length"))).alias("bytes"),
    )
    rows = years.select("publication_year").join(found, "publication_year", "left").join(ingested.select("publication_year", F.lit(True).alias("done")).distinct(), "publication_year", "left")
    landing = F.when(F.col("report"), "COMPLETE").when(F.col("started") | (F.col("pages") > 0), "IN_PROGRESS").otherwise("FRESH")
    bronze = (
        F.when(F.col("done"), "INGESTED").when(~F.coalesce("report", F.lit(False)), "PENDING").when(F.col("pages") == 0, "CORRUPT")
        .when((F.col("pages") == 1) & (F.col("blank") == 1), "EMPTY").when(F.col("blank") > 0, "CORRUPT").otherwise("READY")
    )
    return rows.select("publication_year", landing.alias("landing"), bronze.alias("bronze"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("pages", "bytes")])


def query_homogeneity(reports: DataFrame, clause: str = "publication_year:{}") -> DataFrame:
    """masked, years: the queries of the shards without their year; more than one row means that they differ."""
    own = F.concat(F.lit(clause.split("{}")[0]), F.col("year").cast("string"), F.lit(clause.split("{}")[1]))
    return reports.groupBy(mask_first(F.col("query"), own).alias("masked")).agg(F.array_sort(F.collect_list("year")).alias("years"))


def count_drift(reports: DataFrame, lines: DataFrame | None = None, least: int = 100, share: float = 0.001) -> DataFrame:
    """year, expected_count, records_fetched, drift, differs, alarm (beyond the greater of the two limits)."""
    drift = F.col("records_fetched") - F.col("expected_count")
    rows = reports if lines is None else reports.drop("records_fetched").join(lines, "year", "left").fillna(0, ["records_fetched"])
    return rows.select("year", "expected_count", "records_fetched", drift.alias("drift"), (drift != 0).alias("differs"), (F.abs(drift) > F.greatest(F.lit(float(least)), F.col("expected_count") * share)).alias("alarm"))


def ids_from_log(spark: SparkSession, path: str, pattern: str = r"(W\d+)") -> DataFrame:
    """Distinct ids in WARNING and ERROR lines (time - LEVEL - text)."""
    parts = F.split("value", " - ", 3)
    lines = spark.read.text(path).select(F.get(parts, F.lit(1)).alias("level"), F.get(parts, F.lit(2)).alias("message")).where("trim(level) IN ('WARNING', 'ERROR')")
    return lines.select(F.explode(F.regexp_extract_all("message", F.lit(pattern))).alias("id")).distinct()


def ids_from_checkpoint(spark: SparkSession, path: str, key: str = "completed_work_ids") -> DataFrame:
    return spark.read.schema(f"`{key}` ARRAY<STRING>").option("multiLine", True).json(path).select(F.explode(key).alias("id")).distinct()


def ids_from_filenames(inventory: DataFrame, pattern: str = r"(W[^/]*)\.json$") -> DataFrame:
    return inventory.select(F.regexp_extract("path", pattern, 1).alias("id")).where("id <> ''").distinct()
