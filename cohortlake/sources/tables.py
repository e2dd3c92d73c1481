"""Tables in Parquet, and the files published from them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BRONZE, differences


class ContractError(ValueError):
    """A table does not have the columns, order or types that were promised."""


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share; where none is set, a local session takes one of its machine and a cluster is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; they would stay until the driver collects garbage, beside those of the steps to come."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, held)


def read_bronze(spark: SparkSession, base: str) -> DataFrame:
    """The bronze table; the year comes from the path."""
    return spark.read.schema(BRONZE).parquet(base)


def by_size(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt by columns into partitions of the advisory size: small ones are joined, a large one is split, also one of a single value."""
    return df.hint("rebalance", *columns)


def write_bronze(df: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Replace the years in df and no others, or append to them; a year is there when its job is committed."""
    rows = by_size(df.select(*BRONZE.fieldNames()), "publication_year")
    with shuffles_removed(df.sparkSession):
        rows.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").mode(mode).partitionBy("publication_year").parquet(base)


def swap_years(spark: SparkSession, staged: str, base: str) -> None:
    """Move the years of a staged bronze table into base in place of those there; only folders are renamed."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(base))
    for status in files.globStatus(path(f"{staged}/publication_year=*")) or []:  # one for each year
        target = path(f"{base}/{status.getPath().getName()}")
        files.delete(target, True)
        if not files.rename(status.getPath(), target):
            raise OSError(f"{target} could not be put in place")


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_empty_year(spark: SparkSession, base: str, year: int) -> None:
    """A file without rows, so that the year is there and keeps the schema."""
    spark.createDataFrame([], BRONZE).drop("publication_year").write.mode("overwrite").parquet(f"{base}/publication_year={year}")


def write_works(df: DataFrame, path: str) -> None:
    """By year, sorted by subfield in each file, so that row groups can be skipped; files have the advisory size, whatever years and subfields weigh."""
    keys = ("publication_year", "primary_topic_subfield_id")
    by_size(df, *keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("publication_year").parquet(path)


def check_contract(df: DataFrame, contract: StructType) -> DataFrame:
    if found := differences(df.schema, contract):
        raise ContractError("; ".join(found))
    return df


def write_gold(df: DataFrame, path: str, contract: StructType) -> None:
    """A small aggregate as one file, after its contract held."""
    check_contract(df, contract).coalesce(1).write.mode("overwrite").parquet(path)


def write_manifest(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, columns: list[str], path: str) -> None:
    """Allowed columns only; nulls are left out."""
    df.select(*columns).write.option("ignoreNullFields", True).mode("overwrite").json(path)


def slice_of(df: DataFrame, predicate: str, columns: list[str], bare_ids: tuple[str, ...] = ()) -> DataFrame:
    """The rows and columns to publish, with ids cut to what follows their last slash."""
    return df.where(predicate).select(*[F.substring_index(c, "/", -1).alias(c) if c in bare_ids else F.col(c) for c in columns])


def export_slice(df: DataFrame, predicate: str, columns: list[str], path: str, bare_ids: tuple[str, ...] = ()) -> None:
    slice_of(df, predicate, columns, bare_ids).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_extract(spark: SparkSession, path: str, contract: StructType, keys: tuple[str, ...] = (), slice_of_rows: str = "TRUE", row_set: DataFrame | None = None) -> DataFrame:
    """A published CSV under its contract, validated before it is used.

    A header that differs or a value of another type fails the read. slice_of_rows has to hold for
    each row, keys may not repeat, and the keys have to be those of row_set, where given; what
    does not agree is named in the error.
    """
    found = spark.read.schema(contract).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    if problems := extract_problems(found, keys, slice_of_rows, row_set).limit(10).collect():
        raise ContractError("; ".join(f"{r['problem']}: {r['example']}" for r in problems))
    return found


def extract_problems(found: DataFrame, keys: tuple[str, ...], slice_of_rows: str, row_set: DataFrame | None = None) -> DataFrame:
    """problem, example, n: rows outside the slice, repeated keys, and keys that are missing from or foreign to the row set.

    The example is the row whose keys (without keys, all columns) come first as texts, one after the other: 12 is before 123.
    """
    shown = keys or found.columns
    text, order = F.to_json(F.struct(*shown)), F.struct(*[F.col(c).cast("string") for c in shown])
    said = lambda df, problem: df.groupBy(F.lit(problem).alias("problem")).agg(F.min_by(text, order).alias("example"), F.count("*").alias("n"))
    out = said(found.where(~F.coalesce(F.expr(slice_of_rows), F.lit(False))), "outside the slice")
    if keys:
        out = out.unionByName(said(found.groupBy(*keys).count().where("count > 1"), "repeated"))
    if row_set is not None:
        out = out.unionByName(said(row_set.select(*keys).join(found, list(keys), "left_anti"), "missing")).unionByName(said(found.select(*keys).join(row_set, list(keys), "left_anti"), "foreign"))
    return out
