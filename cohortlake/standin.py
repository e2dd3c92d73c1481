"""The driver's tables in the shape of works: orders are works, shipped line items are their citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bounds import STANDIN, Bounds
from .operators.works import classify
from .schemas import BRONZE, WORKS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Line items of one partition: aggregations hold groups of one to four of them in memory.
ITEMS_PER_PARTITION = 1_000_000


def by_order(items: DataFrame, most: int = ITEMS_PER_PARTITION) -> DataFrame:
    """items dealt by order, into about `most` a partition if there are more than the cores take at once; fewer are left to the session."""
    parts = -(-items.count() // most)  # of Parquet the footers say it
    return items.repartition(parts, "l_orderkey") if parts > items.sparkSession.sparkContext.defaultParallelism else items.repartition("l_orderkey")


def counts_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """l_orderkey, counts_by_year, total: both aggregations and the later join use one partitioning by order."""
    items = by_order(table(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").cast("long").alias("year"), "l_quantity"))
    yearly = items.groupBy("l_orderkey", "year").agg(F.sum("l_quantity").cast("long").alias("cited_by_count"))
    return yearly.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("year", "cited_by_count"))).alias("counts_by_year"), F.sum("cited_by_count").alias("total"))


def works(spark: SparkSession, sf_dir: str, bounds: Bounds = STANDIN) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.join(counts_by_order(spark, sf_dir), orders["o_orderkey"] == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"), F.year("o_orderdate").cast("long").alias("publication_year"), F.to_date("o_orderdate").alias("publication_date"),
        F.col("o_orderstatus").alias("primary_topic_id"), F.col("o_orderstatus").alias("primary_topic_display_name"),
        F.col("o_orderpriority").alias("primary_topic_subfield_id"), F.substring("o_orderpriority", 3, 20).alias("primary_topic_subfield_display_name"),
        F.coalesce("total", F.lit(0)).alias("cited_by_count"),
        F.col("o_totalprice").alias("fwci"), F.coalesce("counts_by_year", F.array()).cast(WORKS["counts_by_year"].dataType).alias("counts_by_year"),
    )
    return classify(rows, bounds).select(*WORKS.fieldNames())


def bronze(spark: SparkSession, sf_dir: str, nested: tuple[str, ...] = ()) -> DataFrame:
    """Orders as landed records with JSON texts, some with bad values; every fifth order has an older version and every fifth one without a time.

    counts_by_year, open_access and ids are values instead of texts where nested names them.
    """
    orders, key, old = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("_old")
    text = lambda name, value: value if name in nested else F.to_json(value)
    time = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    before = F.when(key % 5 == 0, F.date_format(F.date_sub(F.to_date("o_orderdate"), 1), "yyyy-MM-dd'T'23:59:59.5"))
    topic = F.struct(
        F.col("o_orderstatus").alias("id"), F.col("o_orderstatus").alias("display_name"), (key % 4).cast("string").alias("score"),
        F.struct(F.col("o_orderpriority").alias("id"), F.substring("o_orderpriority", 3, 20).alias("display_name")).alias("subfield"), F.struct(F.lit("f").alias("id")).alias("field"),
    )
    keyword = F.struct(F.lit("k").alias("id"), F.col("o_orderpriority").alias("display_name"), F.lit("high").alias("score"))
    percentile = F.struct((F.col("o_totalprice") / 1000).alias("value"), (F.col("o_totalprice") > 250000).alias("is_in_top_1_percent"), F.lit("yes").alias("is_in_top_10_percent"))
    columns = {
        "id": F.concat(F.lit("W"), key), "title": F.when(old, "a").otherwise(F.concat(F.lit("order "), key)), "publication_year": F.year("o_orderdate").cast("long"),
        "publication_date": F.when(key % 7 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), "type": F.lit("article"), "language": F.lit("en"),
        "is_retracted": F.col("o_orderstatus") == "P", "is_paratext": F.when(key % 11 != 0, False), "primary_topic": F.to_json(topic), "topics": F.to_json(F.array_repeat(topic, (key % 3).cast("int"))),
        "cited_by_count": F.coalesce("total", F.lit(0)), "counts_by_year": F.when(~old, text("counts_by_year", F.col("counts_by_year"))),
        "cited_by_percentile_year": F.to_json(F.struct((key % 100).alias("min"), F.lit("n/a").alias("max"))), "citation_normalized_percentile": F.to_json(percentile),
        "fwci": F.col("o_totalprice"), "referenced_works_count": F.col("o_custkey"), "open_access": text("open_access", F.struct(F.when(key % 2 == 0, "TRUE").otherwise("1").alias("is_oa"), F.col("o_orderstatus").alias("oa_status"))),
        "doi": F.concat(F.lit("doi:"), key), "ids": text("ids", F.struct(F.concat(F.lit("doi:"), key).alias("doi"), key.alias("mag"))), "keywords": F.to_json(F.array_repeat(keyword, (key % 2).cast("int"))),
        "updated_date": F.when(old, before).otherwise(time),
    }
    rows = orders.join(counts_by_order(spark, sf_dir), key == F.col("l_orderkey"), "left")
    versions = F.when((key % 5).isin(0, 1), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("_old", F.explode(versions))  # after the join, so that line items are counted once for both
    return rows.select(*[columns[c].alias(c) for c in BRONZE.fieldNames()])
