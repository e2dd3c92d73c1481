"""Left join of points with the intervals that hold them, by equal keys and a range.

An equi-join on the keys alone would pair every point of a key with every interval
of it. Time is cut into buckets, whose width doubles from level to level; an
interval belongs to the level of its length and so meets two buckets there at
most. A point looks its bucket up once for every level that occurs. The join is one
on keys, level and bucket, and the exact range is checked again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_interval_join(points: DataFrame, intervals: DataFrame, id: str, keys: list[str], at: str, low: str, high: str, width: int = 1) -> DataFrame:
    """Columns of points, then those of intervals but the keys: a row for each interval of equal keys with low <= at <= high, and one with nulls for a point in none.

    `id` tells the points apart; at, low and high are whole numbers. Null keys, points
    and bounds match nothing, as do intervals that end before they begin.
    """
    own = [c for c in intervals.columns if c not in keys]
    span = F.col(high) - F.col(low)
    level = F.when(span < width, 0).otherwise(F.ceil(F.log2((span + 1) / width)).cast("int"))
    sized = intervals.where(F.col(high) >= F.col(low)).withColumn("_level", level)
    size = f"({width}L * shiftleft(1L, _level))"
    bucket = lambda c: F.expr(f"({c} - pmod({c}, {size})) div {size}")
    placed = sized.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(low), bucket(high)))))
    levels = sized.groupBy().agg(F.array_sort(F.collect_set("_level")).alias("_levels"))  # 64 at most
    probes = points.select(id, *keys, at).crossJoin(F.broadcast(levels)).withColumn("_level", F.explode("_levels")).drop("_levels")
    probes = probes.withColumn("_bucket", bucket(at))
    found = probes.join(placed, [*keys, "_level", "_bucket"]).where(F.col(at).between(F.col(low), F.col(high))).select(id, F.struct(*own).alias("_found"))
    return points.join(found, id, "left").select(*points.columns, *[F.col(f"_found.{c}").alias(c) for c in own])
