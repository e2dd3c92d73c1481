"""Checks: each is a relation of violating rows, empty if the check passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named check; a failing one of severity warn does not fail the run."""

    name: str
    violations: Callable[[], DataFrame]
    severity: str = "error"


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list and how often; null passes."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside the inclusive range; null passes."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(bad)


def expression_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; a null passes."""
    return df.where(f"NOT ({expression})")


def missing_keys(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(found, keys, "left_anti")


def key_difference(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    mark = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    both = mark(expected, "_expected").join(mark(found, "_found"), keys, "full")
    return both.where("_expected IS NULL OR _found IS NULL").select(*keys, F.when(F.col("_found").isNull(), "missing").otherwise("unexpected").alias("problem"))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], tolerance: float = 0.0) -> DataFrame:
    """Keys whose values differ between two relations, or that only one has; nulls are equal to nulls."""
    a = left.select(*keys, *[F.col(v).alias(f"left_{v}") for v in values], F.lit(True).alias("_left"))
    b = right.select(*keys, *[F.col(v).alias(f"right_{v}") for v in values], F.lit(True).alias("_right"))

    def differ(v: str):
        x, y = F.col(f"left_{v}"), F.col(f"right_{v}")
        return ~x.eqNullSafe(y) if not tolerance else ~F.coalesce(F.abs(x - y) <= tolerance, x.isNull() & y.isNull())

    apart = reduce(lambda p, q: p | q, map(differ, values))
    return a.join(b, keys, "full").where(apart | F.col("_left").isNull() | F.col("_right").isNull()).drop("_left", "_right")


def report(checks: list[Check]) -> DataFrame:
    """check_name, severity, violations of every check in one job."""
    return reduce(DataFrame.unionByName, [c.violations().agg(F.count("*").alias("violations")).select(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "violations") for c in checks])


def failed(found: DataFrame) -> DataFrame:
    return found.where("severity = 'error' AND violations > 0")
