"""Looks at a table before cleaning it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n): rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The distinct values in order."""
    return df.select(column).distinct().orderBy(column)


def describe_number(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample standard deviation, minimum and maximum of the values present."""
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("least"),
        F.max(column).alias("most"),
    )
