"""Shares of categories within clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .contingency import contingency


def cluster_shares(
    df: DataFrame,
    cluster: str = "cluster",
    category: str = "category",
    *,
    complete: Sequence[str] | None = None,
) -> DataFrame:
    """(cluster, category, n, percent): the category's share of its cluster's rows.

    ``complete`` lists categories that get a zero row in clusters without them. The windows run over
    the aggregated cells, never over rows.
    """
    if complete is None:
        cells = df.groupBy(cluster, category).agg(F.count("*").alias("n"))
    else:
        cells = contingency(df, cluster, category, complete)
    return cells.withColumn("percent", F.col("n") / F.sum("n").over(Window.partitionBy(cluster)))


def scale_by_category(shares: DataFrame, category: str = "category", name: str = "scaled_percent") -> DataFrame:
    """Each share divided by the sum of its category's shares over all clusters."""
    return shares.withColumn(name, F.col("percent") / F.sum("percent").over(Window.partitionBy(category)))
