"""Two-dimensional densities of points per group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .skew import join_small


def density_histogram(
    df: DataFrame, group: str, *, lat: str = "latitude", lon: str = "longitude", cell_deg: float = 0.01
) -> DataFrame:
    """(group, gy, gx, n): points per square cell of ``cell_deg`` degrees."""
    return (
        df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(
            group,
            F.floor(F.col(lat) / cell_deg).alias("gy"),
            F.floor(F.col(lon) / cell_deg).alias("gx"),
        )
        .agg(F.count("*").alias("n"))
    )


def kernel_density(
    df: DataFrame,
    group: str,
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    grid: int = 32,
    cut: float = 3.0,
) -> DataFrame:
    """(group, gy, gx, lat, lon, density): Gaussian kernel density on a grid of nodes per group.

    Bandwidth per axis after Scott, sigma * n^(-1/6); nodes span the data and ``cut`` bandwidths
    beyond, both ends included; points count at their nearest node. The product kernel is applied
    one axis after the other, so the work after binning is groups * grid^3, whatever the number of
    points. Groups with fewer than two points, or with points on one line along an axis, have no
    bandwidth and yield no rows.
    """
    points = df.select(group, F.col(lat).alias("y"), F.col(lon).alias("x")).filter(
        "y IS NOT NULL AND x IS NOT NULL"
    )
    frame = (
        points.groupBy(group)
        .agg(
            F.count("*").alias("n"),
            *(f(c).alias(f"{s}_{c}") for c in "yx" for f, s in ((F.min, "lo"), (F.max, "hi"), (F.stddev_samp, "sd"))),
        )
        .filter("n > 1 AND sd_y > 0 AND sd_x > 0")
    )
    scott = F.pow(F.col("n").cast("double"), F.lit(-1 / 6))
    for c in "yx":
        frame = frame.withColumn(f"h_{c}", F.col(f"sd_{c}") * scott)
        frame = frame.withColumn(f"o_{c}", F.col(f"lo_{c}") - F.col(f"h_{c}") * cut)
        frame = frame.withColumn(
            f"s_{c}", (F.col(f"hi_{c}") - F.col(f"lo_{c}") + F.col(f"h_{c}") * (2 * cut)) / (grid - 1)
        )
    frame = frame.select(group, "n", "h_y", "o_y", "s_y", "h_x", "o_x", "s_x")

    def node(c: str) -> Column:
        return F.floor((F.col(c) - F.col(f"o_{c}")) / F.col(f"s_{c}") + 0.5)

    given = ["n", "h_y", "o_y", "s_y", "h_x", "o_x", "s_x"]
    bins = (
        join_small(points, frame, [group])
        .groupBy(group, *given, node("y").alias("by"), node("x").alias("bx"))
        .agg(F.count("*").cast("double").alias("w"))
    )
    nodes = F.sequence(F.lit(0), F.lit(grid - 1))

    def kernel(bin_col: str, node_col: str, c: str) -> Column:
        z = (F.col(node_col) - F.col(bin_col)) * F.col(f"s_{c}") / F.col(f"h_{c}")
        return F.exp(z * z * -0.5) / (F.col(f"h_{c}") * math.sqrt(2 * math.pi))

    along_x = (
        bins.withColumn("gx", F.explode(nodes))
        .groupBy(group, *given, "by", "gx")
        .agg(F.sum(F.col("w") * kernel("bx", "gx", "x")).alias("w"))
    )
    along_y = (
        along_x.withColumn("gy", F.explode(nodes))
        .groupBy(group, *given, "gx", "gy")
        .agg(F.sum(F.col("w") * kernel("by", "gy", "y")).alias("w"))
    )
    return along_y.select(
        group,
        "gy",
        "gx",
        (F.col("o_y") + F.col("gy") * F.col("s_y")).alias("lat"),
        (F.col("o_x") + F.col("gx") * F.col("s_x")).alias("lon"),
        (F.col("w") / F.col("n")).alias("density"),
    )
