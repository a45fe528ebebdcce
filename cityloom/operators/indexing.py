"""Row ids and reproducible splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise, materialise_counted


# Rows per range that ids are numbered in.
RANGE_ROWS = 500_000


def dense_id(df: DataFrame, key: str | Sequence[str], name: str, *, start: int = 0, parts: int | None = None) -> DataFrame:
    """Number rows densely from ``start`` in the order of a unique key of one or more columns of any
    type that can be ordered; nulls first.

    A global row number would sort everything in one task. Here the input is written and counted in one pass; the rows
    are then parted by ranges of the key, as many as their number asks for, sorted and written with their place in
    the range; ranges are offset by the rows before them. Bounds of ranges are sampled from what was written, and a
    table that fits one range needs none. Rows with equal keys come next to each other in no particular order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows, n = materialise_counted(df, "dense-id-rows")
    parts = parts or max(1, math.ceil(n / RANGE_ROWS))
    # The id of a row within its range counts up in the order of the rows.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    if parts == 1:
        return rows.coalesce(1).sortWithinPartitions(*keys).withColumn(name, place + F.lit(start).cast("bigint"))
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = materialise(ranged.withColumn("__range", F.spark_partition_id()).withColumn("__place", place), "dense-id")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__rows"))  # one row per range
    offsets = sizes.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    return (
        placed.join(F.broadcast(offsets), "__range")
        .withColumn(name, (F.col("__before") + F.col("__place") + start).cast("bigint"))
        .drop("__range", "__before", "__place")
    )


def stable_id(df: DataFrame, name: str) -> DataFrame:
    """A 64-bit id that depends on what a row holds and not on how the input was split: the upper bits of
    the row's MD5, and for rows that are equal in all columns, which nothing tells apart, a number counted up
    from it. Two different rows share an id by chance only: about one pair in a table of six billion rows.

    Equal rows are numbered on two levels: within the partition they lie in, and by the equal rows of the partitions
    before it, of which there is one count per partition. So a row repeated any number of times is no task of its own.
    """
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    digest = F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")
    rows = materialise(df.withColumns({"__digest": digest, "__part": F.spark_partition_id()}), "stable-id")
    earlier = Window.partitionBy("__digest").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__digest", "__part").agg(F.count("*").alias("__rows"))
    before = counts.withColumn("__before", F.sum("__rows").over(earlier)).filter("__before > 0").drop("__rows")
    within = Window.partitionBy("__digest", "__part").orderBy(F.lit(0))
    placed = rows.withColumn("__rank", F.row_number().over(within)).join(before, ["__digest", "__part"], "left")
    rank = F.coalesce("__before", F.lit(0)) + F.col("__rank")
    return placed.select(
        *(F.col(f"`{c}`") for c in df.columns),
        F.when(rank == 1, F.col("__digest")).otherwise(F.xxhash64("__digest", rank.cast("int"))).alias(name),
    )


def in_share(key: Column, share: float, seed: int = 0) -> Column:
    """Whether a key falls into a share of all keys; decided by its MD5, so it is the same in every
    run, for any partitioning, and in other engines."""
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(share * 2**32)


def hold_out(df: DataFrame, key: str, share: float = 0.75, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, split by key."""
    train = in_share(F.col(key), share, seed)
    return df.filter(train), df.filter(~train)


def accuracy(df: DataFrame, predicted: str, actual: str, *by: str) -> DataFrame:
    """(*by, n, accuracy): rows and the share whose prediction equals the actual label."""
    hit = F.coalesce(F.col(predicted) == F.col(actual), F.lit(False)).cast("double")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))
