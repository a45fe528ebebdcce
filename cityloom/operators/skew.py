"""Equi-joins that split hot keys, and joins with a table of one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, MapType, VariantType

from ..session import materialise, materialise_counted

# Rows of one key that one task takes of a side. Where both sides are counted the limit is that for
# pairs, as a task then compares up to its square.
TASK_ROWS = 1_000_000
TASK_SIDE = 15_000
# Most keys that are treated as hot; beyond that the limit rises with the data. Bounds the broadcast.
MAX_HOT_KEYS = 50_000
# Up to so many rows, as counted, a table of one row per key is broadcast.
SMALL_ROWS = 100_000


def _limit(total: Column | int, side: int) -> Column:
    total = F.lit(total) if isinstance(total, int) else F.coalesce(total, F.lit(0))
    return F.greatest(F.lit(float(side)), total / MAX_HOT_KEYS)


def hot_keys(
    counts: DataFrame, keys: Sequence[str], build_counts: DataFrame | None = None, total: int | None = None
) -> DataFrame:
    """Into how many parts to cut each hot key: ``__parts`` of the probe side, ``__build_parts`` of the other.

    ``counts`` and ``build_counts`` have the keys and their number of rows, ``__rows``. Without the second,
    the other side has few rows per key, and a key is hot above ``TASK_ROWS`` rows. With it, a key is hot if
    comparing all its rows would be more work than ``TASK_SIDE`` squared, or if either side has more than
    ``TASK_ROWS``; both sides are then cut into parts of about ``TASK_SIDE``. The limits rise for more than
    ``MAX_HOT_KEYS`` such keys, whatever the size of the data; ``total`` is the number of rows of both sides, if
    it is known, and is counted otherwise.
    """
    if build_counts is None:
        total = counts.agg(F.sum("__rows")).scalar() if total is None else total
        limited = counts.withColumn("__limit", _limit(total, TASK_ROWS))
        hot = limited.filter(F.col("__rows") > F.col("__limit"))
        return hot.select(
            *keys, F.ceil(F.col("__rows") / F.col("__limit")).cast("int").alias("__parts"), F.lit(1).alias("__build_parts")
        )
    both = counts.join(build_counts.withColumnRenamed("__rows", "__others"), list(keys))
    most = F.greatest("__rows", "__others")
    total = both.agg(F.sum(most)).scalar() if total is None else total
    limited = both.withColumn("__limit", _limit(total, TASK_SIDE))
    heavy = (F.col("__rows") * F.col("__others") > F.col("__limit") * F.col("__limit")) | (most > TASK_ROWS)
    hot = limited.filter((most > F.col("__limit")) & heavy)
    return hot.select(
        *keys,
        F.ceil(F.col("__rows") / F.col("__limit")).cast("int").alias("__parts"),
        F.ceil(F.col("__others") / F.col("__limit")).cast("int").alias("__build_parts"),
    )


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return True
    inner = [f.dataType for f in kind.fields] if hasattr(kind, "fields") else [getattr(kind, "elementType", None)]
    return any(_holds_map(k) for k in inner if k is not None)


def _salt(df: DataFrame, parts: Column) -> Column:
    """A part for each row, the same whenever a task is run again: by what the row holds (maps can't be
    hashed and are left out) and by the partition it lies in, so that equal rows are spread too."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType) and not f.name.startswith("__parts")]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), parts).cast("int")


def salted_join(
    probe: DataFrame,
    build: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    counts: DataFrame | None = None,
    build_counts: DataFrame | None = None,
    at_most: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Equi-join, inner or left, in which no task gets a whole hot key.

    Rows of a hot key are spread over parts and the matching rows of the other side repeated once per
    part; with ``build_counts`` (inner joins only) both sides are spread. All other keys join as
    usual. Nothing is dropped: every pair of rows meets in one part.

    The probe's rows per key are counted first, unless ``counts`` has them (keys and ``__rows``) or it is
    known that no key has more than ``at_most`` rows and that is too few to be hot. ``total`` is the number of
    rows of both sides, if known.
    """
    if at_most is not None and at_most <= TASK_ROWS and build_counts is None:
        return probe.join(build, list(keys), how)
    if counts is None:
        counts = probe.groupBy(*keys).agg(F.count("*").alias("__rows"))
    if build_counts is not None and how != "inner":
        raise ValueError("both sides are spread for inner joins only")
    spread, repeated, on = salted_sides(probe, build, keys, counts, build_counts, total)
    return spread.join(repeated, on, how).drop("__salt", "__other")


def salted_sides(
    probe: DataFrame,
    build: DataFrame,
    keys: Sequence[str],
    counts: DataFrame,
    build_counts: DataFrame | None = None,
    total: int | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a salted join with their parts, and the columns to join them on."""
    hot = F.broadcast(hot_keys(counts, keys, build_counts, total))  # at most 2 * MAX_HOT_KEYS rows
    parts = F.coalesce("__parts", F.lit(1))
    others = F.coalesce("__build_parts", F.lit(1))
    spread = probe.join(hot, list(keys), "left")
    spread = spread.withColumn("__salt", _salt(probe, parts))
    repeated = build.join(hot, list(keys), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    on = [*keys, "__salt"]
    if build_counts is not None:
        spread = spread.withColumn("__other", F.explode(F.sequence(F.lit(0), others - 1)))
        repeated = repeated.withColumn("__other", _salt(build, others))
        on.append("__other")
    extra = ["__parts", "__build_parts"]
    return spread.drop(*extra), repeated.drop(*extra), on


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe inner join with a table that has one row per key: ``df``'s columns, then the others of
    ``small``.

    One equi-join on the keys as they are, so that nulls match nulls, NaN matches NaN and both zeros are one
    key. Spark broadcasts the table if it is small enough by its own measure; else hot keys of
    ``df`` are left to the splitting of skewed partitions, to which the rows of one key can all go.
    """
    extra = [c for c in small.columns if c not in keys]
    small = small.select(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)), *extra)
    same: Column = F.lit(True)
    for i, key in enumerate(keys):
        same = same & df[key].eqNullSafe(small[f"__key{i}"])
    return df.join(small, same).select(*(df[c] for c in df.columns), *(small[c] for c in extra))


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], *, counts: DataFrame | None = None) -> DataFrame:
    """Null-safe left join of every row of ``df`` with ``table``, which has one row per key: ``df``'s columns, then the
    others of ``table`` (null where it lacks the key).

    Keys take the type both sides share, so that an integer meets its decimal; nulls match nulls, NaN matches NaN, both
    zeros are one key. The table is written and counted: up to ``SMALL_ROWS`` rows it is broadcast, beyond that rows of
    hot keys are spread over parts and their row of the table is repeated once per part. ``counts`` (keys and ``__rows``)
    has the rows of ``df`` per key, and is counted if it is not given.
    """
    extra = [c for c in table.columns if c not in keys]
    if clash := set(extra) & set(df.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    table, n = materialise_counted(table, "attach")

    def normal(of: DataFrame) -> DataFrame:
        """The keys, in the common type, under names of their own."""
        types = [df.select(F.col(f"`{k}`")).unionByName(table.select(F.col(f"`{k}`"))).schema[0].dataType for k in keys]
        plain = []
        for k, kind in zip(keys, types, strict=True):
            c = F.col(f"`{k}`").cast(kind)
            plain.append(c + F.lit(0.0).cast(kind) if isinstance(kind, (FloatType, DoubleType)) else c)
        return of.withColumns({f"__key{i}": c for i, c in enumerate(plain)})

    names = [f"__key{i}" for i in range(len(keys))]

    def same(a: DataFrame, b: DataFrame, also: Sequence[str] = ()) -> Column:
        pairs = [a[c].eqNullSafe(b[c]) for c in names] + [a[c] == b[c] for c in also]
        return reduce(and_, pairs, F.lit(True))

    left, right = normal(df), normal(table).select(*names, *(F.col(f"`{c}`") for c in extra))
    kept = [left[f"`{c}`"] for c in df.columns]
    if n <= SMALL_ROWS:
        right = F.broadcast(right)
        return left.join(right, same(left, right), "left").select(*kept, *(right[f"`{c}`"] for c in extra))
    counts = normal(counts if counts is not None else df.groupBy(*keys).agg(F.count("*").alias("__rows"))).select(*names, "__rows")
    hot = hot_keys(counts, names).select(*(F.col(c).alias(f"__hot{c}") for c in names), "__parts")
    hot = F.broadcast(hot)  # at most MAX_HOT_KEYS rows

    def with_parts(of: DataFrame) -> DataFrame:
        is_hot = reduce(and_, [of[c].eqNullSafe(hot[f"__hot{c}"]) for c in names], F.lit(True))
        return of.join(hot, is_hot, "left").drop(*(f"__hot{c}" for c in names))

    parts = F.coalesce("__parts", F.lit(1))
    spread = with_parts(left).withColumn("__salt", _salt(left, parts)).drop("__parts")
    repeated = with_parts(right).withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return spread.join(repeated, same(spread, repeated, ["__salt"]), "left").select(
        *(spread[f"`{c}`"] for c in df.columns), *(repeated[f"`{c}`"] for c in extra)
    )


def attach_group_counts(
    df: DataFrame, keys: Sequence[str], name: str = "count", *, counts: DataFrame | None = None
) -> DataFrame:
    """Add to every row the number of rows that share its keys, from pre-aggregated counts. ``df`` is read twice: give a
    written one; or the ``counts`` (keys and ``name``), where ``df`` is a part of the rows that were counted."""
    if counts is not None:
        return attach(df, counts, keys)
    counts = materialise(df.groupBy(*keys).agg(F.count("*").alias(name)), "group-counts")
    return attach(df, counts, keys, counts=counts.withColumnRenamed(name, "__rows"))
