"""One row per key, chosen by an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key that is smallest by ``order`` (columns or expressions that can be ordered, nulls first); all
    columns are kept.

    Each task keeps one row per key before the shuffle, so a key with most of the rows is no burden. Null is a key
    like any other. Rows that are equal by ``order`` are told apart by a hash of all they hold, so the same row is
    kept however the input is split. Columns may be of any type, maps too; keys can't be maps.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    by = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    rank = F.struct(*(c.alias(f"by{i}") for i, c in enumerate([*by, whole])))
    chosen = df.groupBy(*(F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(keys))).agg(
        F.min_by(F.struct(*columns), rank).alias("__row")
    )
    return chosen.select("__row.*")
