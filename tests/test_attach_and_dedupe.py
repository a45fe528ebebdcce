"""Tables attached to rows, one row per key, stored layouts and ids of equal rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cityloom.operators import skew
from cityloom.operators.dedupe import keep_one
from cityloom.operators.distance_join import distance_join, lay_out
from cityloom.operators.indexing import stable_id
from cityloom.operators.skew import attach, attach_group_counts


def rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("small", [100_000, 0])
def test_attach_matches_nulls_and_types(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "SMALL_ROWS", small)
    monkeypatch.setattr(skew, "TASK_ROWS", 3)
    rows = [(1, None, 0.0), (1, "a", -0.0), (2, "a", float("nan")), (None, None, None), (7, "b", 1.0)] * 4
    df = spark.createDataFrame(rows, "k int, s string, d double").withColumn("m", F.create_map(F.lit("x"), "k"))
    table = spark.createDataFrame(
        [(1, None, 0.0, "p"), (1, "a", 0.0, "q"), (2, "a", float("nan"), "r"), (None, None, None, "s")],
        "k long, s string, d double, w string",
    )
    got = Counter((r["k"], r["s"], r["w"]) for r in attach(df, table, ["k", "s", "d"]).collect())
    assert got == {(1, None, "p"): 4, (1, "a", "q"): 4, (2, "a", "r"): 4, (None, None, "s"): 4, (7, "b", None): 4}
    assert attach(df.limit(0), table, ["k", "s", "d"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        attach(df.withColumn("w", F.lit(1)), table, ["k"])


def test_hot_key_is_spread_without_adaptive_execution(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(before, ("false", "-1", "16"), strict=True):
            spark.conf.set(c, v)
        df = spark.range(20_000).select("id", F.when(F.col("id") < 12_000, 0).otherwise(F.col("id")).alias("k"))
        made = attach_group_counts(df, ["k"])
        assert max(rows_per_task(made)) < 5_000
        assert {(r["k"] == 0, r["count"]) for r in made.collect()} == {(True, 12_000), (False, 1)}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_one_row_per_key(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.randrange(5), {"x": i % 7}, i) for i in range(400)] * 2
    df = spark.createDataFrame(rows, "k string, o int, m map<string,int>, `v w` int")
    got = keep_one(df.repartition(1), ["k"], ["o", "v w"]).collect()
    assert [f for f in df.columns] == list(got[0].asDict())
    for r in got:
        assert (r["o"], r["v w"]) == min((o, v) for k, o, _, v in rows if k == r["k"])
    assert {r["k"] for r in got} == {"a", "b", None}
    # Ties by the order: the same row for any split.
    kept = [sorted(map(str, keep_one(df.repartition(n), ["k", "o"], ["o"]).collect())) for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 15
    assert keep_one(df.limit(0), ["k"], ["o"]).count() == 0


def test_layout_gives_the_pairs_without_an_exchange(spark, hot):
    rnd = random.Random(6)
    def points(n, first):
        return [(first + i, 49.25 + (rnd.gauss(0, 1e-3) if i % 3 else 0.0), -123.1 + rnd.gauss(0, 1e-3), "ab"[i % 2]) for i in range(n)]
    left = spark.createDataFrame(points(60, 0), "a int, lat double, lon double, neighbourhood string")
    right = spark.createDataFrame(points(90, 0), "b int, latitude double, longitude double, neighbourhood string")
    layout = lay_out(left, right, 200.0)
    for radius in (200.0, 80.0):
        want = {(r["a"], r["b"]) for r in distance_join(left, right, radius).collect()}
        made = layout.pairs(radius)
        got = made.select("a", "b").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert layout.counts(["neighbourhood"]).agg(F.sum("n")).first()[0] == distance_join(left, right, 200.0).count()
    with pytest.raises(ValueError, match="at most"):
        layout.pairs(300.0)


def test_a_row_repeated_very_often_has_ids_in_every_task(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 1_000_000, 1, 32).select(F.lit("x").alias("a"))
        made = stable_id(df, "i")
        sizes = rows_per_task(made)
        assert sum(sizes) == 1_000_000 and max(sizes) < 500_000
        assert made.select("i").distinct().count() == 1_000_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_counts_of_all_rows_for_some_of_them(spark):
    """Rows that can be kept get the count of all rows of their key; null is a key."""
    some = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    counts = spark.createDataFrame([("a", 7), (None, 5), ("b", 1)], "k string, count long")
    got = attach_group_counts(some, ["k"], counts=counts).collect()
    assert sorted(map(tuple, got)) == [(1, "a", 7), (2, None, 5), (3, "c", None)]
