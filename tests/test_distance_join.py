import math
import random

import pytest
from pyspark.sql import functions as F

from cityloom.functions.geo import Distance
from cityloom.operators import distance_join as module
from cityloom.operators.distance_join import count_within, distance_join
from cityloom.operators.skew import attach_group_counts, join_small, salted_join

R = 6371000.0


def meters(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * R * math.asin(min(1.0, math.sqrt(h)))


def city(n, seed):
    """Even spread, one dense corner and one place with a third of the points."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            lat, lon = 49.25, -123.1
        elif i % 3 == 1:
            lat, lon = 49.26 + rnd.gauss(0, 0.001), -123.12 + rnd.gauss(0, 0.001)
        else:
            lat, lon = rnd.uniform(49.2, 49.3), rnd.uniform(-123.2, -123.0)
        rows.append((i, lat, lon, rnd.choice(["a", "b", None]), rnd.choice("xyz")))
    return rows


def frames(spark, left, right, parts=3):
    l = spark.createDataFrame(left, "lid int, lat double, lon double, neighbourhood string, kind string")
    r = spark.createDataFrame(right, "rid int, latitude double, longitude double, neighbourhood string, type string")
    return l.repartition(parts), r.repartition(parts)


def brute(left, right, radius, block):
    return sorted(
        (a[0], b[0])
        for a in left
        for b in right
        if (not block or (a[3] is not None and a[3] == b[3])) and meters(a[1:3], b[1:3]) <= radius
    )


@pytest.mark.parametrize("block", ["neighbourhood", None])
def test_equals_brute_force_with_hot_keys(spark, hot, block):
    left, right = city(90, 1), city(240, 2)
    l, r = frames(spark, left, right)
    pairs = distance_join(l, r if block else r.drop("neighbourhood"), 700.0, block=block)
    got = pairs.select("lid", "rid", "distance_in_meters").collect()
    assert sorted((x[0], x[1]) for x in got) == brute(left, right, 700.0, block)
    for x in got[:50]:
        assert x[2] == pytest.approx(meters(left[x[0]][1:3], right[x[1]][1:3]), abs=1e-6)


@pytest.mark.parametrize("per_radius, compared", [(1, 256), (3, 256), (5, 256), (1, 3), (3, 3)])
def test_counting_equals_joining(spark, hot, monkeypatch, per_radius, compared):
    monkeypatch.setattr(module, "MAX_COMPARED", compared)
    left, right = city(90, 3), city(240, 4)
    l, r = frames(spark, left, right)
    want = {}
    for a, b in brute(left, right, 900.0, None):
        key = (left[a][4], right[b][4])
        want[key] = want.get(key, 0) + 1
    got = count_within(l, r, 900.0, left_by=["kind"], right_by=["type"], block=None, per_radius=per_radius)
    assert {(x["kind"], x["type"]): x["n"] for x in got.collect()} == want


def test_result_does_not_depend_on_partitions(spark):
    left, right = city(40, 5), city(100, 6)
    got = [
        sorted(map(tuple, distance_join(*frames(spark, left, right, parts), 500.0).select("lid", "rid").collect()))
        for parts in (1, 8)
    ]
    assert got[0] == got[1]


def test_poles_and_date_line(spark, monkeypatch):
    left = [(0, 89.9, 0.0, "a", "x"), (1, 10.0, 179.95, "a", "x"), (2, -89.99, 45.0, "a", "x"), (3, 0.0, -179.99, "a", "x")]
    right = [(0, 89.9, 180.0, "a", "x"), (1, 10.0, -179.95, "a", "x"), (2, -89.99, -135.0, "a", "x"),
             (3, 0.01, 179.99, "a", "x"), (4, 89.95, -90.0, "a", "x"), (5, 90.0, 0.0, "a", "x"), (6, 0.0, 180.0, "a", "x")]
    l, r = frames(spark, left, right)
    want = brute(left, right, 25_000.0, None)
    assert len(want) >= 6
    assert sorted(map(tuple, distance_join(l, r.drop("neighbourhood"), 25_000.0, block=None).select("lid", "rid").collect())) == want
    for per_radius, compared in ((1, 256), (3, 256), (2, 0)):
        monkeypatch.setattr(module, "MAX_COMPARED", compared)
        got = count_within(l, r, 25_000.0, left_by=["lid"], right_by=["rid"], block=None, per_radius=per_radius).collect()
        assert sorted((x["lid"], x["rid"]) for x in got) == want


def test_radius_is_inclusive_and_coincident_points_count(spark):
    l, r = frames(spark, [(0, 49.25, -123.1, "a", "x")], [(0, 49.25, -123.1, "a", "x"), (1, 49.26, -123.1, "a", "x")])
    gap = meters((49.25, -123.1), (49.26, -123.1))
    exact = distance_join(l, r, gap * (1 + 1e-12)).count()
    assert exact == 2
    assert distance_join(l, r, gap - 0.01).count() == 1
    assert distance_join(l, r, 0.0).count() == 1
    assert distance_join(l, r, 500.0, distance=Distance("cosine")).count() == 1


def test_scaled_radius_means_nine_metres(spark):
    step = math.degrees(8.0 / R)
    right = [(i, 49.25 + i * step, -123.1, "a", "x") for i in range(4)]
    l, r = frames(spark, [(0, 49.25, -123.1, "a", "x")], right)
    got = distance_join(l, r, 500.0, distance=Distance("scaled_degrees"))
    assert sorted(x["rid"] for x in got.collect()) == [0, 1]


def test_unclamped_drops_coincident_points_that_are_nan(spark):
    n = 3000
    rows = [(i, 49.2 + i * 0.0000213, -123.2 + i * 0.0000371, "a", "x") for i in range(n)]
    l, r = frames(spark, rows, rows)

    def self_pairs(clamp):
        pairs = distance_join(l.drop("kind"), r.drop("type"), 10.0, distance=Distance("scaled_degrees", clamp=clamp))
        return pairs.filter("lid = rid").count()

    assert self_pairs(True) == n
    assert 0 < self_pairs(False) < n


def test_missing_coordinates_match_nothing(spark):
    l, r = frames(spark, [(0, None, -123.1, "a", "x"), (1, 49.25, -123.1, "a", "x")], [(0, 49.25, None, "a", "x"), (1, 49.25, -123.1, "a", "x")])
    assert distance_join(l, r, 500.0).select("lid", "rid").collect() == [(1, 1)]


def test_salted_join_keeps_every_pair(spark, hot):
    probe = spark.range(400).selectExpr("id", "if(id % 3 = 0, 7, id % 50) AS k")
    build = spark.range(60).selectExpr("id AS b", "id % 30 AS k")
    want = probe.join(build, "k").count()
    assert salted_join(probe, build, ["k"]).count() == want
    left = salted_join(probe, build, ["k"], how="left")
    assert left.count() == probe.join(build, "k", "left").count()
    plain = sorted(map(tuple, probe.join(build, "k").select("id", "b").collect()))
    assert sorted(map(tuple, salted_join(probe, build, ["k"]).select("id", "b").collect())) == plain


def test_many_medium_keys_and_equal_rows_are_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cityloom.operators import skew

    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    keys = spark.range(0, 4000, 1, 8).selectExpr("id % 4 AS k")  # rows that are all alike
    counts = keys.groupBy("k").agg(F.count("*").alias("__rows"))
    hot = {r["k"]: r["__parts"] for r in skew.hot_keys(counts, ["k"]).collect()}
    assert hot == {0: 10, 1: 10, 2: 10, 3: 10}
    salts = keys.withColumn("s", skew._salt(keys, F.lit(10))).groupBy("k", "s").count().collect()
    assert len(salts) > 16 and max(r["count"] for r in salts) <= 500


def test_hot_keys_by_the_work_of_both_sides(spark, monkeypatch):
    from cityloom.operators import skew

    monkeypatch.setattr(skew, "TASK_SIDE", 10)
    monkeypatch.setattr(skew, "TASK_ROWS", 1000)
    left = spark.createDataFrame([("both", 40), ("left", 40), ("few", 9), ("long", 2000)], "k string, __rows long")
    right = spark.createDataFrame([("both", 90), ("left", 2), ("few", 9), ("long", 1)], "k string, __rows long")
    got = {r["k"]: (r["__parts"], r["__build_parts"]) for r in skew.hot_keys(left, ["k"], right).collect()}
    assert got == {"both": (4, 9), "long": (200, 1)}


def test_both_sides_are_spread(spark, hot):
    probe = spark.range(300).selectExpr("id", "if(id % 2 = 0, 7, id % 50) AS k", "map('a', id) AS m")
    build = spark.range(200).selectExpr("id AS b", "if(id % 2 = 0, 7, id % 30) AS k", "map('b', id) AS n")
    counts = [d.groupBy("k").agg({"*": "count"}).toDF("k", "__rows") for d in (probe, build)]
    got = salted_join(probe, build, ["k"], counts=counts[0], build_counts=counts[1]).select("id", "b")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, probe.join(build, "k").select("id", "b").collect()))


def test_map_columns_in_hot_data(spark, hot):
    l, r = frames(spark, [(i, 49.25, -123.1, "a", "x") for i in range(30)], [(i, 49.25, -123.1, "a", "x") for i in range(30)])
    pairs = distance_join(l.selectExpr("*", "map('a', 1) AS tags"), r.selectExpr("*", "map('b', 2) AS more"), 50.0)
    assert pairs.count() == 900


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_small_table_join_broadcast_or_not(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4), ("", 5)] * 4, "k string, v int")
        df = df.selectExpr("*", "map('x', v) AS tags")
        small = spark.createDataFrame([("a", 10), (None, 30), ("b", 20), ("", 50)], "k string, w int")
        got = join_small(df, small, ["k"])
        assert got.columns == ["k", "v", "tags", "w"]
        assert sorted((str(r["k"]), r["w"]) for r in got.collect()) == sorted([("a", 10)] * 8 + [("None", 30)] * 4 + [("b", 20)] * 4 + [("", 50)] * 4)
        counts = {r["k"]: r["count"] for r in attach_group_counts(df, ["k"]).collect()}
        assert counts == {"a": 8, None: 4, "b": 4, "": 4}
        x = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "k double")
        one = spark.createDataFrame([(0.0, 1), (float("nan"), 2), (None, 3)], "k double, w int")
        assert sorted(r["w"] for r in join_small(x, one, ["k"]).collect()) == [1, 1, 2, 3]
        assert sorted(r["count"] for r in attach_group_counts(x, ["k"]).collect()) == [1, 1, 2, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counting_writes_rows_not_pairs(spark, monkeypatch):
    """Two crowds near each other: nothing beyond the rows of both sides is written, however many cells edges cross."""
    labels = []
    monkeypatch.setattr(module, "MAX_COMPARED", 8)
    monkeypatch.setattr("cityloom.session.scratch_path", _named(labels))
    rnd = random.Random(4)
    rows = [(i, 49.25 + rnd.gauss(0, 0.004), -123.1 + rnd.gauss(0, 0.004)) for i in range(600)]
    l = spark.createDataFrame(rows[:300], "lid int, lat double, lon double").withColumn("kind", F.col("lid") % 3)
    r = spark.createDataFrame(rows[300:], "rid int, latitude double, longitude double").withColumn("type", F.col("rid") % 2)
    got = {(x["kind"], x["type"]): x["n"] for x in count_within(l, r, 400.0, left_by=["kind"], right_by=["type"], block=None).collect()}
    want = {}
    for a in rows[:300]:
        for b in rows[300:]:
            if meters(a[1:], b[1:]) <= 400.0:
                want[a[0] % 3, b[0] % 2] = want.get((a[0] % 3, b[0] % 2), 0) + 1
    assert got == want
    assert sorted(labels) == ["count-places", "count-points"]


def _named(labels):
    from cityloom.session import scratch_path

    def path(spark, label):
        labels.append(label)
        return scratch_path(spark, label)

    return path


def test_pairs_do_not_broadcast_the_repeated_side(spark):
    """Rows of the left side in all cells they reach are nine times what their file says."""
    l = spark.createDataFrame([(1, 49.25, -123.1)], "lid int, lat double, lon double")
    r = spark.createDataFrame([(2, 49.2501, -123.1)], "rid int, latitude double, longitude double")
    joined = distance_join(l, r, 500.0, block=None)
    assert [(x["lid"], x["rid"]) for x in joined.collect()] == [(1, 2)]
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [__row" in plan


def test_points_at_the_radius_and_odd_coordinates_count_as_they_join(spark):
    """What lies at the very edge is for the exact formula; null is near nothing."""
    spots = [(i, 49.25 + i * 0.001, -123.1) for i in range(12)] + [(21, None, 1.0), (22, -89.9999, 179.9)]
    l = spark.createDataFrame(spots, "lid int, lat double, lon double")
    r = spark.createDataFrame(spots, "rid int, latitude double, longitude double")
    for how in (Distance(), Distance("cosine"), Distance("scaled_degrees")):
        radius = meters((49.25, -123.1), (49.254, -123.1)) / how.metres_per_unit
        pairs = distance_join(l, r, radius, block=None, distance=how).groupBy("lid").count().collect()
        got = count_within(l, r, radius, left_by=["lid"], block=None, distance=how).collect()
        assert sorted((x["lid"], x["n"]) for x in got) == sorted(map(tuple, pairs))


@pytest.mark.parametrize("piece, cells", [(4_000_000, 1_000_000), (50, 7)])
@pytest.mark.parametrize("block", ["neighbourhood", None])
def test_packed_pairs_are_the_same_pairs(spark, hot, monkeypatch, block, piece, cells):
    monkeypatch.setattr(module, "PACK_PAIRS", piece)
    monkeypatch.setattr(module, "PACK_CELLS", cells)
    left, right = city(90, 11), city(240, 12)
    left += [left[0], (90, None, -123.1, "a", "x")]
    right += [right[1], (240, 49.25, None, "a", "x"), (241, 49.25, float("nan"), "a", "x")]
    l, r = frames(spark, left, right)
    r = r if block else r.drop("neighbourhood")
    plain, packed = (distance_join(l, r, 700.0, block=block, packed=p) for p in (False, True))
    assert packed.schema.simpleString() == plain.schema.simpleString()
    want = sorted(map(repr, plain.collect()))
    assert len(want) > 1000 and sorted(map(repr, packed.collect())) == want


@pytest.mark.parametrize("distance", [Distance(), Distance("cosine"), Distance("scaled_degrees", clamp=False)])
def test_packed_pairs_at_the_radius_the_poles_and_the_date_line(spark, distance):
    spots = [(i, 49.25 + i * 0.001, -123.1) for i in range(12)] + [(i, 89.9 + i * 0.001, 30.0 * i) for i in range(20, 32)]
    spots += [(40, 10.0, 179.9999), (41, 10.0, -179.9999), (42, -90.0, 0.0), (43, -89.9999, 120.0), (44, 10.0, None)]
    l = spark.createDataFrame(spots, "lid int, lat double, lon double")
    r = spark.createDataFrame(spots, "rid int, latitude double, longitude double")
    for metres in (0.0, meters((49.25, -123.1), (49.254, -123.1)), 2.0e7, 3.0e7):
        how = {"block": None, "distance": distance}
        plain, packed = (distance_join(l, r, metres / distance.metres_per_unit, packed=p, **how) for p in (False, True))
        assert sorted(map(repr, packed.collect())) == sorted(map(repr, plain.collect()))


def test_unblocked_pairs_come_sorted_by_distance_in_pieces(spark, tmp_path):
    """A task's unsorted distances were three quarters of the result on disk."""
    from workload.queries import incidents, near_pairs_unblocked, places

    customers = [(i, f"C{i}", i % 25) for i in range(2500)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    orders = [(i, i % 2500) for i in range(6000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    got = near_pairs_unblocked(spark, str(tmp_path)).collect()
    gaps = [x["distance_in_meters"] for x in got]
    assert len(gaps) > 5000
    # A piece for each group of cells; nearly equal distances may have changed places.
    assert sum(b < a for a, b in zip(gaps, gaps[1:])) <= module.LEAST_TASKS + len(gaps) // 100
    plain = distance_join(
        places(spark, str(tmp_path)).select("amnt_id", "lat", "lon"),
        incidents(spark, str(tmp_path)).select("c_id", "latitude", "longitude"), 500.0, block=None,
    ).select("amnt_id", "c_id", F.round("distance_in_meters", 3))
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain.collect()))


def test_packed_pieces_are_smaller_on_disk(spark, tmp_path):
    """Four million pairs of one quarter, as many as are sorted at a time."""
    rnd = random.Random(8)
    spots = [(i, 49.25 + rnd.uniform(0, 0.003), -123.1 + rnd.uniform(0, 0.004)) for i in range(2000)]
    l = spark.createDataFrame(spots, "lid long, lat double, lon double")
    r = spark.createDataFrame(spots, "rid long, latitude double, longitude double")
    sizes = []
    for packed in (False, True):
        pairs = distance_join(l, r, 600.0, block=None, packed=packed).select("lid", "rid", F.round("distance_in_meters", 3).alias("gap"))
        pairs.coalesce(1).write.parquet(str(tmp_path / str(packed)))
        sizes.append(sum(f.stat().st_size for f in (tmp_path / str(packed)).glob("*.parquet")))
    assert sizes[1] < 0.8 * sizes[0], sizes
