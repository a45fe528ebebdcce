import random

import numpy as np
import pytest

from cityloom.operators import knn as module
from cityloom.operators.knn import knn_join, label_by_neighbours
from cityloom.plans.neighbourhoods import label_places, labelling_scores


def spread(n, seed):
    """A tight cluster, a third of all rows at one place, an even spread, and stragglers far away."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            y, x = 49.25, -123.1
        elif i % 3 == 1:
            y, x = 49.2601 + rnd.gauss(0, 1e-5), -123.12 + rnd.gauss(0, 1e-5)
        elif i % 30 == 2:
            y, x = 60.0 + rnd.random(), -100.0 + rnd.random()
        else:
            y, x = rnd.uniform(49.2, 49.3), rnd.uniform(-123.2, -123.0)
        rows.append((i, y, x, rnd.choice("abc")))
    return rows


def brute(queries, train, k, scale=1.0):
    t = np.array([(r[1], r[2] * scale) for r in train])
    ids = np.array([r[0] for r in train])
    out = {}
    for q in queries:
        d = (q[1] - t[:, 0]) ** 2 + (q[2] * scale - t[:, 1]) ** 2
        out[q[0]] = [int(ids[j]) for j in np.lexsort((ids, d))[:k]]
    return out


def neighbours(spark, queries, train, k, parts=3, **how):
    q = spark.createDataFrame([r[:3] for r in queries], "qid int, lat double, lon double").repartition(parts)
    t = spark.createDataFrame(train, "tid int, latitude double, longitude double, label string").repartition(parts)
    rows = knn_join(q, t, key="qid", train_id="tid", k=k, carry=("label",), **how).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["rank"])):
        got.setdefault(r["qid"], []).append(r["tid"])
        assert r["label"] == next(t[3] for t in train if t[0] == r["tid"])
    return got


def test_equals_brute_force_on_uneven_data(spark, hot):
    train = spread(600, 1)
    queries = spread(120, 2) + [(1000, -30.0, 100.0, ""), (1001, 49.2601, -123.12, ""), (1002, 49.9, -123.1, "")]
    assert neighbours(spark, queries, train, 5) == brute(queries, train, 5)


def test_scaled_longitude(spark):
    train, queries = spread(150, 3), spread(30, 4)
    assert neighbours(spark, queries, train, 4, lon_scale=0.65) == brute(queries, train, 4, 0.65)


def test_partitions_do_not_matter(spark):
    train, queries = spread(90, 5), spread(20, 6)
    assert neighbours(spark, queries, train, 3, 1) == neighbours(spark, queries, train, 3, 8)


def test_fewer_points_than_neighbours_and_none(spark):
    queries = [(0, 49.2, -123.1, "")]
    train = [(i, 49.2 + i, -123.0, "a") for i in range(3)]
    assert neighbours(spark, queries, train, 5) == {0: [0, 1, 2]}
    empty = spark.createDataFrame([], "tid int, latitude double, longitude double, label string")
    q = spark.createDataFrame(queries, "qid int, lat double, lon double, x string")
    assert knn_join(q, empty, key="qid", train_id="tid").count() == 0


def test_vote_ties_go_to_the_smallest_label_and_distance_ties_to_the_smallest_id(spark):
    train = [(4, 0.0, 1.0, "d"), (3, 0.0, -1.0, "c"), (2, 1.0, 0.0, "b"), (1, -1.0, 0.0, "a"), (9, 5.0, 5.0, "a")]
    t = spark.createDataFrame(train, "tid int, latitude double, longitude double, label string")
    q = spark.createDataFrame([(0, 0.0, 0.0), (1, None, 0.0), (2, 0.0, 0.0)], "qid int, lat double, lon double")
    got = {r["qid"]: r["label"] for r in label_by_neighbours(q, t, train_id="tid", label="label", k=3).collect()}
    assert got == {0: "a", 1: None, 2: "a"}
    assert neighbours(spark, [(0, 0.0, 0.0, "")], train, 2) == {0: [1, 2]}


def test_labelling_and_its_scores(spark):
    rows = [("Mischief", 49.2 + (i % 20) * 1e-3 + i * 1e-6, -123.1 - (0.1 if i % 2 else 0.0), "w" if i % 2 else "e", i)
            for i in range(200)]
    incidents = spark.createDataFrame(rows, "type string, latitude double, longitude double, neighbourhood string, c_id bigint")
    places = spark.createDataFrame([(1, 49.21, -123.11), (2, 49.21, -123.19)], "amnt_id bigint, lat double, lon double")
    got = {r["amnt_id"]: r["neighbourhood"] for r in label_places(places, incidents).collect()}
    assert got == {1: "e", 2: "w"}
    scores = {r["part"]: (r["n"], r["accuracy"]) for r in labelling_scores(incidents).collect()}
    assert scores["train"][1] == scores["validation"][1] == 1.0
    assert scores["train"][0] + scores["validation"][0] == 200 and 120 < scores["train"][0] < 180


def test_haversine_neighbours(spark):
    from cityloom.functions.geo import haversine_m

    rnd = random.Random(12)
    rows = spread(120, 4) + [(500 + i, rnd.uniform(-90, 90), rnd.uniform(-180, 180), "d") for i in range(120)]
    rows += [(700, 89.99, 0.0, "d"), (701, 89.99, 179.0, "d"), (702, 0.0, 179.999, "d"), (703, 0.0, -179.999, "d")]
    asked = [(r[0], r[1], r[2]) for r in rows[::5]] + [(900, 90.0, 45.0), (901, 0.1, -180.0), (902, 49.25, -123.1)]
    got = neighbours(spark, asked, rows, 5, metric="haversine")
    q = spark.createDataFrame(asked, "qid int, lat double, lon double")
    t = spark.createDataFrame(rows, "tid int, latitude double, longitude double, label string")
    gaps = {}
    for r in q.crossJoin(t).select("qid", "tid", haversine_m("latitude", "longitude", "lat", "lon").alias("h")).collect():
        gaps.setdefault(r["qid"], {})[r["tid"]] = r["h"]
    for k, found in got.items():
        want = sorted((g, i) for i, g in gaps[k].items())[:5]
        assert [gaps[k][i] for i in found] == pytest.approx([g for g, _ in want], abs=1e-6)
        assert len(set(found)) == 5
    assert got[902] == [0, 3, 6, 9, 12]
    named = label_by_neighbours(q, t, train_id="tid", label="label", k=5, metric="haversine")
    assert named.filter("label IS NOT NULL").count() == len(asked)
    with pytest.raises(ValueError):
        knn_join(q, t, key="qid", train_id="tid", metric="city blocks")


def test_small_trees_split_leaves_and_many_visits(spark, monkeypatch):
    from cityloom.operators import knn

    train = spread(500, 7)
    queries = spread(150, 8) + [(1000 + i, 49.2601, -123.12, "") for i in range(60)]
    want = brute(queries, train, 7)
    for name, value in (("MAX_LEAVES", 3), ("TASK_VISITS", 20), ("SAMPLE_ROWS", 50), ("BLOCK_ROWS", 4)):
        monkeypatch.setattr(knn, name, value)
    assert neighbours(spark, queries, train, 7) == want


def test_coordinates_that_are_no_numbers_have_no_neighbours(spark):
    q = spark.createDataFrame([(0, float("nan"), 1.0), (1, 0.0, 0.0)], "qid int, lat double, lon double")
    t = spark.createDataFrame([(1, 0.0, float("nan")), (2, 1.0, 1.0)], "tid int, latitude double, longitude double")
    assert [(r["qid"], r["tid"]) for r in knn_join(q, t, key="qid", train_id="tid").collect()] == [(1, 2)]


def test_few_jobs_whatever_the_spread(spark):
    train = [(i, 49.0 + 10.0 ** -(i % 9), -123.0 - 10.0 ** -(i % 7) * (i % 11), "a") for i in range(400)]
    q = spark.createDataFrame([r[:3] for r in train], "qid int, lat double, lon double")
    t = spark.createDataFrame(train, "tid int, latitude double, longitude double, label string")
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    knn_join(q, t, key="qid", train_id="tid").collect()
    assert len(tracker.getJobIdsForGroup(None)) - before <= 18


@pytest.mark.parametrize("chunk, block", [(1, 1), (3, 2), (64, 5)])
def test_queries_that_share_blocks_find_their_own_neighbours(spark, monkeypatch, chunk, block):
    """Queries next to each other are asked together, whatever lies between them."""
    monkeypatch.setattr(module, "CHUNK_QUERIES", chunk)
    monkeypatch.setattr(module, "BLOCK_ROWS", block)
    monkeypatch.setattr(module, "MAX_LEAVES", 3)
    train, queries = spread(240, 5), spread(90, 6)
    q = spark.createDataFrame([r[:3] for r in queries], "qid int, lat double, lon double")
    t = spark.createDataFrame(train, "tid int, latitude double, longitude double, label string")
    got = {}
    for r in knn_join(q, t, key="qid", train_id="tid", k=4).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["tid"])
    assert got == brute(queries, train, 4)
