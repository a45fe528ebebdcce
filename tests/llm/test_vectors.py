import numpy as np
import pytest
from pyspark.sql import functions as F

from cityloom.llm import embedding_dedup, neighbours
from cityloom.llm.queries import op5_nearest_neighbours, op6_embedding_dedup

KIND = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def odd_rows(dim):
    zero = [0.0] * dim
    return [(9000, None, 1), (9001, [], 1), (9002, zero, 1), (9003, [NAN] + zero[1:], 1), (9004, [INF] + zero[1:], 1),
            (9005, [None, 1.0] + zero[2:], 1), (9006, [1.0], 1)]


def clustered(n=300, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    x = (centres[rng.integers(0, 20, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.4], (n, 1))).astype(np.float32)
    x[10:60] = x[min(10, n - 1)]  # a vector that many share
    if n > 61:
        x[60, 0] = 0.0
        x[61] = x[60]
        x[61, 0] = -0.0
    return x


def table(spark, x, labels=None, odd=True):
    rows = [(int(i), [float(v) for v in row], int(labels[i]) if labels is not None else 0) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows + (odd_rows(x.shape[1]) if odd else []), KIND)
    return df.withColumn("vec", F.lit(1)).withColumn("id", F.lit("x")).withColumn("c", F.lit(0)).repartition(3)


def brute(x, ids, queries, k):
    out = {}
    x = x.astype(float)
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        out[ids[q]] = sorted((d[i], ids[i]) for i in range(len(x)) if i != q)[:k]
    return out


def test_nearest_on_clusters_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TASK_VECTORS", 40)
    x = clustered()
    got = {}
    for r in neighbours.nearest(table(spark, x), "vec_id % 10 = 0", 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = brute(x, list(range(len(x))), range(0, len(x), 10), 10)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and len({f[2] for f in found}) == 10
        exact = dict((i, d) for d, i in brute(x, list(range(len(x))), [q], len(x))[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, s, i in found)
        assert [(s, i) for _, s, i in found] == sorted((s, i) for _, s, i in found)
        hits += sum(s <= want[q][-1][0] + 1e-12 for _, s, _ in found)
    assert hits >= 0.95 * 10 * len(want)
    # Those who share a vector get the smallest ids of the others, ties to the smaller id.
    assert [i for _, _, i in got[20]] == [i for i in range(10, 21) if i != 20]


def test_nearest_gives_all_when_there_are_few(spark):
    x = clustered(8)
    got = neighbours.nearest(table(spark, x[:4]), "vec_id = 0", 10).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2, 3]
    far = np.eye(12, dtype=np.float32)[:12] * 1000  # nothing lies in a bucket nearby
    far[0] *= 1e6
    assert neighbours.nearest(table(spark, far), "vec_id = 0", 10).count() == 10
    assert neighbours.nearest(table(spark, x).limit(0), "vec_id = 0", 10).collect() == []
    assert neighbours.nearest(table(spark, x[:1], odd=False), "vec_id = 0", 10).collect() == []
    assert neighbours.nearest(table(spark, x), "vec_id = 9003", 10).collect() == []


def test_query_op5_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows])
    want = brute(x, ids, [i for i, k in enumerate(ids) if k % 100 == 0], 10)
    got = {}
    for r in op5_nearest_neighbours(spark, sf).collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    assert set(got) == set(want) and all(len(s) == 10 for s in got.values())
    assert sum(s <= want[q][-1][0] + 1e-12 for q in got for s in got[q]) >= 0.9 * 10 * len(want)


def links(x, labels, threshold):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= threshold) & (labels[:, None] == labels[None])
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        low = np.minimum(root, np.where(near, root[None], len(x)).min(1))
        if (low == root).all():
            return near.sum(1), root
        root = low


def test_doubles_keep_their_last_bits(spark):
    base = np.random.default_rng(2).normal(size=6)
    rows = [(0, base.tolist(), 1), (1, (base + 1e-12).tolist(), 1), (2, (base + 2e-12).tolist(), 1), (3, (base + 1).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = neighbours.nearest(df, "vec_id = 0", 2).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2]
    assert got[0]["score"] == pytest.approx(np.sqrt(((base + 1e-12 - base) ** 2).sum()), rel=1e-9)
    kept = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert kept[0] == kept[1] == kept[2] >= 2


def test_near_duplicates_of_clusters(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(60, 48)), 8, 0)
    x = (x + rng.normal(size=x.shape) * 0.08).astype(np.float32)
    x[100:140] = x[100]
    labels = rng.integers(0, 2, len(x))
    n, root = links(x, labels, 0.93)
    for size in (20_000, 30):
        monkeypatch.setattr(embedding_dedup, "TASK_VECTORS", size)
        monkeypatch.setattr(embedding_dedup, "_PAIRS", 500)
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table(spark, x, labels)).collect()}
        assert len(got) == len(x) + 7
        assert all(got[i]["n_links"] <= n[i] for i in range(len(x)))
        assert sum(got[i]["n_links"] for i in range(len(x))) >= 0.97 * n.sum()
        assert sum(got[i]["component_id"] == root[i] for i in range(len(x))) >= 0.97 * len(x)
        assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
        assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(9000, 9007))


def test_pairs_of_values_one_bit_apart_come_once():
    value = np.random.default_rng(1).integers(0, 64, 200).astype(np.uint64)
    home = np.arange(200) % 3 > 0
    got = sorted(tuple(sorted(p)) for a, b in embedding_dedup._matches(value, home, 6) for p in zip(a.tolist(), b.tolist()))
    want = [(i, j) for j in range(200) for i in range(j) if (home[i] or home[j]) and int(value[i] ^ value[j]).bit_count() <= 1]
    assert got == sorted(want)


def test_near_duplicates_of_rows_of_all_kinds(spark):
    a, b = [1.0, 2.0, 0.0, 3.0], [-1.0, 0.5, 2.0, 0.1]
    df = spark.createDataFrame(
        [(5, a, 1), (2, a, 1), (2, a, 1), (3, a, 2), (4, a, None), (6, [2 * v for v in a], 1), (7, b, 1), (None, b, 1)]
        + odd_rows(4), KIND,
    ).withColumn("n", F.lit(0)).withColumn("least", F.lit(0))
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect())
    want = [("5", 3, 2, False), ("2", 3, 2, True), ("2", 3, 2, True), ("3", 0, 3, True), ("4", 0, 4, True), ("6", 3, 2, False),
            ("7", 1, 7, True), ("None", 1, 7, False)] + [(str(9000 + i), 0, 9000 + i, True) for i in range(7)]
    assert got == sorted(want)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_query_op6_against_comparing_all(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x, labels = np.array([r["embedding"] for r in rows]), np.array([r["label"] for r in rows])
    n, root = links(x, labels, 0.93)
    got = {r["vec_id"]: r for r in op6_embedding_dedup(spark, sf).collect()}
    assert all(got[r["vec_id"]]["n_links"] <= n[i] for i, r in enumerate(rows)) and len(got) == len(rows)
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * n.sum()


def planted(rng, n, dim, cosine, shared):
    """Pairs of unit vectors with the given cosine; of vectors of different pairs it is ``shared`` on average."""
    x = rng.normal(size=(n, dim)) * np.sqrt(1 - shared) / np.sqrt(dim)
    x[:, 0] += np.sqrt(shared)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return np.stack((x, cosine * x + np.sqrt(1 - cosine**2) * noise), 1).reshape(-1, dim)


@pytest.mark.parametrize(("dim", "shared"), [(64, 0.0), (64, 0.85), (6, 0.0)])
def test_pairs_near_the_threshold_are_found(spark, dim, shared):
    x = planted(np.random.default_rng(8), 600, dim, 0.935, shared).astype(np.float32)
    n, _ = links(x, np.zeros(len(x)), 0.93)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(table(spark, x, odd=False)).collect()}
    assert all(got[i] <= n[i] for i in range(len(x)))
    recall = sum(got.values()) / n.sum()
    print("recall", dim, shared, round(recall, 4))
    assert recall >= 0.9


def test_large_groups_are_cut_into_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TASK_VECTORS", 40)
    rows = spark.range(200).select(F.lit(1).alias("label"), F.lit(0).alias("t"), F.expr("(id % 100) div 99 AS part"), F.col("id").alias("c"))
    counted = rows.groupBy("label", "t", "part").agg(F.count("*").alias("rows"))
    got = embedding_dedup.in_blocks(rows, counted).collect()
    groups = {}
    for r in got:
        groups.setdefault((r["part"], r["i"], r["j"]), []).append((r["c"], r["own"]))
    assert max(map(len, groups.values())) <= 2 * 40 and len(groups) > 10
    met = [(a, b) for (_, i, j), g in groups.items() for a, p in g for b, q in g if a < b and (i == j or p != q)]
    of = {c: c % 100 // 99 for c in range(200)}
    assert sorted(met) == [(a, b) for a in range(200) for b in range(a + 1, 200) if of[a] == of[b]]


def test_many_near_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TASK_VECTORS", 40)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 16))
    x[::3] = x[0] + rng.normal(size=(100, 16)) * 1e-4
    x = x.astype(np.float32)
    n, root = links(x, np.zeros(len(x)), 0.93)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table(spark, x, odd=False)).collect()}
    assert all(got[i]["n_links"] == n[i] and got[i]["component_id"] == root[i] for i in range(0, 300, 3))
